"""Books as a corpus: routing gates, incremental plans, validation of file manifests, triage and totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire import constants as K
from quire.functions import text as T
from quire.options import Options


def needs_conversion(source_time: Column, text_time: Column) -> Column:
    """The text is absent or older than its source."""
    return text_time.isNull() | (source_time > text_time)


def scan_only(pages: DataFrame, sample: int = 5) -> DataFrame:
    """(book, scan_only): the first pages hold almost no text."""
    chars = F.sum(F.when(F.col("page") <= sample, F.length(T.strip(F.col("text")))).otherwise(0))
    return pages.groupBy("book").agg((F.coalesce(chars, F.lit(0)) < K.SCAN_CHARS).alias("scan_only"))


def silent_failures(pages: DataFrame, sample: int = 5) -> DataFrame:
    """(book, garbled): fewer than half of the characters of sampled content pages are ordinary ones."""
    size = pages.groupBy("book").agg(F.count("*").alias("n"))
    step = F.greatest(F.lit(1), F.floor(F.col("n") / (sample + 1)))
    at = pages.join(size, "book").where((F.col("page") - 1 >= step) & ((F.col("page") - 1) % step == 0) & (F.length("text") >= K.GARBLE_CHARS))
    taken = at.withColumn("k", F.row_number().over(Window.partitionBy("book").orderBy("page"))).where(F.col("k") <= sample)
    good = F.length(F.regexp_replace("text", "[^\\x20-\\x7e\\n\\t\\r一-鿿　-〿＀-￯ -ÿ]", ""))
    judged = taken.groupBy("book").agg((F.sum(good) < K.GARBLE_RATIO * F.sum(F.length("text"))).alias("garbled"))
    return size.select("book").join(judged, "book", "left").select("book", F.coalesce("garbled", F.lit(False)).alias("garbled"))


def ocr_problems(pages: DataFrame, options: Options = Options()) -> DataFrame:
    """(book, pages, empty, chars, failed): too many empty pages or too few characters on the mean page."""
    by = pages.groupBy("book").agg(F.count("*").alias("pages"), F.count_if(~T.has_text(F.col("text"))).alias("empty"), F.sum(F.length("text")).alias("chars"))
    failed = (F.col("empty") / F.col("pages") > options.ocr_empty_page_max) | (F.col("chars") / F.col("pages") < options.ocr_min_chars_per_page)
    return by.withColumn("failed", failed)


def book_plan(texts: DataFrame, manifests: DataFrame, held: DataFrame, config_time: Column) -> DataFrame:
    """(book, force): books to split again.  Inputs are (book, time).

    No manifest: new.  Text newer than the manifest: forced.  Held back: forced once text or configuration changed.
    """
    t = texts.select("book", F.col("time").alias("text_time")).where("text_time is not null")
    m = manifests.select("book", F.col("time").alias("manifest_time"))
    h = held.select("book", F.col("time").alias("held_time"))
    joined = t.join(m, "book", "left").join(h, "book", "left").withColumn("config_time", config_time)
    waiting = F.col("manifest_time").isNull() & F.col("held_time").isNotNull()
    changed = F.greatest("text_time", "config_time") > F.col("held_time")
    force = F.when(waiting, F.when(changed, True)).when(F.col("manifest_time").isNull(), False).when(F.col("text_time") > F.col("manifest_time"), True)
    return joined.select("book", force.alias("force")).where("force is not null")


def source_lookup(books: DataFrame, sources: DataFrame) -> DataFrame:
    """(book, path, how): each book's source by the first rung that has a hit; several hits stop the search.

    ``books``: book, configured, header (path of an earlier run), name; ``sources``: path, name.  Rungs:
    configured path, header path, unique file name, unique normalised stem.
    """
    keyed = sources.withColumn("stem", T.file_stem_key(F.regexp_replace("name", r"\.[A-Za-z]+$", "")))
    by_name = keyed.groupBy(F.lower("name").alias("lname")).agg(F.count("*").alias("name_n"), F.min("path").alias("name_path"))
    by_stem = keyed.groupBy("stem").agg(F.count("*").alias("stem_n"), F.min("path").alias("stem_path"))
    paths = keyed.select("path").distinct()
    b = books.withColumn("lname", F.lower("name")).withColumn("stem", T.file_stem_key(F.regexp_replace("name", r"\.[A-Za-z]+$", "")))
    b = b.join(paths.select(F.col("path").alias("configured"), F.lit(True).alias("c_hit")), "configured", "left").join(paths.select(F.col("path").alias("header"), F.lit(True).alias("h_hit")), "header", "left")
    b = b.join(by_name, "lname", "left").join(by_stem, "stem", "left")
    rung = lambda how, path: F.struct(path.alias("path"), F.lit(how).alias("how"))
    none = F.lit(None).cast("string")
    found = (
        F.when(F.col("c_hit"), rung("configured", F.col("configured")))
        .when(F.col("h_hit"), rung("header", F.col("header")))
        .when(F.col("name_n") == 1, rung("name", F.col("name_path")))
        .when(F.col("name_n") > 1, rung("ambiguous", none))
        .when(F.col("stem_n") == 1, rung("stem", F.col("stem_path")))
        .when(F.col("stem_n") > 1, rung("ambiguous", none))
        .otherwise(rung("missing", none))
    )
    return b.select("book", found.alias("f")).select("book", "f.path", "f.how")


def violations(files: DataFrame) -> DataFrame:
    """violation(book, check, file, detail) of file manifests; see ``plans.inputs.files`` for the columns.

    Checks: unlisted_file, missing_file, duplicate_entry, schema (kind), page_overlap, page_gap,
    chapter_order, chapter_gap.
    """
    row = lambda frame, check, file, detail: frame.select("book", F.lit(check).alias("check"), file.alias("file"), detail.alias("detail"))
    none = F.lit(None).cast("string")
    listed, held = files.where("listed"), files.where("listed and on_disk")
    twice = listed.groupBy("book", "file").count().where("count > 1")
    pages = Window.partitionBy("book").orderBy("seq")
    steps = held.where("page_start is not null and seq is not null").withColumn("before_end", F.lag("page_end").over(pages)).withColumn("before_file", F.lag("file").over(pages))
    top = F.max("chapter_number").over(pages.rowsBetween(Window.unboundedPreceding, -1))
    order = held.withColumn("top", top).where("chapter_number < top")
    numbers = listed.where("chapter_number is not null").groupBy("book").agg(F.min("chapter_number").alias("a"), F.max("chapter_number").alias("b"), F.collect_set("chapter_number").alias("have"))
    missing = F.array_sort(F.array_except(F.sequence("a", "b"), "have"))
    parts = [
        row(files.where("on_disk and not listed"), "unlisted_file", F.col("file"), none),
        row(files.where("listed and not on_disk"), "missing_file", F.col("file"), none),
        row(twice, "duplicate_entry", F.col("file"), none),
        row(listed.where("kind not in ('body', 'references', 'front', 'back')"), "schema", F.col("file"), F.concat(F.lit("kind "), F.col("kind"))),
        row(steps.where("page_start <= before_end"), "page_overlap", F.col("file"), F.concat(F.lit("pages overlap "), F.col("before_file"))),
        row(steps.where("page_start > before_end + 1"), "page_gap", F.col("file"), F.concat(F.lit("pages "), (F.col("before_end") + 1).cast("string"), F.lit("-"), (F.col("page_start") - 1).cast("string"), F.lit(" in no file"))),
        row(order, "chapter_order", F.col("file"), F.concat(F.lit("chapter "), F.col("chapter_number").cast("string"), F.lit(" after chapter "), F.col("top").cast("string"))),
        row(numbers.where(F.size(missing) > 0), "chapter_gap", none, F.concat(F.lit("chapter numbers missing: "), F.array_join(F.slice(missing, 1, 20), ","))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def triage(stats: DataFrame) -> DataFrame:
    """Tier and reasons of each book from pages, bytes, tables, lost, flag_rate, dosage, chapters and tables_before."""
    c = F.col
    pages = F.greatest(c("pages"), F.lit(1))
    tests = {
        "bytes": ("BLOCKED", c("bytes") / pages < K.BYTES_PER_PAGE),
        "loss": ("REVIEW", (c("tables") > 0) & (c("lost") / c("tables") > K.TRIAGE_LOSS)),
        "flags": ("REVIEW", c("flag_rate") > K.TRIAGE_FLAGS),
        "dosage": ("REVIEW", c("dosage") >= K.TRIAGE_DOSAGE),
        "chapters": ("ODD", c("chapters") / pages > K.TRIAGE_CHAPTERS),
        "collapse": ("ODD", (c("tables_before") >= 50) & (c("tables") < c("tables_before") * K.TRIAGE_COLLAPSE)),
    }
    safe = {k: (t, F.coalesce(e, F.lit(False))) for k, (t, e) in tests.items()}
    tier = F.lit("OK")
    for name in ("ODD", "REVIEW", "BLOCKED"):
        hit = F.lit(False)
        for t, e in safe.values():
            hit = hit | e if t == name else hit
        tier = F.when(hit, name).otherwise(tier)
    return stats.select("book", tier.alias("tier"), F.array_join(F.array_compact(F.array(*[F.when(e, k) for k, (_, e) in safe.items()])), ",").alias("reasons"))


def index_totals(files: DataFrame) -> DataFrame:
    """(book, files, words) for every book and, with a null book, for all."""
    words = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return files.withColumn("w", words).rollup("book").agg(F.count("*").alias("files"), F.sum("w").alias("words"))
