"""Chapters of a book: headings in its lines, bookmarks, outline levels and numbers in force."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire import constants as K
from quire.functions import text as T


def book_lines(pages: DataFrame) -> DataFrame:
    """line(book, line_no, page, text): the lines of every page in order, counted through the book."""
    lines = pages.select("book", "page", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text"))
    sizes = pages.groupBy("book", "page").agg(F.sum(F.size(F.split("text", "\n", -1))).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("book").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return lines.join(sizes.select("book", "page", before.alias("before")), ["book", "page"]).select("book", (F.col("before") + F.col("pos")).alias("line_no"), "page", "text")


def heading_lines(lines: DataFrame) -> DataFrame:
    """Lines that match a heading pattern, with key and title; running headers (one title, several numbers) are left out."""
    s = lines.withColumn("s", T.strip(F.col("text"))).where((F.length("s") >= 3) & (F.length("s") <= K.HEADING_MAX))
    found = s.where(T.is_chapter_heading(F.col("s")))
    numbered = F.col("s").rlike(K.NUMBERED_HEADING)
    signature = F.lower(F.trim(F.regexp_replace("s", r"^\d{1,2}\s+", "")))
    keyed = found.withColumn("signature", F.when(numbered & ~(F.col("s").rlike(K.CHAPTER_HEADING) | F.col("s").rlike(K.PART_HEADING) | F.col("s").rlike(K.SECTION_HEADING)), signature))
    running = s.where(numbered).groupBy("book", signature.alias("signature")).agg(F.countDistinct(F.regexp_extract("s", r"^(\d{1,2})\b", 1)).alias("n")).where(F.col("n") >= K.RUNNING_HEADER_MIN).select("book", "signature")
    return keyed.join(running, ["book", "signature"], "left_anti").select("book", "line_no", "page", F.col("s").alias("title"), T.chapter_key(F.col("s")).alias("key"))


def contents_spans(headings: DataFrame) -> DataFrame:
    """(book, first, last): the longest dense run of headings most of whose keys come again later."""
    w = Window.partitionBy("book").orderBy("line_no")
    new = F.coalesce((F.col("line_no") - F.lag("line_no").over(w) > K.TOC_MAX_GAP).cast("int"), F.lit(1))
    runs = headings.withColumn("new", new).withColumn("run", F.sum("new").over(w))
    spans = runs.groupBy("book", "run").agg(F.min("line_no").alias("first"), F.max("line_no").alias("last"), F.count("*").alias("n")).where(F.col("n") >= K.TOC_MIN_ENTRIES)
    last_of = runs.groupBy("book", "key").agg(F.max("run").alias("last_run"))
    keys = runs.select("book", "run", "key").distinct().join(last_of, ["book", "key"]).groupBy("book", "run").agg(F.count("*").alias("keys"), F.count_if(F.col("last_run") > F.col("run")).alias("again"))
    good = spans.join(keys, ["book", "run"]).where(F.col("again") >= F.greatest(F.lit(3), F.floor(F.col("keys") / 2)))
    return good.groupBy("book").agg(F.max_by(F.struct("first", "last"), F.struct("n", -F.col("run"))).alias("s")).select("book", "s.first", "s.last")


def detect_chapters(lines: DataFrame) -> DataFrame:
    """chapter(book, line_no, page, title, key): the first heading of each key outside a contents listing."""
    headings = heading_lines(lines)
    spans = contents_spans(headings)
    kept = headings.join(spans, "book", "left").where("first is null or line_no < first or line_no > last")
    return kept.groupBy("book", "key").agg(F.min_by(F.struct("line_no", "page", "title"), "line_no").alias("h")).select("book", "h.line_no", "h.page", "h.title", "key")


def bookmark_chapters(lines: DataFrame, outline: DataFrame, merge: bool = True) -> DataFrame:
    """Chapter files by bookmarks of the two upper levels: (book, number, title, file, line_start, line_end).

    Needs two bookmarks with a page in the book.  Of several on one line the last keeps the text;
    numbers keep the gaps.
    """
    first = lines.groupBy("book", "page").agg(F.min("line_no").alias("line_start"))
    total = lines.groupBy("book").agg((F.max("line_no") + 1).alias("total"))
    marks = outline.where("level <= 2").join(first, ["book", "page"])
    w = Window.partitionBy("book").orderBy("ord")
    ranged = marks.withColumn("number", F.row_number().over(w)).withColumn("line_end", F.lead("line_start").over(w)).join(total, "book").withColumn("line_end", F.coalesce("line_end", "total"))
    several = F.count("*").over(Window.partitionBy("book")) >= 2
    ranged = ranged.withColumn("several", several).where("several").drop("several", "total")
    if merge:
        text = lines.where(~F.col("text").rlike(K.PAGE_MARKER) & F.col("text").rlike(r"\S"))
        held = ranged.join(text.select("book", F.col("line_no").alias("at")), "book").where("at >= line_start and at < line_end").select("book", "number").distinct()
        ranged = ranged.join(held.withColumn("held", F.lit(True)), ["book", "number"], "left").where("held or line_end < line_start").drop("held")
    return ranged.select("book", "number", F.trim("title").alias("title"), T.chapter_file(F.col("number"), F.trim(F.col("title"))).alias("file"), "line_start", "line_end")


def page_chunks(pages: DataFrame, size: int = K.FORCE_SPLIT_CHUNK) -> DataFrame:
    """(book, file, first, last, n_chars): pages in fixed ranges, for books without chapters."""
    chunk = F.floor((F.col("page") - 1) / size)
    last = F.max("page").over(Window.partitionBy("book"))
    ranged = pages.withColumn("most", last).withColumn("first", (chunk * size + 1).cast("int")).withColumn("last", F.least((chunk * size + size).cast("int"), F.col("most")))
    return ranged.groupBy("book", "first", "last").agg(F.sum(F.length("text")).alias("n_chars")).withColumn("file", F.concat(F.lit("pages_"), F.col("first").cast("string"), F.lit("-"), F.col("last").cast("string"), F.lit(".md")))


def numbered(outline: DataFrame) -> DataFrame:
    return outline.withColumn("n", T.chapter_number(F.col("title"))).withColumn("keyword", T.keyword_chapter_number(F.col("title")))


def chapter_levels(outline: DataFrame, least: int = 3) -> DataFrame:
    """(book, level, reason): the level with the most numbered titles that increase; ties go to the shallower."""
    n = numbered(outline).where("n is not null")
    w = Window.partitionBy("book", "level").orderBy("ord")
    steps = n.withColumn("up", F.coalesce(F.col("n") > F.lag("n").over(w), F.lit(True)))
    by = steps.groupBy("book", "level").agg(F.count("*").alias("k"), F.bool_and("up").alias("up"), F.bool_and(F.col("keyword").eqNullSafe(F.col("n"))).alias("words"))
    best = lambda cond: F.max(F.when(cond, F.struct(F.col("k"), (-F.col("level")).alias("l"))))
    found = by.groupBy("book").agg(best((F.col("k") >= least) & F.col("up")).alias("good"), F.bool_or((F.col("k") >= least) & ~F.col("up")).alias("back"), best(F.col("up") & F.col("words")).alias("few"))
    level = F.coalesce(-F.col("good.l"), F.when(~F.col("back"), -F.col("few.l")))
    reason = F.when(F.col("good").isNotNull(), "ok").when(F.col("back"), "numbers not increasing").when(F.col("few").isNotNull(), "few chapters, titled Chapter N").otherwise("no numbered titles")
    return outline.select("book").distinct().join(found, "book", "left").select("book", level.alias("level"), F.coalesce(reason, F.lit("no numbered titles")).alias("reason"))


def chapter_states(outline: DataFrame, levels: DataFrame) -> DataFrame:
    """(book, ord, title, chapter): the chapter number in force at every entry; nothing above the chapter level."""
    joined = numbered(outline).join(levels.select("book", F.col("level").alias("chapter_level")), "book", "left")
    resets = F.when(F.col("level") <= F.col("chapter_level"), F.struct(F.when(F.col("level") == F.col("chapter_level"), F.col("n")).alias("n")))
    state = F.last(resets, ignorenulls=True).over(Window.partitionBy("book").orderBy("ord"))
    return joined.select("book", "ord", "title", state["n"].alias("chapter"))


def numbering_gaps(outline: DataFrame, levels: DataFrame) -> DataFrame:
    """(book, after, before, missing): gaps between neighbouring chapter numbers at the chapter level."""
    at = numbered(outline).join(levels.select("book", F.col("level").alias("chapter_level")), "book").where("level = chapter_level and n is not null")
    steps = at.withColumn("next", F.lead("n").over(Window.partitionBy("book").orderBy("ord")))
    return steps.where("next - n > 1").select("book", F.col("n").alias("after"), F.col("next").alias("before"), (F.col("next") - F.col("n") - 1).alias("missing"))


def file_verdict(text: Column, number: Column, title: Column) -> Column:
    """confirmed, contradicted or unknown: whether the opening text prints the chapter number."""
    head = F.regexp_replace(text, r"(?i)\bchapter(\d)", "CHAPTER $1")
    n = number.cast("string")
    lines = F.slice(F.filter(F.transform(F.split(head, "\n", -1), T.strip), lambda x: x != ""), 1, 60)
    words = F.slice(F.filter(F.split(T.normalise_ascii(T.strip_numbering(title)), " "), lambda w: F.length(w) >= 3), 1, 3)
    after = lambda x: T.normalise_ascii(F.regexp_replace(x, r"^\d+(?:\.|\s|:)\s*", ""))
    said = F.regexp_like(head, F.concat(F.lit(r"(?i)\bchapter\s*"), n, F.lit(r"\b")))
    bare = F.exists(lines, lambda x: x == n)
    titled = F.exists(lines, lambda x: F.regexp_like(x, F.concat(F.lit("^"), n, F.lit(r"(?:\.|\s|:)"))) & F.exists(words, lambda w: after(x).contains(w)))
    sections = F.regexp_like(head, F.concat(F.lit(r"(?im)(?:\b(?:fig(?:ure)?|table|box)\.?\s*|^)"), n, F.lit(r"\.\d{1,2}\b")))
    others = F.exists(F.regexp_extract_all(head, F.lit(r"(?i)\bchapter\s*(\d{1,3})\b"), F.lit(1)), lambda x: x.cast("int") != number)
    return F.when(said | bare | titled | sections, "confirmed").when(others, "contradicted").otherwise("unknown")
