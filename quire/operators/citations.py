"""Chapter index of book folders and checks of citations against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# File-name schemes that carry a chapter number, the most specific first; each has number and title.
SCHEMES = (
    ("E", r"^(?:\d+)_(\d+)[_ ](.+)\.md$"),
    ("B", r"^ch\d+_(\d+)[_ ](.+)\.md$"),
    ("C", r"(?i)^ch\d+_Chapter[_ ]?(\d+)(?:[_ ](.+))?\.md$"),
    ("A", r"^Ch(\d+)[_ ](.+)\.md$"),
    ("D", r"^(\d+)[._](.+)\.md$"),
)
SEQUENCE = r"(?i)^ch(\d+)[_ ](.+)\.md$"
LEAST_CHAPTERS, COMPLETE, LOOKBACK = 3, 0.9, 12
REFERENCE = r"\bCh(?:apter)?\.?[ _]?(\d+)\b"
EDITION = r"(?i)^(?:e\d+|\d+e|\d+(?:st|nd|rd|th))$"


def clean_title(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(F.replace(c, F.lit("_"), F.lit(" "))), r"(?i)\.pdf$", ""), r"\s+", " ")


def chapter_tables(files: DataFrame) -> DataFrame:
    """(folder, strategy, number, title): the first scheme with three chapters, else the file sequence ("seq").

    ``files``: folder, name.  A chapter stub without a title takes the name of the next file.
    """
    w = Window.partitionBy("folder").orderBy("name")
    f = files.withColumn("next", F.lead("name").over(w))
    rows = []
    for rank, (scheme, pattern) in enumerate((*SCHEMES, ("seq", SEQUENCE))):
        hit = f.where(F.col("name").rlike(pattern))
        title = F.nullif(F.regexp_extract("name", pattern, 2), F.lit(""))
        if scheme == "C":
            borrowed = F.when(~F.col("next").rlike(pattern), F.regexp_replace(F.regexp_replace("next", r"\.md$", ""), r"^ch\d+_", ""))
            title = F.coalesce(title, borrowed)
        rows.append(hit.select("folder", F.lit(rank).alias("rank"), F.lit(scheme).alias("strategy"), F.regexp_extract("name", pattern, 1).cast("int").alias("number"), clean_title(title).alias("title"), "name"))
    every = rows[0]
    for r in rows[1:]:
        every = every.unionByName(r)
    first = every.where("title is not null and number > 0").groupBy("folder", "rank", "strategy", "number").agg(F.min_by("title", "name").alias("title"))
    enough = first.groupBy("folder", "rank").count().where(F.col("count") >= LEAST_CHAPTERS).groupBy("folder").agg(F.min("rank").alias("rank"))
    return first.join(enough, ["folder", "rank"]).select("folder", "strategy", "number", "title")


def chapter_index(files: DataFrame) -> DataFrame:
    """(folder, strategy, surname, files, chapters, max_chapter): one row for each folder."""
    table = chapter_tables(files)
    real = F.col("strategy") != "seq"
    by = table.groupBy("folder").agg(F.first("strategy").alias("strategy"), F.count_if(real).alias("chapters"), F.coalesce(F.max(F.when(real, F.col("number"))), F.lit(0)).alias("max_chapter"))
    return files.groupBy("folder").agg(F.count("*").alias("files")).join(by, "folder", "left").select("folder", F.coalesce("strategy", F.lit("none")).alias("strategy"), F.split("folder", "_")[0].alias("surname"), "files", F.coalesce("chapters", F.lit(0).cast("long")).alias("chapters"), F.coalesce("max_chapter", F.lit(0)).alias("max_chapter"))


def scan_references(notes: DataFrame) -> DataFrame:
    """(note, line, ord, names, chapter, edition): every chapter reference of a line with the tokens before it, nearest first.

    ``notes``: note, text.  Text before an open back-tick does not count.  A text that many notes share is
    scanned once.
    """
    found = _scan_texts(notes.select("text").distinct())
    return notes.select("note", "text").join(found, "text").select("note", *[c for c in found.columns if c != "text"])


def _scan_texts(texts: DataFrame) -> DataFrame:
    lines = texts.select("text", F.posexplode(F.split("text", "\n", -1)).alias("line", "s")).where(F.col("s").rlike(REFERENCE))
    pieces = F.split(F.col("s"), REFERENCE, -1)
    found = F.regexp_extract_all("s", F.lit(REFERENCE), F.lit(0))
    numbers = F.regexp_extract_all("s", F.lit(REFERENCE), F.lit(1))
    each = lines.select("text", "line", pieces.alias("pieces"), found.alias("found"), F.posexplode(numbers).alias("ord", "number"))
    # What stands before the reference: the pieces and references before it.
    before = F.array_join(F.flatten(F.zip_with(F.slice("pieces", F.lit(1), F.col("ord") + 1), F.concat(F.slice("found", F.lit(1), F.col("ord")), F.array(F.lit(""))), lambda p, r: F.array(p, r))), "")
    odd = (F.length("before") - F.length(F.replace(F.col("before"), F.lit("`"), F.lit("")))) % 2 == 1
    # Each step is exploded, since conditions on columns that are only computed would have them computed again.
    once = lambda name, c: each.withColumn(name, F.explode(F.array(c)))
    each = once("before", before)
    each = once("before", F.when(odd, F.element_at(F.split("before", "`", -1), -1)).otherwise(F.col("before")))
    tokens = F.filter(F.transform(F.split("before", "[ _]+"), lambda t: F.regexp_replace(t, r"^[`\[\]()*_,;:]+|[`\[\]()*_,;:]+$", "")), lambda t: t != "")
    each = once("tokens", tokens)
    names = F.filter(F.reverse("tokens"), lambda t: ~t.rlike(EDITION) & ~F.replace(t, F.lit("."), F.lit("")).rlike(r"^\d+$") & (F.length(t) > 1))
    each = once("names", F.slice(names, 1, LOOKBACK)).where(F.size("names") > 0)
    return each.select("text", "line", "ord", "names", F.col("number").cast("int").alias("chapter"), F.get(F.filter("tokens", lambda t: t.rlike(EDITION)), F.lit(0)).alias("edition"))


def lint(references: DataFrame, index: DataFrame, table: DataFrame) -> DataFrame:
    """(key columns, verdict): OK, AMBIGUOUS, BAD_CHAPTER or UNVERIFIABLE for every reference.

    ``references``: note, line, ord, names, chapter, edition; ``index`` and ``table`` as above.  The
    nearest name that is a book's surname decides; an edition narrows the books if any matches.  References
    that say the same have the same verdict, so each wording meets the books once.
    """
    own, key = ["note", "line", "ord"], ["wording"]
    references = references.withColumn("wording", F.to_json(F.struct("names", "chapter", "edition")))
    named = references.select(*key, "names", "chapter", "edition").dropDuplicates(key).select(*key, "chapter", "edition", F.posexplode("names").alias("near", "name"))
    hits = named.join(index.withColumn("s", F.lower("surname")), F.regexp_replace(F.lower("name"), "['’]s$", "") == F.col("s"))
    nearest = F.min("near").over(Window.partitionBy(*key))
    hits = hits.withColumn("best", nearest).where("near = best")
    edition = F.regexp_replace(F.regexp_replace(F.lower("edition"), "^e", ""), "(?:st|nd|rd|th|e)$", "")
    hits = hits.withColumn("fits", F.coalesce(F.lower("folder").contains(F.concat(F.lit("_"), edition, F.lit("e_"))), F.lit(True)))
    hits = hits.withColumn("any_fits", F.max("fits").over(Window.partitionBy(*key))).where("fits or not any_fits")
    chapters = table.where("strategy <> 'seq'").select("folder", F.col("number").alias("chapter"), "title")
    mapped = ~F.col("strategy").isin("none", "seq")
    complete = F.col("chapters") >= COMPLETE * F.col("max_chapter")
    by = hits.join(chapters, ["folder", "chapter"], "left").groupBy(*key).agg(
        F.count_if(mapped).alias("mapped"),
        F.count("title").alias("have"),
        F.countDistinct("title").alias("titles"),
        F.count_if(mapped & (F.col("chapter") > F.col("max_chapter")) & complete).alias("provable"),
    )
    verdict = (
        F.when(F.coalesce("mapped", F.lit(0)) == 0, "UNVERIFIABLE")
        .when((F.col("have") == 0) & (F.col("provable") == F.col("mapped")), "BAD_CHAPTER")
        .when(F.col("have") == 0, "UNVERIFIABLE")
        .when(F.col("titles") > 1, "AMBIGUOUS")
        .otherwise("OK")
    )
    return references.select(*own, *key, "chapter", "edition").join(by, key, "left").select(*own, "chapter", "edition", verdict.alias("verdict"))


def owning_chapters(files: DataFrame, sequences: DataFrame) -> DataFrame:
    """(folder, seq, owner): the last numbered file at or before a file sequence number.  ``sequences``: folder, seq."""
    pattern = r"(?i)^ch(\d+)_(\d+)[_ ](.+)\.md$"
    numbered = files.where(F.col("name").rlike(pattern)).select("folder", F.regexp_extract("name", pattern, 1).cast("int").alias("file_no"), F.regexp_extract("name", pattern, 2).cast("int").alias("owner"))
    joined = sequences.join(numbered, "folder", "left").where("file_no is null or file_no <= seq")
    return joined.groupBy("folder", "seq").agg(F.max_by("owner", "file_no").alias("owner"))


def lint_embeds(targets: DataFrame, attachments: DataFrame) -> DataFrame:
    """(note, target, verdict): ok, CASE MISMATCH or MISSING for every embedded attachment.  Inputs: note, target; name."""
    exact = attachments.select(F.col("name").alias("target")).distinct().withColumn("exact", F.lit(True))
    loose = attachments.select(F.lower("name").alias("key")).distinct().withColumn("loose", F.lit(True))
    joined = targets.withColumn("key", F.lower("target")).join(loose, "key", "left").join(exact, "target", "left")
    return joined.select("note", "target", F.when(F.col("exact"), "ok").when(F.col("loose"), "CASE MISMATCH").otherwise("MISSING").alias("verdict"))
