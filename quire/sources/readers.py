"""Readers and writers of corpus files: pages in markdown, OCR lines, manifests, configuration and chapter files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


BLOCK = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("bbox", T.ArrayType(T.DoubleType()))]))
MANIFEST = (
    "book string, schema int, source_pdf string, split_method string, page_labels map<string,string>, page_confidence string, toc_chapters int, chapter_level int, "
    "files array<struct<file string, seq int, chapter_number int, title string, pdf_page_start int, pdf_page_end int, kind string, source_pdf string>>, "
    "sections array<struct<ord int, level int, title string, pdf_page int, file string, kind string>>"
)


def book_of(path: Column) -> Column:
    """The folder a file lies in."""
    return F.element_at(F.split(path, "/"), -2)


def markdown(spark: SparkSession, root: str) -> DataFrame:
    """file(book, file, text) of every markdown file below ``root``, without the assembled full text."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True)
    path = F.col("_metadata.file_path")
    out = files.select(book_of(path).alias("book"), F.element_at(F.split(path, "/"), -1).alias("file"), F.col("value").alias("text"))
    return out.where("file <> 'full_text.md' and not book rlike '^[.]|^_|^figures|^images$'")


def marked_pages(texts: DataFrame) -> DataFrame:
    """page(book, page, text) from texts with page-marker lines; lines before the first marker are page 0."""
    parts = F.split(F.concat(F.lit("\n"), F.col("text")), r"\n[ \t]*(?=<!-- page \d+ -->)", -1)
    each = texts.select("book", F.explode(parts).alias("part"))
    number = F.nullif(F.regexp_extract("part", r"^<!-- page (\d+) -->", 1), F.lit("")).cast("int")
    body = F.regexp_replace("part", r"^<!-- page \d+ -->[ \t]*\n?", "")
    pages = each.select("book", F.coalesce(number, F.lit(0)).alias("page"), body.alias("text"))
    return pages.where((F.col("page") > 0) | F.col("text").rlike(r"\S"))


def ocr_lines(spark: SparkSession, path: str) -> DataFrame:
    """box(book, page, ord, x0, y0, x1, y1, text) from JSON lines with ``image`` (book/page.ext) and ``blocks``; bad lines are skipped."""
    schema = T.StructType([T.StructField("image", T.StringType()), T.StructField("blocks", BLOCK), T.StructField("_corrupt_record", T.StringType())])
    read = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path).where("_corrupt_record is null and image is not null")
    each = read.select(F.split("image", "/").alias("p"), F.posexplode("blocks").alias("ord", "b")).where("size(b.bbox) = 4")
    box = lambda i: F.col("b.bbox")[i]
    corners = [F.least(box(0), box(2)).alias("x0"), F.least(box(1), box(3)).alias("y0"), F.greatest(box(0), box(2)).alias("x1"), F.greatest(box(1), box(3)).alias("y1")]
    return each.select(F.element_at("p", -2).alias("book"), F.regexp_extract(F.element_at("p", -1), r"(\d+)", 1).cast("int").alias("page"), "ord", *corners, F.col("b.text").alias("text"))


def scale(box: list[Column], factor: Column) -> list[Column]:
    """Corners in order, scaled and rounded to whole pixels, halves to even."""
    x0, y0, x1, y1 = box
    return [F.bround(c * factor) for c in (F.least(x0, x1), F.least(y0, y1), F.greatest(x0, x1), F.greatest(y0, y1))]


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row for each ``_manifest.json``; unreadable ones have null fields."""
    return spark.read.schema(MANIFEST).option("multiLine", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", "_manifest.json").json(root)


def sources(spark: SparkSession, root: str, glob: str = "*.pdf") -> DataFrame:
    """source(path, name, time, size, sha256) of files; the content is read only if the hash is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("modificationTime").alias("time"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def write_chapters(lines: DataFrame, chapters: DataFrame, path: str) -> None:
    """Write each chapter's lines as text below ``path``, by book and file.

    ``lines``: book, line_no, text; ``chapters``: book, file, line_start, line_end.
    """
    held = lines.join(chapters, "book").where("line_no >= line_start and line_no < line_end")
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line_no", "text"))), lambda r: r["text"]), "\n")
    held.groupBy("book", "file").agg(text.alias("value")).write.mode("overwrite").partitionBy("book", "file").text(path)


def assemble(pages: DataFrame) -> DataFrame:
    """book(book, text): pages in order, each after its marker."""
    part = F.concat(F.lit("<!-- page "), F.col("page").cast("string"), F.lit(" -->\n"), F.col("text"))
    return pages.groupBy("book").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", part.alias("p")))), lambda r: r["p"]), "\n\n").alias("text"))


