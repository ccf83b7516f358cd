"""The whole conversion of books: pages and tables in, documents, statistics and chapters out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire import constants as K
from quire.functions import text as T
from quire.operators import chapters, tables
from quire.options import Options


def _joined(parts: Column, between: str) -> Column:
    return F.array_join(F.transform(F.sort_array(parts), lambda r: r["s"]), between)


def convert(pages: DataFrame, found: DataFrame, options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """(document(book, text), stats(book, ...)) from page(book, page, text) and table(book, page, geometry, rows).

    Tables that are page frames or furniture are left out and counted.
    """
    both = converted(pages, found, options)
    return both.select("book", "text"), both.drop("text")


def converted(pages: DataFrame, found: DataFrame, options: Options = Options()) -> DataFrame:
    """The documents and statistics of ``convert`` in one row for each book, made in one pass."""
    c = F.col
    # Exploded, since a condition on a column that is only computed would have it computed twice.
    judged = found.withColumn("md", F.explode(F.array(tables.render(c("rows"), options)))).where("md is not null").withColumn(
        "reason", F.coalesce(tables.frame_reason(c("rows"), c("x0"), c("top"), c("x1"), c("bottom"), c("page_w"), c("page_h"), options), tables.furniture_reason(c("rows"), c("top"), c("bottom"), c("page_h"), options))
    )
    marked = F.concat(F.lit("**[Table on page "), c("page").cast("string"), F.lit("]**\n"), c("md"))
    by_page = judged.groupBy("book", "page").agg(_joined(F.collect_list(F.when(c("reason").isNull(), F.struct(c("top"), marked.alias("s")))), "\n\n").alias("tables"), F.count_if(c("reason").isNull()).alias("kept"), F.count_if(c("reason").isNotNull()).alias("rejected"))
    cleaned = T.clean_text(c("text"))
    p = pages.join(by_page, ["book", "page"], "left").select("book", "page", T.annotate_references(cleaned, c("page")).alias("text"), T.reference_count(cleaned).alias("refs"), F.coalesce("tables", F.lit("")).alias("tables"), F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("rejected", F.lit(0)).alias("rejected"), F.regexp_count(cleaned, F.lit(r"(?m)^(?:TABLE|Table) *\d+")).alias("captions"))
    part = F.concat(F.lit("<!-- page "), c("page").cast("string"), F.lit(" -->\n"), c("text"), F.when(c("tables") != "", F.concat(F.lit("\n\n"), c("tables"))).otherwise(""))
    both = p.groupBy("book").agg(_joined(F.collect_list(F.struct("page", part.alias("s"))), "\n\n").alias("text"), F.count("*").alias("pages"), F.sum("refs").alias("fig_refs"), F.sum("kept").alias("tables"), F.sum("rejected").alias("rejected_tables"), F.sum("captions").alias("table_captions"))
    few = (c("table_captions") >= K.CAPTIONS_MIN) & (c("tables") < K.TABLE_CAPTION_RATIO * c("table_captions"))
    return both.withColumn("few_tables", few if options.book_table_check else F.lit(False))


def chapter_files(pages: DataFrame, outline: DataFrame, options: Options = Options()) -> DataFrame:
    """(book, strategy, n): how each book is split: by bookmarks, else by headings, else (long books) in page ranges."""
    lines = chapters.book_lines(pages)
    marks = chapters.bookmark_chapters(lines, outline, options.same_page_merge).groupBy("book").agg(F.count("*").alias("bookmarks"))
    heads = chapters.detect_chapters(lines).groupBy("book").agg(F.count("*").alias("headings"))
    size = pages.groupBy("book").agg(F.max("page").alias("pages"))
    joined = size.join(marks, "book", "left").join(heads, "book", "left")
    choice = F.when(F.col("bookmarks") > 0, F.struct(F.lit("bookmarks").alias("strategy"), F.col("bookmarks").alias("n"))).when(F.col("headings") > 0, F.struct(F.lit("pattern").alias("strategy"), F.col("headings").alias("n")))
    choice = choice.when(F.col("pages") > K.FORCE_SPLIT_PAGES, F.struct(F.lit("forced").alias("strategy"), F.ceil(F.col("pages") / K.FORCE_SPLIT_CHUNK).alias("n"))).otherwise(F.struct(F.lit("none").alias("strategy"), F.lit(0).cast("long").alias("n")))
    return joined.select("book", choice.alias("c")).select("book", "c.*")
