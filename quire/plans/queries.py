"""Registered queries over derived book pages, tables and outlines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import constants as K
from quire.functions import text as T
from quire.operators import chapters as C
from quire.operators import tables as B
from quire.plans import inputs as I


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.pages(spark, sf_dir).select("book", "page", F.md5(T.clean_text(F.col("text"))).alias("cleaned_md5"), T.ligature_count(F.col("text")).cast("long").alias("ligatures"))


def annotate_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.pages(spark, sf_dir)
    return p.select("book", "page", F.md5(T.annotate_references(F.col("text"), F.col("page"))).alias("annotated_md5"), T.reference_count(F.col("text")).cast("long").alias("refs"))


def page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return I.pages(spark, sf_dir).select("book", "page", T.dose_count(t).cast("long").alias("doses"), T.is_continued(t).alias("continued"), T.has_text(t).alias("has_text"), F.array_min(T.page_markers(t)).alias("first_marker"), F.array_max(T.page_markers(t)).alias("last_marker"), T.is_multipanel(t).alias("multipanel"))


def html_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = I.read(spark, sf_dir, "pages", "page_id", "html").withColumn("text", T.html_to_text(F.col("html")))
    return p.select("page_id", F.length("text").cast("long").alias("n_chars"), F.md5("text").alias("text_md5"))


def book_conversion_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per book: pages, references (distinct on a page, then summed), doses, cleaned size, captions and the caption warning."""
    cleaned = T.clean_text(F.col("text"))
    p = I.pages(spark, sf_dir).select("book", "page", cleaned.alias("text"))
    captions = F.regexp_count("text", F.lit(r"(?m)^(?:TABLE|Table) *\d+"))
    by = p.groupBy("book").agg(
        F.count("*").alias("pages"),
        F.sum(T.reference_count(F.col("text"))).alias("fig_refs"),
        F.sum(T.dose_count(F.col("text"))).alias("doses"),
        F.sum(F.length("text")).alias("n_chars"),
        F.sum(captions).alias("table_captions"),
        F.count_if(~T.has_text(F.col("text"))).alias("textless"),
    )
    return by.withColumn("many_captions", F.col("table_captions") >= K.CAPTIONS_MIN)


def heading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.heading_lines(C.book_lines(I.pages(spark, sf_dir))).withColumn("line_no", F.col("line_no").cast("long"))


def detect_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.detect_chapters(C.book_lines(I.pages(spark, sf_dir))).withColumn("line_no", F.col("line_no").cast("long"))


def page_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.page_chunks(I.pages(spark, sf_dir), 6)


def bookmark_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.bookmark_chapters(C.book_lines(I.pages(spark, sf_dir)), I.outline(spark, sf_dir))
    return found.select("book", F.col("number").cast("long").alias("number"), "title", "file", F.col("line_start").cast("long").alias("line_start"), F.col("line_end").cast("long").alias("line_end"))


def outline_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("title")
    return I.outline(spark, sf_dir).select("book", "ord", T.chapter_number(t).alias("number"), T.keyword_chapter_number(t).alias("keyword_number"), T.strip_numbering(t).alias("bare_title"), T.classify_kind(t).alias("kind"))


def chapter_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.chapter_levels(I.outline(spark, sf_dir))


def chapter_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = I.outline(spark, sf_dir)
    levels = o.select("book").distinct().withColumn("level", (F.col("book") % 3 + 1).cast("int"))
    return C.chapter_states(o, levels).select("book", "ord", "chapter")


def numbering_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = I.outline(spark, sf_dir)
    return C.numbering_gaps(o, o.select("book").distinct().withColumn("level", (F.col("book") % 3 + 1).cast("int")))


def file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = (F.col("book") % 5 + 1).cast("int")
    return I.pages(spark, sf_dir).select("book", "page", C.file_verdict(F.substring("text", 1, 6000), number, F.lit("Hip and Groin Region")).alias("verdict"))


def table_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.tables(spark, sf_dir).select("t", F.md5(B.render(F.col("rows"))).alias("md_md5"))


def table_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return I.tables(spark, sf_dir).select("t", B.frame_reason(c("rows"), c("x0"), c("top"), c("x1"), c("bottom"), c("page_w"), c("page_h")).alias("frame"), B.furniture_reason(c("rows"), c("top"), c("bottom"), c("page_h")).alias("furniture"))


def table_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = I.tables(spark, sf_dir)
    rows = F.col("rows")
    return t.select("t", F.array_join(B.ragged_rows(rows), ",").alias("ragged"), F.array_join(B.empty_first_cells(rows), ",").alias("unlabelled"), B.run_together_cells(rows).cast("long").alias("run_together"), B.multi_value_hits(rows).alias("multi_values"), (B.column_count(rows) == 1).alias("single_column"))


def fake_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = I.tables(spark, sf_dir).withColumn("cleaned", B.clean_rows(F.col("rows")))
    return t.select("t", B.fake_table(F.col("cleaned")).alias("reason"), F.md5(B.demote(F.col("cleaned"))).alias("plain_md5"))


def content_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source text of a table is that of its cells plus a word, with two cells glued."""
    t = I.tables(spark, sf_dir)
    cells = F.flatten("rows")
    source = F.concat_ws(" ", F.lit("Titubation item3"), F.get(cells, F.lit(0)), F.get(cells, F.lit(1)), F.lit("inflammationcorticosteroids reduceinflammation"))
    return t.select("t", F.array_join(B.missing_tokens(source, cells), " ").alias("missing"))


def reversed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables whose words are reversed for every fifth, against a page with the words as written."""
    t = I.tables(spark, sf_dir)
    words = F.array(*[F.lit(w) for w in ("gait balance", "stroke spasm", "therapy level", "muscle")])
    turned = F.transform(words, lambda w: F.when(F.col("t") % 5 == 0, F.reverse(w)).otherwise(w))
    direction = B.token_directions(F.array(F.slice(turned, 1, 2), F.slice(turned, 3, 2)), F.array_join(words, " "))
    return t.select("t", B.is_reversed(direction).alias("reversed"), F.aggregate(direction, F.lit(0), lambda n, d: n + d["backward"]).alias("backward"))


def grid_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells placed by line keys into a grid of 6 x 4, spans of 1 to 3."""
    cells = I.read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS t", "l_partkey * 1000 + l_suppkey AS ord", "CAST(l_partkey % 5 AS INT) AS start_row", "CAST(l_partkey % 5 + 1 + l_suppkey % 3 AS INT) AS end_row",
        "CAST(l_suppkey % 4 AS INT) AS start_col", "CAST(l_suppkey % 4 + 1 + l_partkey % 2 AS INT) AS end_col", "concat('c', CAST(l_partkey * 1000 + l_suppkey AS STRING)) AS text", "6 AS n_rows", "4 AS n_cols",
    )
    return B.grid(cells, ["t"])


def continuation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = I.tables(spark, sf_dir)
    strict, loose = B.continuations(t), B.continuations(t, heading_veto=False)
    return strict.select("t", F.col("resumes").alias("merges")).join(loose.select("t", F.col("resumes").alias("flagged")), "t")


def merge_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = B.merge_chains(I.tables(spark, sf_dir))
    return m.select("book", "page", F.array_join("pages", ",").alias("pages"), F.md5("md").alias("md_md5"))


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in question, with the text of the page of the same number."""
    t = B.continuations(I.tables(spark, sf_dir), heading_veto=False).withColumn("md", B.render(F.col("rows")))
    p = I.pages(spark, sf_dir).select((F.col("book") * 20 + F.col("page")).alias("t"), "text")
    joined = t.join(p, "t", "left").withColumn("reasons", B.review_reasons(F.coalesce("md", F.lit("")), F.coalesce("text", F.lit("")), F.lit(False), F.col("resumes")))
    return joined.where(F.size("reasons") > 0).select("t", F.array_join("reasons", "; ").alias("reasons"))


def queries() -> dict:
    from quire.plans import corpus_queries

    own = [clean_text, annotate_references, page_signals, html_to_text, book_conversion_stats, heading_lines, detect_chapters, page_chunks, bookmark_chapters, outline_titles, chapter_levels, chapter_states, numbering_gaps, file_verdicts, table_render, table_rejects, table_checks, fake_tables, content_retention, reversed_tables, grid_fill, continuation_flags, merge_chains, review_queue]
    return {f.__name__: f for f in own} | corpus_queries.queries()
