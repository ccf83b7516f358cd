"""A training-data pipeline over ``documents``: each stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import common, language, lines, near, queries, repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A text whose best language profile is less similar than this is in none of the learned languages.
LEAST_SCORE = 0.2
#: A repeated line of so many words goes whatever stands around it.
PASSAGE_WORDS = 50


def _documents(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of documents with a key for every row, and (doc_id, text) with that key as doc_id."""
    d = common.keyed(common.named(docs, *COLUMNS))
    return d, d.select(F.col("key").alias("doc_id"), "text")


def _changed(d: DataFrame, changed: DataFrame) -> DataFrame:
    """Documents with the texts of ``changed`` (doc_id, text), without those that it lacks."""
    new = changed.select(F.coalesce("doc_id", F.lit(common.NO_ID)).alias("key"), F.col("text").alias("new"))
    return d.drop("text", "n_chars").join(new, "key").select("doc_id", F.col("new").alias("text"), "lang", "source", F.length("new").cast("long").alias("n_chars"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those that resemble no learned language, go."""
    found = language.language_id(docs, keep=COLUMNS)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of lines and of lone passages go; a document that loses every line goes."""
    docs, texts = _documents(docs)
    found = lines.line_dedup(texts, passage_words=PASSAGE_WORDS)
    return _changed(docs, found.where("n_removed < n_lines"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays."""
    docs, texts = _documents(docs)
    kept = near.near_duplicates(texts, width=5, percent=80).where("kept").select(F.coalesce("doc_id", F.lit(common.NO_ID)).alias("key"))
    return docs.join(kept, "key", "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that occur earlier are removed; a document that loses all its text goes."""
    docs, texts = _documents(docs)
    found = repeats.repeated_spans(texts, length=100, with_text=True)
    return _changed(docs, found.where((F.col("n_removed") == 0) | (F.length("kept") > 0)).select("doc_id", F.col("kept").alias("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 2048 tokens."""
    return queries.packing_of(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("minhash_near_dedup", minhash_near_dedup), ("suffix_dedup", suffix_dedup), ("packing", packing)]
#: Sketches, profiles and tokenisation are not expressible in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
