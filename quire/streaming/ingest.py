"""Incremental ingest: new page files are cleaned and counted once; a checkpoint replaces the progress file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions import text as T

PAGES = "book string, page int, text string"


def page_stream(spark: SparkSession, path: str, per_trigger: int = 1000) -> DataFrame:
    """New Parquet files of page(book, page, text) below a folder."""
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", per_trigger).parquet(path)


def cleaned(pages: DataFrame) -> DataFrame:
    """page(book, page, text, refs, doses) with clean, annotated text."""
    text = T.clean_text(F.col("text"))
    return pages.select("book", "page", T.annotate_references(text, F.col("page")).alias("text"), T.reference_count(text).alias("refs"), T.dose_count(text).alias("doses"))


def ingest(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Take in what is new and stop; a second call takes in only files that came since."""
    stream = cleaned(page_stream(spark, source))
    return stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_windows(events: DataFrame, length: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """(window, event_type, n): events in tumbling windows; later ones than the watermark are dropped."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", length), "event_type").agg(F.count("*").alias("n"))
