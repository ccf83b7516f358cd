"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is set only where none is configured (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file:///tmp/quire-checkpoints"
    return base


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/quire-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "lz4").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Rows go to Python in batches of ``rows`` at most, so that buffers for long texts stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def let_go(spark: SparkSession) -> None:
    """Have the shuffles that nothing reads any more deleted; what the last job still held goes in a second round."""
    gc.collect()
    for _ in range(2):
        spark._jvm.System.gc()
        time.sleep(0.4)


def discard(*frames: DataFrame) -> None:
    """Delete what ``cut`` or ``cut_by`` wrote for frames that nothing reads any more, and let go of the shuffles before it."""
    for df in frames:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/quire-" in folder or "/quire_" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(conf).delete(path, True)
                label = folder.rpartition("/")[2]
                if label.startswith("quire_"):
                    df.sparkSession.sql(f"DROP TABLE IF EXISTS {label}")
        jvm.System.gc()


def cut_by(df: DataFrame, key: str, parts: int, name: str) -> DataFrame:
    """Cut the lineage and keep the rows dealt by ``key`` into ``parts`` buckets, so that joins on it need no shuffle.

    ``df`` should be dealt by ``key`` into as many partitions already; each then writes one file.
    """
    label = f"quire_{name}_{uuid.uuid4().hex}"
    df.write.format("parquet").option("compression", "zstd").option("path", f"{shared_dir(df.sparkSession)}/{label}").bucketBy(parts, key).saveAsTable(label)
    return df.sparkSession.table(label)


def named(df: DataFrame, *columns: str) -> DataFrame:
    """Only the columns an operator needs, so that extra columns of any name cannot clash."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one array, and the offsets of its rows (null: empty)."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each; a longer row comes alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (murmur3's), elementwise."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_SCALARS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of "name type, ..."; scalar types need no session, so executors can use it too."""
    parts = [x.strip().split(" ") for x in ddl.split(",")]
    if all(len(x) == 2 and x[1] in _SCALARS for x in parts):
        return pa.schema([(name.strip("`"), _SCALARS[kind]) for name, kind in parts])
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))


#: Stands for a null doc_id inside operators that join on it; the smallest long, so it comes first.
NO_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``key``, a long of its own for every row that orders rows by doc_id (null first).

    It is the doc_id where no two rows share one.  Else rows are numbered by doc_id, a hash of the text and
    the text; rows that agree in all of them are interchangeable and come in any order.
    """
    d = docs.withColumn("key", F.coalesce(F.col("`doc_id`").cast("long"), F.lit(NO_ID)))
    if not d.groupBy("key").count().where("count > 1").limit(1).count():
        return d
    text = F.coalesce(F.col("`text`"), F.lit(""))
    # The copy number spreads equal rows over the ranges of the sort.
    ordered = d.withColumn("copy", F.monotonically_increasing_id()).orderBy("key", F.xxhash64(text), text, "copy")
    return cut(ordered.drop("key", "copy").withColumn("key", F.monotonically_increasing_id()), "keyed")


def prepared(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) with a doc_id of its own for every row (``keyed``), and (key, id) to turn it back (``restored``).

    A null text counts as empty.
    """
    d = keyed(named(docs, "doc_id", "text"))
    return d.select(F.col("key").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")), d.select("key", F.col("doc_id").cast("long").alias("id"))


def restored(df: DataFrame, *columns: str, ids: DataFrame | None = None) -> DataFrame:
    """``df`` with the ids of the rows: null for ``NO_ID``, or by ``ids`` from ``prepared``."""
    columns = columns or ("doc_id",)
    if ids is None or not any("/quire-keyed-" in f for f in ids.inputFiles()[:1]):  # keys are the ids
        return df.withColumns({c: F.nullif(F.col(c), F.lit(NO_ID)) for c in columns})
    order = df.columns
    for c in columns:
        df = df.join(ids.select(F.col("key").alias(c), "id"), c, "left").drop(c).withColumnRenamed("id", c)
    return df.select(*order)


def ranges(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [begin, end), and the range that each comes from."""
    n = np.maximum(end - begin, 0)
    total = np.cumsum(n)
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(total[-1] if len(n) else 0) - np.repeat(total - n, n) + begin[of], of


def runs(*keys: np.ndarray) -> np.ndarray:
    """True where sorted key columns differ from the row before."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return new
