"""Line deduplication by prefix doubling over line-id sequences, in DataFrame functions only.

A document is a sequence of line ids.  Prefix doubling names the run of 2h lines at a position by the
names of the runs of h lines at that position and h lines on; a run of ``min_lines`` lines is named by
its two overlapping runs of the largest power of two that fits.  Positions with the same name form an
interval of the suffix order whose common prefix has ``min_lines`` lines or more, whatever the order of
the intervals, so names need not be sorted ranks.  All but the first position of an interval (smallest
doc_id, then first line) are later copies; neighbouring later copies join to maximal repeated runs, and
their lines are deleted.  Names are 128 bits wide.

Null texts count as empty (one empty line).  Runs that hold no visible character are left alone.
Documents shorter than ``min_lines`` lines keep all lines.  Rows that share a doc_id are documents
of their own (``common.keyed``).  Very common lines meet in partial aggregates and in a join that may be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common


def doubled(names: Column, step: int) -> Column:
    """Names of runs twice as long: the name at i joined with the name at i + step."""
    n = F.size(names) - step
    pair = F.zip_with(F.slice(names, F.lit(1), n), F.slice(names, F.lit(step + 1), n), lambda a, b: F.struct(F.xxhash64(a["x"], b["x"]).alias("x"), F.xxhash64(b["y"], a["y"], F.lit(step)).alias("y")))
    return F.when(n > 0, pair).otherwise(F.slice(names, 1, 0))


def run_names(lines: Column, length: int) -> Column:
    """The name of the run of ``length`` lines at every position that has one."""
    names = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("x"), F.xxhash64(x, F.lit(1)).alias("y")))
    step = 1
    while step * 2 <= length:
        names = doubled(names, step)
        step *= 2
    return doubled(names, length - step) if length > step else names


def later_runs(docs: DataFrame, min_lines: int, passage_words: int | None = None) -> DataFrame:
    """(doc_id, runs): the maximal runs of lines, as [s, e) from 0, that are later copies.  ``docs`` comes from ``prepared``."""
    lines = F.split("text", "\n", -1)
    seen = docs.select("doc_id", lines.alias("lines")).where(F.size("lines") >= min_lines)
    # Whether a run has a visible character is part of what is exploded, not of its name.
    visible = F.transform("lines", lambda x: F.length(F.regexp_replace(x, r"\s+", "")) > 0)
    at = seen.select("doc_id", visible.alias("visible"), run_names(F.col("lines"), min_lines).alias("names"))
    pieces = [_later(at, min_lines)]
    if passage_words is not None and min_lines > 1:
        # Lines that are no passage count as without a visible character.
        passage = F.transform("lines", lambda x: F.regexp_count(x, F.lit(r"\S+")) >= passage_words)
        alone = docs.select("doc_id", lines.alias("lines")).select("doc_id", passage.alias("visible"), run_names(F.col("lines"), 1).alias("names"))
        pieces.append(_later(alone, 1))
    later = pieces[0] if len(pieces) == 1 else pieces[0].unionByName(pieces[1])
    w = Window.partitionBy("doc_id").orderBy("s", "e")
    reached = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    island = later.withColumn("new", F.coalesce((F.col("s") > reached).cast("int"), F.lit(1))).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = island.groupBy("doc_id", "island").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return runs.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("runs"))


def _later(at: DataFrame, min_lines: int) -> DataFrame:
    """(doc_id, s, e): the runs of ``min_lines`` lines that are later copies; ``at`` has visible and names for each document."""
    at = at.select("doc_id", "visible", F.posexplode("names").alias("pos", "name")).where(F.exists(F.slice("visible", F.col("pos") + 1, min_lines), lambda v: v))
    at = at.select("doc_id", "pos", F.col("name.x").alias("x"), F.col("name.y").alias("y"))
    first = at.groupBy("x", "y").agg(F.count("*").alias("c"), F.min(F.struct("doc_id", "pos")).alias("first")).where("c > 1").drop("c")
    return at.join(first, ["x", "y"]).where(F.struct("doc_id", "pos") > F.col("first")).select("doc_id", F.col("pos").alias("s"), (F.col("pos") + min_lines).alias("e"))


def line_dedup(docs: DataFrame, min_lines: int = 2, passage_words: int | None = None) -> DataFrame:
    """doc_id, text (without later copies), n_lines, n_removed, n_runs, longest_run for every document.

    With ``passage_words``, a single line of as many words or more is a run of its own.
    """
    if min_lines < 1:
        raise ValueError("min_lines must be 1 or more")
    docs, ids = common.prepared(docs)
    joined = docs.join(later_runs(docs, min_lines, passage_words).hint("shuffle_hash"), "doc_id", "left").withColumn("lines", F.split("text", "\n", -1))
    size = F.size("lines")
    # What stays lies between the runs: before the first, between neighbours, after the last.
    froms = F.concat(F.array(F.lit(0)), F.transform("runs", lambda r: r["e"]))
    tos = F.concat(F.transform("runs", lambda r: r["s"]), F.array(size))
    kept = F.flatten(F.zip_with(froms, tos, lambda a, b: F.slice(F.col("lines"), a + 1, b - a)))
    removed = F.aggregate("runs", F.lit(0), lambda n, r: n + r["e"] - r["s"])
    none = F.col("runs").isNull()
    zero = F.lit(0).cast("long")
    out = joined.select(
        "doc_id",
        F.when(none, F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        size.cast("long").alias("n_lines"),
        F.when(none, zero).otherwise(removed.cast("long")).alias("n_removed"),
        F.when(none, zero).otherwise(F.size("runs").cast("long")).alias("n_runs"),
        F.when(none, zero).otherwise(F.array_max(F.transform("runs", lambda r: r["e"] - r["s"])).cast("long")).alias("longest_run"),
    )
    return common.restored(out, ids=ids)
