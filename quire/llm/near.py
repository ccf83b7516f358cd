"""Near-duplicate documents: bottom-k sketches from one hash function.

1. Every text becomes its set of word shingles; texts with the same set form one class at once.
2. A class keeps the k smallest hashes of its set (all, if it has no more).  Two sets that are similar
   enough share a known number of retained values: exactly known for whole sets, known up to a
   probability of ``MISSED`` for others (a binomial tail bounds the draws without replacement).
3. Inverted lists hold, for every class, only its rarest values that any partner must hit (prefix
   filtering); classes with too few values in common with anyone are in no list.  A value's rank among
   its class's values bounds how many more two classes can share, which decides whether a meeting counts.
4. Stars before pairs: every list proposes its members to a few leaders.  Then members outside the
   largest component of a short list meet those of other components.  Classes of long lists that are
   still in several components get sketches ``wide`` / ``k`` times as long, ranked among themselves: what a
   hot group has in common becomes common there too and leaves the lists, and the same two steps settle them.
   Every similar pair that is not connected yet is proposed; nothing is capped.
5. Proposals pass the similarity estimated from the union of both sketches (which is exact for whole
   sets); exact Jaccard on the full shingle sets confirms each other link.

Texts that are null, empty or without words have no shingles and link with nothing.  Rows that share a
doc_id are documents of their own (``common.keyed``) and give a row each.  Ties cannot arise: components are named
by their smallest id.  An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.components import components
from quire.llm.shingles import shingle_sets

#: The probability with which a bound on the values that a similar pair shares may fail.
MISSED = 1e-8
#: Texts of about so many bytes are hashed at once.
CHUNK = 1 << 19


def least_shared(k: int, percent: int) -> int:
    """The largest m such that fewer than m of k draws with ``percent`` chances hit with a probability of ``MISSED`` at most."""
    p, below = percent / 100, 0.0
    for m in range(k):
        below += math.exp(math.lgamma(k + 1) - math.lgamma(m + 1) - math.lgamma(k - m + 1) + m * math.log(p) + (k - m) * math.log(max(1 - p, 1e-300)))
        if below > MISSED:
            return m
    return k


class Bounds:
    """What two sets of sizes na and nb with similarity ``percent`` or more must have in common."""

    def __init__(self, k: int, percent: int):
        self.k, self.percent, self.shared = k, percent, least_shared(k, percent)

    def alike(self, a: Column, b: Column) -> Column:
        """Whether the sizes allow the similarity."""
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def for_any(self, n: Column) -> Column:
        """The least number of retained values shared with any partner."""
        whole = F.ceil(self.percent * n / 100)
        # A partner has at most n * (100 / percent - 1) values that n lacks.
        part = F.least(n, F.lit(self.k)) - F.least(F.floor(n * (100 - self.percent) / self.percent), F.lit(self.k - self.shared))
        return F.greatest(F.lit(1), F.when(100 * n <= self.percent * self.k, whole).otherwise(part)).cast("int")

    def meet(self, na: Column, ia: Column, nb: Column, ib: Column) -> Column:
        """Whether a similar pair can have its rarest shared value at ranks ia and ib (from 0).

        The pair shares t values.  Of the sketch whose largest hash is smaller, every shared value is in the other
        sketch too; it misses no more than the set does, and no more than Bernstein's bound on draws.
        """
        t = F.ceil(self.percent * (na + nb) / (100 + self.percent))
        lost = -math.log(MISSED)

        def least(n: Column) -> tuple[Column, Column]:
            s = F.least(n, F.lit(self.k))
            p = t / n
            draws = s * (1 - p) + lost / 3 + F.sqrt(lost * lost / 9 + 2 * lost * F.greatest(s * p * (1 - p), F.lit(0.0)))
            return s, s - F.least(n - t, F.floor(draws))

        (sa, a), (sb, b) = least(na), least(nb)
        shared = F.greatest(F.least(a, b), F.lit(1))
        return self.alike(na, nb) & (ia <= sa - shared) & (ib <= sb - shared)


def sketches(docs: DataFrame, width: int, k: int, chunk: int | None = None) -> DataFrame:
    """doc_id, n_shingles, set_key (of the whole set) and the k smallest hashes."""
    ddl = "doc_id long, n_shingles long, set_key string, sketch array<long>"
    out_schema = common.arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(1))
            for i, j in common.slices(offsets, chunk or CHUNK):
                sets = list(shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width))
                head = [s[:k] for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(h) for h in head])]).astype(np.int32)
                rows = [batch.column(0).slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array([hashlib.md5(s.tobytes()).hexdigest() for s in sets]), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(head)))]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(rows, out_schema)], schema=out_schema)

    return common.named(docs, "doc_id", "text").mapInArrow(run, ddl)


def both_sides(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """The pairs (a, b) with what ``left`` has for a and ``right`` for b.

    Each side is found by itself, so that only the rows of pairs travel where the pairs are few.
    """
    return pairs.join(left, "a").join(pairs.select("a", "b").join(right, "b"), ["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have a Jaccard similarity of ``percent`` or more."""
    out_schema = common.arrow_schema("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for batch in batches:
            ids = [batch.column(c).to_pylist() for c in (0, 1)]
            found: list[tuple[int, int]] = []
            step = 64
            for i in range(0, batch.num_rows, step):
                sets = []
                for side in (0, 1):
                    own = ids[side][i : i + step]
                    todo = [x for x in dict.fromkeys(own) if x not in kept]
                    at = {x: n for n, x in reversed(list(enumerate(own)))}
                    if sum(map(len, kept.values())) > 1 << 21:
                        kept.clear()
                        todo = list(dict.fromkeys(own))
                    data, offsets = common.text_bytes(batch.column(2 + side).slice(i, step).take(pa.array([at[x] for x in todo], pa.int64())))
                    for p, q in common.slices(offsets, CHUNK):
                        kept.update(zip(todo[p:q], shingle_sets(data[offsets[p] : offsets[q]], offsets[p : q + 1] - offsets[p], width)))
                    sets.append([kept[x] for x in own])
                for a, b, x, y in zip(ids[0][i : i + step], ids[1][i : i + step], *sets):
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    if 100 * same >= percent * (len(x) + len(y) - same):
                        found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], schema=out_schema)

    t = texts.select("doc_id", "text")
    return both_sides(pairs, t.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), t.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))).select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


class _Search:
    """The state of one run: sketches, texts, links found so far and the components they make."""

    def __init__(self, classes: DataFrame, texts: DataFrame, width: int, bounds: Bounds):
        self.classes, self.texts, self.width, self.bounds = classes, texts, width, bounds
        self.links: DataFrame | None = None
        self.of: DataFrame | None = None  # node, component

    def labelled(self, lists: DataFrame) -> DataFrame:
        """The lists with each member's component."""
        return lists.join(self.of.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")

    def test(self, pairs: DataFrame) -> None:
        """Estimate, verify and merge the links among candidate pairs."""
        k, percent = self.bounds.k, self.bounds.percent
        c = self.classes
        left = c.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
        right = c.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
        pairs = common.cut(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
        near = both_sides(pairs, left, right)
        whole = (F.col("na") <= k) & (F.col("nb") <= k)
        same = F.size(F.array_intersect("sa", "sb"))
        union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
        drawn = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union)) >= self.bounds.shared
        near = near.where(F.when(whole, 100 * same >= percent * (F.col("na") + F.col("nb") - same)).otherwise(drawn))
        near = common.cut(near.select("a", "b", whole.alias("whole")), "near")
        found = near.where("whole").select("a", "b").unionByName(verified(near.where("not whole").select("a", "b"), self.texts, self.width, percent))
        with common.small_batches(found.sparkSession):
            found = common.cut(found, "links")
        common.discard(pairs, near)
        if self.links is None:
            self.links = found
        elif found.limit(1).count():
            self.links = self.links.unionByName(found)
        else:
            return
        self.of = common.cut(components(self.links), "components")

    def stars(self, lists: DataFrame, bounds: Bounds, leaders: int) -> None:
        """Propose the members of every list to its smallest one and to others chosen by hashes."""
        own = F.struct("rep", "n", "i")
        chosen = [F.min(F.struct("rep", "n", "i")).alias("p0")]
        chosen += [F.min(F.struct(F.xxhash64("rep", F.lit(j)).alias("h"), own.alias("m")))["m"].alias(f"p{j}") for j in range(1, leaders)]
        led = lists.groupBy("v").agg(F.count("*").alias("c"), *chosen).where("c > 1").drop("c")
        met = lists.join(led, "v").select("rep", "n", "i", F.explode(F.array_distinct(F.array(*[f"p{j}" for j in range(leaders)]))).alias("p"))
        met = met.where((F.col("rep") != F.col("p.rep")) & bounds.meet(F.col("n"), F.col("i"), F.col("p.n"), F.col("p.i")))
        self.test(met.select(F.col("rep").alias("a"), F.col("p.rep").alias("b")))

    def rest(self, lists: DataFrame, bounds: Bounds) -> None:
        """Propose the members outside each list's largest component to those of other components."""
        labelled = common.cut(self.labelled(lists), "labelled")
        main = labelled.groupBy("v", "comp").agg(F.count("*").alias("k")).groupBy("v").agg(F.max(F.struct("k", "comp"))["comp"].alias("main"), F.count("*").alias("parts")).where("parts > 1")
        outside = labelled.join(main.select("v", "main"), "v").where("comp <> main")
        x = outside.select("v", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("i").alias("ia"), F.col("comp").alias("ca"))
        y = labelled.select("v", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("i").alias("ib"), F.col("comp").alias("cb"))
        self.test(x.join(y, "v").where((F.col("ca") != F.col("cb")) & bounds.meet(F.col("na"), F.col("ia"), F.col("nb"), F.col("ib"))).select("a", "b"))
        common.discard(labelled)


def classes_of(sketched: DataFrame) -> DataFrame:
    """One row for each distinct shingle set: rep (its smallest doc_id), n, sketch, set_key."""
    first = F.min(F.struct("doc_id", "n_shingles", "sketch")).alias("m")
    return sketched.where("n_shingles > 0").groupBy("set_key").agg(first).select("set_key", F.col("m.doc_id").alias("rep"), F.col("m.n_shingles").alias("n"), F.col("m.sketch").alias("sketch"))


def rare_lists(classes: DataFrame, bounds: Bounds) -> DataFrame:
    """(v, rep, n, i): for each class that can have a partner, the rarest values that any partner hits and their ranks."""
    postings = classes.select("rep", F.explode("sketch").alias("v"))
    shared = common.cut(postings.groupBy("v").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    common.let_go(classes.sparkSession)
    # Never broadcast: both sides grow with the corpus.
    each = postings.join(shared.hint("merge"), "v").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("vs"))  # k values at most
    each = each.join(classes.select("rep", "n").hint("merge"), "rep")
    # Values that no other class has come first in the order and are not listed.
    alone = F.least(F.col("n"), F.lit(bounds.k)) - F.size("vs")
    need = bounds.for_any(F.col("n"))
    viable = each.where(F.size("vs") >= need).select("rep", "n", alone.alias("alone"), F.posexplode(F.slice("vs", F.lit(1), F.size("vs") - need + 1)).alias("at", "x"))
    lists = common.cut(viable.select(F.col("x.v").alias("v"), "rep", "n", (F.col("alone") + F.col("at")).alias("i")), "lists")
    common.discard(shared)
    return lists


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 64, short: int = 24, wide: int = 1024, leaders: int = 4) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document.

    ``short`` divides lists whose remaining members meet at once from those whose members get sketches
    of ``wide`` values first; both ways propose every similar pair that is not connected.  ``leaders`` is the
    number of members that such lists are proposed to before.
    """
    if not 1 <= percent <= 100 or k < 1 or wide < k:
        raise ValueError("percent must lie in 1..100, k be positive and wide no less than k")
    docs, ids = common.prepared(docs)
    bounds, wider = Bounds(k, percent), Bounds(wide, percent)
    with common.small_batches(docs.sparkSession):
        full = common.cut(sketches(docs, width, k), "sketches")
    classes = common.cut(classes_of(full), "classes")
    sketched = common.cut(full.drop("sketch"), "sets")
    common.discard(full)
    lists = rare_lists(classes.select("rep", "n", "sketch"), bounds)
    common.let_go(docs.sparkSession)
    search = _Search(classes.select("rep", "n", "sketch"), docs, width, bounds)

    search.stars(lists, bounds, 1)
    sizes = lists.groupBy("v").agg(F.count("*").alias("c"))
    search.rest(lists.join(sizes.where((F.col("c") > 1) & (F.col("c") <= short)).select("v"), "v", "left_semi"), bounds)
    long = search.labelled(lists.join(sizes.where(F.col("c") > short).select("v"), "v", "left_semi"))
    open_lists = long.groupBy("v").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("v")
    hot = long.join(open_lists, "v", "left_semi").select(F.col("rep").alias("doc_id")).distinct()
    with common.small_batches(docs.sparkSession):
        again = common.cut(sketches(docs.join(hot, "doc_id", "left_semi"), width, wide).select(F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "sketch"), "wide")
    common.discard(lists)
    lists = rare_lists(again, wider)
    common.let_go(docs.sparkSession)
    if lists.limit(1).count():
        search.stars(lists, wider, leaders)
        search.rest(lists, wider)

    named = classes.select("set_key", "rep").join(search.of.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("set_key", F.coalesce("component", "rep").alias("c"))
    joined = sketched.select("doc_id", "n_shingles", "set_key").join(named, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("c")).otherwise(F.col("doc_id"))
    found = joined.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
    return common.restored(found, "doc_id", "component_id", ids=ids)
