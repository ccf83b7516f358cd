"""Repeated strings of a corpus by prefix-free parsing.

A rolling hash over ``TRIGGER`` bytes starts a phrase wherever it is the least of a neighbourhood, so
equal strings are parsed equally and no phrase is longer than the neighbourhood.  A string of
``length`` bytes holds the trigger that is least among its first ``reach`` positions, at offset t: it is
a phrase suffix of t bytes followed by the next ``length - t`` bytes of the parse, and two such strings
are equal if both parts are.  The suffixes of the parse therefore fall into classes that agree on the
next bytes (equal first ``core`` bytes, then equal phrase suffix and whole context), and those classes
are what a suffix array of dictionary and parse delimits by common prefixes of ``length`` bytes.  Only
the classes matter for removal, so they are kept by fingerprints in place of sorted ranks.

Passes:
1. every phrase start sends a short fingerprint of its core; starts whose core occurs once are done;
2. the others send core and whole context (phrase suffix and ``length`` bytes): a context that occurs
   earlier is repeated as a whole; the first of several different contexts of one core is an edge;
3. edges send the fingerprint of each of their strings, and later ones are repeats.
Chunks of documents send each fingerprint once (the rest is settled on the spot), packed into one
binary row for each bucket; buckets are dealt by fingerprint, so a very common passage is spread out.
Fingerprints that decide a removal have 128 bits.

Null texts count as empty; texts shorter than ``length`` keep all bytes; ties cannot arise, since
(doc_id, start) orders all strings.  Rows that share a doc_id are documents of their own (``common.keyed``).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.common import mix, ranges, runs
from quire.llm.shingles import prefix_hash, span_hash

TRIGGER = 8
CHUNK = 1 << 19


def least_of(h: np.ndarray, reach: int) -> np.ndarray:
    """For every position the first of the least of the next ``reach`` hashes (positions below 2**31)."""
    n = len(h)
    blocks = -(-(n + reach) // reach)
    key = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
    key[:n] = (h & ~np.uint64(0x7FFFFFFF)) | np.arange(n, dtype=np.uint64)
    grid = key.reshape(blocks, reach)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)  # the least from a block's begin
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)  # the least up to a block's end
    return (np.minimum(behind[:n], ahead[reach - 1 : n + reach - 1]) & np.uint64(0x7FFFFFFF)).astype(np.int64)


class Parse:
    """The phrase starts of some documents and the strings [low, high] that belong to each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, core: int):
        self.offsets, self.length, self.core = offsets, length, core
        self.c = c = prefix_hash(data)
        n, reach = len(data), length - core + 1
        at = np.arange(max(0, n - TRIGGER + 1))
        least = least_of(mix(span_hash(c, at, at + TRIGGER)), reach)
        first = offsets[:-1]
        s, doc = ranges(first, offsets[1:] - length + 1)  # every string of every document
        a = least[s]
        new = np.flatnonzero(runs(a, doc))
        self.start, self.doc = a[new], doc[new]
        self.low, self.high = s[new], s[np.append(new[1:], len(s)) - 1] if len(new) else s[:0]

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """For all starts: the document, and the offset in it."""
        return self.doc, self.start - self.offsets[self.doc]

    def core_keys(self) -> np.ndarray:
        return mix(span_hash(self.c, self.start, self.start + self.core))

    def context_keys(self) -> np.ndarray:
        shape = ((self.start - self.low) * 1024 + self.high - self.low + 1).astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
        return mix(span_hash(self.c, self.low, self.high + self.length) + shape)

    def string_keys(self, start: np.ndarray) -> np.ndarray:
        return mix(span_hash(self.c, start, start + self.length) + np.uint64(3))


def pack(doc_ids: np.ndarray, *columns: np.ndarray) -> bytes:
    """Rows ordered by document: distinct ids, rows of each, and the columns."""
    new = np.flatnonzero(runs(doc_ids))
    each = np.diff(np.append(new, len(doc_ids))).astype("<u4")
    return b"".join([np.array([len(new), len(doc_ids)], "<i8").tobytes(), doc_ids[new].astype("<i8").tobytes(), each.tobytes(), *(c.tobytes() for c in columns)])


def unpack(blobs: list[bytes], *kinds: str) -> list[np.ndarray]:
    """Document ids and columns of packed rows."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], *[[np.zeros(0, k)] for k in kinds]]
    for blob in blobs:
        n_docs, n = np.frombuffer(blob, "<i8", 2).tolist()
        at = 16
        ids, each = np.frombuffer(blob, "<i8", n_docs, at), np.frombuffer(blob, "<u4", n_docs, at + 8 * n_docs)
        at += 12 * n_docs
        out[0].append(np.repeat(ids, each))
        for i, kind in enumerate(kinds):
            out[i + 1].append(np.frombuffer(blob, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(x) for x in out]


ROWS = "bucket int, known boolean, payload binary"


def _emit(buckets: int, key: np.ndarray, known: np.ndarray, doc_ids: np.ndarray, columns: list[np.ndarray], known_columns: list[np.ndarray]) -> Iterator[tuple[int, bool, bytes]]:
    """Packed rows for each bucket; what is known already goes to one bucket of its own."""
    bucket = ((key >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
    send = np.flatnonzero(~known[0])
    send = send[np.lexsort((doc_ids[send], bucket[send]))]
    heads = np.flatnonzero(runs(bucket[send])) if len(send) else np.zeros(0, np.int64)
    for a, b in zip(heads.tolist(), np.append(heads[1:], len(send)).tolist()):
        rows = send[a:b]
        yield int(bucket[rows[0]]), False, pack(doc_ids[rows], *(c[rows] for c in columns))
    told = np.flatnonzero(known[1])
    if len(told):
        told = told[np.argsort(doc_ids[told], kind="stable")]
        yield int(key[told[0]] % np.uint64(buckets)), True, pack(doc_ids[told], *(c[told] for c in known_columns))


def _mapped(frame: DataFrame, work: Callable[[np.ndarray, np.ndarray, np.ndarray, list], Iterator[tuple]], ddl: str, lists: int) -> DataFrame:
    """Apply ``work(data, offsets, doc_ids, mark lists)`` to chunks of (doc_id, text, columns of packed marks)."""
    out_schema = common.arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(1))
            ids = batch.column(0).to_numpy()
            for i, j in common.slices(offsets, CHUNK):
                marks = [[np.sort(np.frombuffer(x or b"", "<u4").astype(np.int64)) for x in batch.column(2 + c).slice(i, j - i).to_pylist()] for c in range(lists)]
                made = list(work(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], ids[i:j], marks))
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made), out_schema)], schema=out_schema)

    return frame.mapInArrow(run, ddl)


def _reduced(frame: DataFrame, work: Callable[[list[bytes], list[bytes]], Iterator[tuple[np.ndarray, ...]]], parts: int, kinds: int = 1) -> DataFrame:
    """(doc_id, m0, m1, ...): apply ``work(packed rows, packed known rows)`` to each bucket and bring its marks to their documents.

    ``work`` gives document ids, marks and, for several kinds of marks, the kind.  A bucket sends one packed
    row to each part of the documents, and a part gives one row for each of its documents.
    """
    sent_schema = common.arrow_schema("part int, payload binary")
    ddl = "doc_id long" + "".join(f", m{k} binary" for k in range(kinds))
    out_schema = common.arrow_schema(ddl)

    def judge(table: pa.Table) -> pa.Table:
        known, payload = table.column("known").to_pylist(), table.column("payload").to_pylist()
        ids, marks, *kind = work([p for p, k in zip(payload, known) if not k], [p for p, k in zip(payload, known) if k])
        kind = kind[0] if kind else np.zeros(len(ids))
        part = (mix(ids.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((ids, part))
        ids, marks, kind, part = ids[order], marks[order].astype("<u4"), kind[order].astype("u1"), part[order]
        heads = np.flatnonzero(runs(part)) if len(ids) else np.zeros(0, np.int64)
        rows = [(int(part[a]), pack(ids[a:b], marks[a:b], kind[a:b])) for a, b in zip(heads.tolist(), np.append(heads[1:], len(ids)).tolist())]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(sent_schema)], schema=sent_schema)

    def gather(table: pa.Table) -> pa.Table:
        ids, marks, kind = unpack(table.column("payload").to_pylist(), "<u4", "u1")
        order = np.lexsort((marks, ids))
        ids, marks, kind = ids[order], marks[order], kind[order]
        heads = np.flatnonzero(runs(ids)) if len(ids) else np.zeros(0, np.int64)
        spans = list(zip(heads.tolist(), np.append(heads[1:], len(ids)).tolist()))
        columns = [ids[heads].tolist(), *([marks[a:b][kind[a:b] == k].tobytes() for a, b in spans] for k in range(kinds))]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema)], schema=out_schema)

    return frame.groupBy("bucket").applyInArrow(judge, "part int, payload binary").groupBy("part").applyInArrow(gather, ddl)


def _chosen(parse: Parse, marks: list[np.ndarray]) -> np.ndarray:
    """Which of the parse's starts are named by the documents' marks."""
    doc, mark = parse.marks()
    wanted = np.concatenate([np.zeros(0, np.int64), *[(d << 33) + m for d, m in enumerate(marks) if len(m)]])
    return np.isin((doc << 33) + mark, wanted)


def repeated_spans(docs: DataFrame, length: int = 100, with_text: bool = False, bucket_bytes: int = 8 << 20) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every document.

    Removed is each byte covered by a string of ``length`` bytes that also starts earlier (smaller
    doc_id, or the same document and an earlier start); strings are judged on the input.  With
    ``with_text`` the remaining text is a further column ``kept``; a character goes only if all of its
    bytes are removed.
    """
    if length < 48:
        raise ValueError("length must be 48 or more")
    core = length * 23 // 50
    spark = docs.sparkSession
    docs, ids_of = common.prepared(docs)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))

    def cores(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, _: list) -> Iterator[tuple]:
        parse = Parse(data, offsets, length, core)
        doc, mark = parse.marks()
        key = parse.core_keys()
        order = np.argsort(key, kind="stable")
        new = runs(key[order])
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1 if len(key) else np.zeros(0, bool)
        first, shared = np.zeros(len(key), bool), np.zeros(len(key), bool)
        first[order], shared[order] = new, several
        yield from _emit(buckets, key, (~first, shared), ids[doc], [key.astype(np.uint32), mark.astype(np.uint32)], [mark.astype(np.uint32)])

    def shared_cores(blobs: list[bytes], known: list[bytes]) -> tuple[np.ndarray, ...]:
        ids, key, mark = unpack(blobs, "<u4", "<u4")
        order = np.argsort(key, kind="stable")
        group = np.cumsum(runs(key[order])) - 1
        hit = order[np.bincount(group)[group] > 1] if len(key) else order
        more, marks = unpack(known, "<u4")
        return np.append(ids[hit], more), np.append(mark[hit], marks)

    flags = _reduced(_mapped(docs, cores, ROWS, 0), shared_cores, buckets).withColumnRenamed("m0", "marks")
    # Texts are dealt by document once and stored that way, so that later passes meet them without a shuffle.
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    joined = docs.repartition(parts, "doc_id").join(flags.hint("shuffle_hash"), "doc_id", "left").select("doc_id", "text", "marks")
    clean = F.col("marks").isNull()
    # Documents without a shared core are done; only the others keep their text for the later passes.
    stored = joined.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.when(clean, F.sha2(F.col("text").cast("binary"), 256)).alias("kept_sha256"), *([F.col("text")] if with_text else [F.when(~clean, F.col("text")).alias("text")]), "marks")
    stored = common.cut_by(stored, "doc_id", parts, "flagged")
    open_ = stored.where("kept_sha256 is null").select("doc_id", "text", "marks")

    def contexts(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, marks: list) -> Iterator[tuple]:
        parse = Parse(data, offsets, length, core)
        doc, mark = parse.marks()
        use = np.flatnonzero(_chosen(parse, marks[0]))
        doc, mark, key, context = doc[use], mark[use], parse.core_keys()[use], parse.context_keys()[use]
        order = np.lexsort((mark, ids[doc], context, key))
        later = np.zeros(len(use), bool)
        later[order] = ~runs(key[order], context[order])
        yield from _emit(buckets, key, (later, later), ids[doc], [key, context, mark.astype(np.uint32)], [mark.astype(np.uint32)])

    def judged(blobs: list[bytes], known: list[bytes]) -> tuple[np.ndarray, ...]:
        ids, key, context, mark = unpack(blobs, "<u8", "<u8", "<u4")
        order = np.lexsort((mark, ids, context, key))
        ids, key, context, mark = ids[order], key[order], context[order], mark[order]
        first = runs(key, context)
        group = np.cumsum(runs(key)) - 1
        contexts_of = np.bincount(group, first)[group] if len(key) else np.zeros(0)
        edge = first & (contexts_of > 1)
        more, marks = unpack(known, "<u4")
        hit = np.flatnonzero(~first | edge)
        return np.append(ids[hit], more), np.append(mark[hit], marks), np.append(edge[hit].astype(np.int64), np.zeros(len(more), np.int64))

    verdicts = common.cut(_reduced(_mapped(open_, contexts, ROWS, 1), judged, buckets, kinds=2), "verdicts")
    edges = verdicts.where(F.octet_length("m1") > 0).select("doc_id", "m1")

    def strings(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, marks: list) -> Iterator[tuple]:
        parse = Parse(data, offsets, length, core)
        use = np.flatnonzero(_chosen(parse, marks[0]))
        start, of = ranges(parse.low[use], parse.high[use] + 1)
        doc = parse.doc[use][of]
        key, more = parse.string_keys(start), parse.core_keys()[use][of]
        at = start - offsets[doc]
        order = np.lexsort((at, ids[doc], more, key))
        later = np.zeros(len(start), bool)
        later[order] = ~runs(key[order], more[order])
        yield from _emit(buckets, key, (later, later), ids[doc], [key, more, at.astype(np.uint32)], [at.astype(np.uint32)])

    def later_strings(blobs: list[bytes], known: list[bytes]) -> tuple[np.ndarray, ...]:
        ids, key, more, at = unpack(blobs, "<u8", "<u8", "<u4")
        order = np.lexsort((at, ids, more, key))
        hit = order[~runs(key[order], more[order])] if len(order) else order
        told, starts = unpack(known, "<u4")
        return np.append(ids[hit], told), np.append(at[hit], starts)

    starts = _reduced(_mapped(open_.select("doc_id", "text").join(edges.hint("shuffle_hash"), "doc_id"), strings, ROWS, 1), later_strings, buckets).withColumnRenamed("m0", "starts")
    whole = verdicts.where(F.octet_length("m0") > 0).select("doc_id", F.col("m0").alias("repeated"))
    last = open_.select("doc_id", "text").join(whole.hint("shuffle_hash"), "doc_id", "left").join(starts.hint("shuffle_hash"), "doc_id", "left")

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text

    def assembled(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, marks: list) -> Iterator[tuple]:
        parse = Parse(data, offsets, length, core)
        at = np.flatnonzero(_chosen(parse, marks[0]))
        step = np.zeros(len(data) + 1, np.int64)
        from_ = [parse.low[at], *[offsets[d] + m for d, m in enumerate(marks[1]) if len(m)]]
        to = [parse.high[at] + length, *[x + length for x in from_[1:]]]
        np.add.at(step, np.concatenate(from_), 1)
        np.subtract.at(step, np.concatenate(to), 1)
        gone = np.cumsum(step[:-1]) > 0
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            out = gone[a:b]
            kept = data[a:b][~out]
            row = (int(ids[i]), b - a, int(out.sum()), int((out[1:] & ~out[:-1]).sum() + (b > a and bool(out[0]))), hashlib.sha256(kept.tobytes()).hexdigest())
            yield (*row, _whole_characters(data[a:b], out)) if with_text else row

    done = stored.where("kept_sha256 is not null").select("doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), "kept_sha256", *([F.col("text").alias("kept")] if with_text else []))
    return common.restored(done.unionByName(_mapped(last, assembled, ddl, 2)), ids=ids_of)


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> str:
    """The text without the characters all of whose bytes are gone."""
    if not len(data):
        return ""
    head = np.flatnonzero((data & 0xC0) != 0x80)
    stay = np.logical_or.reduceat(~gone, head)
    size = np.diff(np.append(head, len(data)))
    return data[np.repeat(stay, size)].tobytes().decode()
