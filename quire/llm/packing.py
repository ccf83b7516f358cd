"""Packing token sequences into windows by non-negative least squares.

Documents are tokenised and cut into whole windows and one remainder.  The histogram of remainder
lengths (in bins) is matched by non-negative least squares: the unknowns are how often each shallow
combination of bins that fills a window is repeated.  The counts are rounded down for every packing
group; within a group the last member of a combination is the piece that fits the gap best, and what
the combinations leave is packed greedily, longest first, each gap by its best fit.

Groups hold a bounded number of pieces chosen by hash, so no task grows with the corpus.  Only the
histogram (one row for each bin) reaches the driver.  Null texts count as empty: they are one piece
of the end id.  Equal documents are packed separately; no row is dropped.
"""

from __future__ import annotations

import bisect
import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import bpe, common

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def json_vocabulary(content: bytes) -> tuple[bytes, dict[str, int]]:
    """Rank lines and special tokens of a byte-level BPE JSON file (its merges in the order of ids)."""
    import base64

    data = json.loads(content)
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [x for x in range(256) if x not in set(visible)]
    byte_of = {chr(x): x for x in visible} | {chr(256 + i): x for i, x in enumerate(hidden)}
    vocab = data["model"]["vocab"]
    last = -1
    for merge in data["model"]["merges"]:
        made = vocab["".join(merge.split(" ") if isinstance(merge, str) else merge)]
        if made <= last:
            raise ValueError("merges are not in the order of ids")
        last = made
    special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
    lines = [base64.b64encode(bytes(byte_of[c] for c in token)) + b" %d" % i for token, i in vocab.items() if token not in special]
    return b"\n".join(lines), special


def combinations(bins: int, deep: int = 3) -> list[tuple[int, ...]]:
    """Descending tuples of at most ``deep`` bins that sum to ``bins``."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, most: int) -> None:
        if left == 0:
            out.append(head)
        elif len(head) < deep:
            for b in range(min(left, most), 0, -1):
                if b * (deep - len(head)) >= left:
                    grow((*head, b), left - b, b)

    grow((), bins, bins)
    return out


def nnls(a: np.ndarray, y: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """min |a x - y| for x >= 0 by the active-set method (Lawson and Hanson)."""
    m, n = a.shape
    x, passive = np.zeros(n), np.zeros(n, bool)
    w = a.T @ (y - a @ x)
    for _ in range(rounds or 3 * m):
        w[passive] = -np.inf
        j = int(np.argmax(w))
        if w[j] <= 1e-7 * max(1.0, float(np.abs(y).max(initial=0))):
            break
        passive[j] = True
        while True:
            at = np.flatnonzero(passive)
            s = np.zeros(n)
            s[at] = np.linalg.lstsq(a[:, at], y, rcond=None)[0]
            if not len(bad := at[s[at] <= 1e-12]):
                break
            step = (x[bad] / np.maximum(x[bad] - s[bad], 1e-300)).min()
            x += step * (s - x)
            passive &= x > 1e-12
            x[~passive] = 0
            if not passive.any():
                s = np.zeros(n)
                break
        x = s
        w = a.T @ (y - a @ x)
    return x


def plan(histogram: dict[int, int], bins: int, deep: int = 3) -> list[tuple[tuple[int, ...], float]]:
    """Combinations of bins with their repeat counts, those of few members first."""
    made = combinations(bins, deep)
    a = np.zeros((bins + 1, len(made)))
    for j, combo in enumerate(made):
        for b in combo:
            a[b, j] += 1
    y = np.array([histogram.get(b, 0) for b in range(bins + 1)], float)
    total = y.sum()
    x = nnls(a[1:], y[1:] / max(total, 1)) * max(total, 1)
    return sorted(((made[j], float(x[j])) for j in np.flatnonzero(x > 0)), key=lambda t: (len(t[0]), t[0]))


class _Stock:
    """Pieces that are not packed yet, by exact length."""

    def __init__(self, lengths: np.ndarray):
        self.by: dict[int, list[int]] = {}
        for i, n in enumerate(lengths.tolist()):
            self.by.setdefault(n, []).append(i)
        self.sizes = sorted(self.by)

    def take(self, size: int) -> tuple[int, int]:
        found = self.by[size].pop()
        if not self.by[size]:
            del self.by[size]
            self.sizes.pop(bisect.bisect_left(self.sizes, size))
        return found, size

    def best(self, gap: int, least: int = 1) -> tuple[int, int] | None:
        """The longest piece of ``least`` to ``gap`` ids."""
        k = bisect.bisect_right(self.sizes, gap) - 1
        return self.take(self.sizes[k]) if k >= 0 and self.sizes[k] >= least else None


def pack_group(lengths: np.ndarray, planned: list[tuple[tuple[int, ...], int]], window: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence number and offset of every piece of one group."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    stock, n = _Stock(lengths), 0

    def place(found: tuple[int, int], used: int) -> int:
        sequence[found[0]], offset[found[0]] = n, used
        return used + found[1]

    def fill(used: int) -> None:
        nonlocal n
        while used < window and (found := stock.best(window - used)):
            used = place(found, used)
        n += 1

    for combo, times in planned:
        for _ in range(times):
            used, whole = 0, True
            for b in combo[:-1] or combo:
                found = stock.best(min(b * width, window - used), (b - 1) * width + 1)
                if not found:
                    whole = False
                    break
                used = place(found, used)
            if used:
                fill(used)
            if not whole:
                break
    while stock.sizes:
        fill(place(stock.take(stock.sizes[-1]), 0))
    return sequence, offset


def pieces(docs: DataFrame, ranks: bytes, special: dict[str, int], end_id: int, window: int = 2048, id_col: str = "doc_id", text_col: str = "text", chunk: int = 1 << 20) -> DataFrame:
    """Tokenise every text, append ``end_id`` and cut it into whole windows and a remainder."""
    out_schema = common.arrow_schema(PIECE)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def with_special(coder: bpe.ByteBPE, text: str) -> np.ndarray:
        for token, i in special.items():
            if token in text:
                parts = [with_special(coder, x) for x in text.split(token)]
                return np.concatenate([y for x in parts for y in (np.array([i], np.uint32), x)][1:])
        return coder.encode([text])[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.encoder(shared.value)
        for batch in batches:
            _, offsets = common.text_bytes(batch.column(1))
            for i, j in common.slices(offsets, chunk):
                texts = [x or "" for x in batch.column(1).slice(i, j - i).to_pylist()]
                odd = {k: with_special(coder, x) for k, x in enumerate(texts) if any(t in x for t in special)}
                ids, ends = coder.encode(["" if k in odd else x for k, x in enumerate(texts)])
                rows: list[tuple] = []
                for k, (doc, p, q) in enumerate(zip(batch.column(0).slice(i, j - i).to_pylist(), ends[:-1].tolist(), ends[1:].tolist())):
                    own = np.append(odd.get(k, ids[p:q]), end_id).astype("<u4")
                    rows += [(doc, s, min(window, len(own) - s), zlib.crc32(own[s : s + window].tobytes()), len(own)) for s in range(0, len(own), window)]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), out_schema)], schema=out_schema)

    return common.named(docs.withColumnsRenamed({id_col: "doc_id", text_col: "text"}) if (id_col, text_col) != ("doc_id", "text") else docs, "doc_id", "text").mapInArrow(run, PIECE)


def pack(cut_pieces: DataFrame, window: int = 2048, width: int = 16, deep: int = 3, group_size: int = 4096) -> DataFrame:
    """Give every piece a sequence and an offset in it.  ``cut_pieces`` should be a stored table: it is read twice."""
    bins = window // width
    counted = cut_pieces.groupBy(F.ceil(F.col("length") / width).cast("int").alias("bin")).count().collect()  # at most window / width rows
    histogram = {r["bin"]: r["count"] for r in counted}
    total = sum(histogram.values())
    groups = max(1, math.ceil(total / group_size))
    repeats = [(combo, int(x / groups)) for combo, x in plan(histogram, bins, deep) if x >= groups]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "start", "ids_crc32"], kind="stable").reset_index(drop=True)
        sequence, offset = pack_group(pdf["length"].to_numpy(), repeats, window, width)
        return pdf.drop(columns="part").assign(sequence_id=sequence + pdf["part"].astype("int64") * (1 << 32), offset=offset)

    # The ids' checksum keeps pieces of one id (or of none) apart.
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "doc_tokens"), F.lit(groups)).cast("int")
    return cut_pieces.withColumn("part", part).groupBy("part").applyInPandas(run, PIECE + ", sequence_id long, offset long")
