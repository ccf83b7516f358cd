"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding through offsets.

Pre-tokens are found without a regular expression.  Every code point is mapped to a symbol class, the
classes (with a look-ahead of two symbols folded into the class of an apostrophe) drive a small
automaton, and the automaton runs as an associative scan: transition functions are composed inside
equally long blocks, the block functions give every block's first state, and a second sweep gives the
state at every position.  A position starts a pre-token if its state says so.

Rows: null texts count as empty; an empty text has no tokens.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import array
import base64
import hashlib
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm import common

#: Symbol classes of code points.
OTHER, LETTER, NUMBER, SPACE, WHITE, APOS, STOP = range(7)
#: Classes that look-ahead adds: an apostrophe followed by s, t, m, d; one followed by re, ve, ll.
APOS1, APOS2 = 7, 8
SYMBOLS = 9
#: White space other than U+0020 in the Unicode property White_Space (fixed values).
WHITE_SPACE = (9, 10, 11, 12, 13, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)

#: States after reading a symbol; those from S_NEW on say that the symbol started a pre-token.
#: IN_*: inside a run; C1, C2, C3: letters of a contraction that are still to come.
IN_L, IN_N, IN_O, IN_W, C1, C2, NEW_L, NEW_N, NEW_O, NEW_SP, NEW_W, NEW_C1, NEW_C2, END = range(14)
STATES = 14
STARTS = np.zeros(STATES, bool)
STARTS[[NEW_L, NEW_N, NEW_O, NEW_SP, NEW_W, NEW_C1, NEW_C2]] = True


def _transitions() -> np.ndarray:
    """T[symbol, state] -> state.

    White space is settled outside: the class SPACE here is a space that a following run absorbs or
    that ends a white-space run, WHITE is any white space, and its starts are found by neighbours.
    """
    t = np.zeros((SYMBOLS, STATES), np.uint8)
    kind = {IN_L: "L", NEW_L: "L", IN_N: "N", NEW_N: "N", IN_O: "O", NEW_O: "O", IN_W: "W", NEW_W: "W", NEW_SP: "S", C1: "c", C2: "d", NEW_C1: "1", NEW_C2: "2", END: "E"}
    for state, k in kind.items():
        # k: L, N, O runs; S a space that joins what follows; 1 and d: one letter to come; 2: two to come; c: contraction done
        t[LETTER, state] = C1 if k in "1d" else C2 if k == "2" else IN_L if k in "LS" else NEW_L
        t[NUMBER, state] = IN_N if k in "NS" else NEW_N
        for symbol in (OTHER, APOS, APOS1, APOS2):
            t[symbol, state] = IN_O if k in "OS" else {APOS1: NEW_C1, APOS2: NEW_C2}.get(symbol, NEW_O)
        t[WHITE, state] = IN_W if k == "W" else NEW_W
        t[SPACE, state] = NEW_SP
        t[STOP, state] = END
    return t


TRANSITIONS = _transitions()
#: The rank of a pair that makes no token.
NONE = 1 << 62


def scan(symbols: np.ndarray, table: np.ndarray = TRANSITIONS, first: int = END, block: int = 512) -> np.ndarray:
    """The automaton's state after every symbol, by composing transition functions.

    Function composition is associative, so blocks are reduced side by side: one step extends the
    composed function of every block by one symbol.
    """
    n, states = len(symbols), table.shape[1]
    if n == 0:
        return np.zeros(0, np.uint8)
    rows = -(-n // block)
    padded = np.zeros(rows * block, np.uint8)
    padded[:n] = symbols
    steps = np.ascontiguousarray(padded.reshape(rows, block).T)
    flat = np.ascontiguousarray(table.reshape(-1))
    # A function whose values have become equal no longer changes with the state it started from.
    composed = np.broadcast_to(np.arange(states, dtype=np.uint8), (rows, states)).copy()
    live = np.arange(rows)
    for j in range(block):
        at = steps[j, live].astype(np.intp)[:, None] * states + composed[live]
        composed[live] = flat[at]
        if j % 16 == 15:
            fixed = composed[live]
            same = (fixed == fixed[:, :1]).all(1)
            if same.any():
                # From here the block's function is a constant: one state is enough to carry on.
                done = live[same]
                state = composed[done, 0].astype(np.intp)
                for i in range(j + 1, block):
                    state = flat[steps[i, done].astype(np.intp) * states + state].astype(np.intp)
                composed[done] = state[:, None]
                live = live[~same]
        if not len(live):
            break
    begin = np.empty(rows, np.intp)
    state = first
    for i, function in enumerate(composed.tolist()):
        begin[i] = state
        state = function[state]
    out = np.empty((block, rows), np.uint8)
    state = begin
    for j in range(block):
        state = flat[steps[j].astype(np.intp) * states + state]
        out[j] = state
        state = state.astype(np.intp)
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def class_table() -> np.ndarray:
    """The class of every code point, from the Unicode general categories."""
    table = np.zeros(0x110000, np.uint8)
    for cp in range(0x110000):
        major = unicodedata.category(chr(cp))[0]
        if major == "L":
            table[cp] = LETTER
        elif major == "N":
            table[cp] = NUMBER
    table[list(WHITE_SPACE)] = WHITE
    table[0x20] = SPACE
    table[0x27] = APOS
    return table


def symbols_of(cps: np.ndarray, stops: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Classes with the look-ahead folded in.  ``stops``: positions between texts."""
    c = classes[cps]
    c[stops] = STOP
    n = len(c)
    follows = np.full(n, STOP, np.uint8)  # the class after each position
    follows[:-1] = c[1:]
    white = (c == SPACE) | (c == WHITE)
    # A space directly before visible text joins it; any other white space belongs to a white-space run.
    joins = (c == SPACE) & (follows != SPACE) & (follows != WHITE) & (follows != STOP)
    c[white & ~joins] = WHITE
    apos = np.flatnonzero(c[:-2] == APOS) if n > 2 else np.zeros(0, np.int64)
    if len(apos):
        a, b = cps[apos + 1], cps[apos + 2]
        one = np.isin(a, [ord(x) for x in "stmd"])
        two = ((b == ord("e")) & ((a == ord("r")) | (a == ord("v")))) | ((a == ord("l")) & (b == ord("l")))
        c[apos[one]] = APOS1
        c[apos[two]] = APOS2
    return c


def boundaries(cps: np.ndarray, stops: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """True where a pre-token starts."""
    c = symbols_of(cps, stops, classes)
    start = STARTS[scan(c)]
    # The last of several white-space characters before visible text stands alone unless it joins (then
    # it is a SPACE symbol, which always starts a pre-token).
    if len(c) > 2:
        last = (c[1:-1] == WHITE) & (c[:-2] == WHITE) & (c[2:] != WHITE) & (c[2:] != STOP) & (c[2:] != SPACE)
        start[1:-1] |= last
        # Before a joining space the run ends one earlier by itself: that space is the run's last character.
    return start


class ByteBPE:
    """Encoder and decoder for one rank table; keeps a cache of merged pre-tokens."""

    def __init__(self, ranks: dict[bytes, int], most_cached: int = 1_000_000):
        self.ranks, self.most = ranks, most_cached
        self.classes = _classes()
        size = max(ranks.values()) + 1
        words = [b""] * size
        for token, rank in ranks.items():
            words[rank] = token
        self.word_len = np.array([len(x) for x in words], np.int64)
        self.word_off = np.concatenate([[0], np.cumsum(self.word_len)])
        self.word_bytes = np.frombuffer(b"".join(words), np.uint8)
        self.byte_ids = np.array([ranks[bytes([x])] for x in range(256)], np.int64)
        pairs = {(a << 32 | b): rank for token, rank in ranks.items() for i in range(1, len(token)) if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None}
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        order = np.argsort(keys)
        self.pair_keys, self.pair_values = keys[order], np.fromiter(pairs.values(), np.int64, len(pairs))[order]
        self._clear()

    def _clear(self) -> None:
        self.cache: dict[bytes, int] = {}
        self.flat, self.off = array.array("I"), array.array("q", [0])

    def _learn(self, pieces: list[bytes]) -> None:
        """Merge pre-tokens that the cache lacks and keep their ids."""
        long = {x: self._merge_long(x) for x in pieces if len(x) > 400}
        rest = [x for x in pieces if x not in long]
        ids, ends = self.merge_many(rest)
        for piece, found in [*zip(rest, (ids[p:q] for p, q in zip(ends, ends[1:]))), *long.items()]:
            self.cache[piece] = len(self.off) - 1
            self.flat.extend(found)
            self.off.append(len(self.flat))

    def _pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the token that two tokens make together; NONE if there is none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_values[at], NONE)

    def merge_many(self, pieces: list[bytes]) -> tuple[list[int], list[int]]:
        """Merge all pieces side by side: each round joins every piece's pair of lowest rank, leftmost first."""
        n = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        piece = np.repeat(np.arange(len(pieces)), n)
        whole = np.fromiter((self.ranks.get(x, -1) for x in pieces), np.int64, len(pieces))
        open_ = whole[piece] < 0
        out = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
        ids, piece = ids[open_], piece[open_]
        rank = np.full(len(ids), NONE, np.int64)
        if len(ids) > 1:
            rank[:-1] = np.where(piece[1:] == piece[:-1], self._pair_ranks(ids[:-1], ids[1:]), NONE)
        while len(ids):
            heads = np.flatnonzero(np.concatenate([[True], piece[1:] != piece[:-1]]))
            least = np.minimum.reduceat(rank, heads)
            size = np.diff(np.append(heads, len(ids)))
            least_all = np.repeat(least, size)
            done = least_all == NONE
            if done.any():
                out.append((piece[done], ids[done]))
                ids, piece, rank, least_all = ids[~done], piece[~done], rank[~done], least_all[~done]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == least_all)
            hits = hits[np.concatenate([[True], piece[hits[1:]] != piece[hits[:-1]]])]
            ids[hits] = rank[hits]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            hits = hits - np.arange(len(hits))  # one element goes for each hit before
            ids, piece, rank = ids[keep], piece[keep], rank[keep]
            for left in (hits, hits - 1):
                left = left[(left >= 0)]
                right = np.minimum(left + 1, len(ids) - 1)
                same = (left < right) & (piece[left] == piece[right])
                rank[left] = np.where(same, self._pair_ranks(ids[left], ids[right]), NONE)
        where, found = np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])
        order = np.argsort(where, kind="stable")
        return found[order].tolist(), np.concatenate([[0], np.cumsum(np.bincount(where, minlength=len(pieces)))]).tolist()

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same merges with a heap and a linked list, for very long pre-tokens."""
        import heapq

        get, n = self.ranks.get, len(piece)
        parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and (j := after[i]) < n and (r := get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]) + len(parts[j])))

        while heap:
            rank, i, size = heapq.heappop(heap)
            if parts[i] is None or (j := after[i]) >= n or len(parts[i]) + len(parts[j]) != size or get(parts[i] + parts[j]) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            push(i)
            push(before[i])
        return [self.ranks[x] for x in parts if x is not None]

    def pretokens(self, texts: list[str]) -> tuple[list[bytes], np.ndarray]:
        """Pre-tokens of all texts in order, and how many each text has."""
        joined = "\n".join(texts) + "\n"
        cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        stops = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        start = boundaries(cps, stops, self.classes)
        width = np.ones(len(cps), np.uint8)
        for least in (0x80, 0x800, 0x10000):
            width += cps >= least
        at = np.cumsum(width, dtype=np.int64) - width
        heads = np.flatnonzero(start)
        # A pre-token ends where the next begins or at its text's stop.
        text_of = np.searchsorted(stops, heads)
        ends = np.empty(len(heads), np.int64)
        ends[:-1] = heads[1:]
        if len(heads):
            ends[-1] = len(cps)
        ends = np.minimum(ends, stops[text_of]) if len(heads) else ends
        raw = joined.encode()
        a, b = at[heads].tolist(), at[ends].tolist() if len(heads) else []
        return [raw[i:j] for i, j in zip(a, b)], np.bincount(text_of, minlength=len(texts))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the offsets of the texts in it."""
        if len(self.cache) > self.most:
            self._clear()
        pieces, each = self.pretokens(texts)
        ix = np.fromiter(map(self.cache.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        if len(miss := np.flatnonzero(ix < 0)):
            new = [pieces[i] for i in miss.tolist()]
            self._learn(list(dict.fromkeys(new)))
            ix[miss] = np.fromiter(map(self.cache.__getitem__, new), np.int64, len(new))
        off, flat = np.array(self.off, np.int64), np.array(self.flat, np.uint32)
        begin, n = off[ix], off[ix + 1] - off[ix]
        total = np.cumsum(n)
        where = np.repeat(begin - total + n, n) + np.arange(total[-1] if len(n) else 0)
        ends = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(each)])]
        return flat[where], ends

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in one array, and the byte offsets that belong to ``ends``."""
        n = self.word_len[ids]
        total = np.cumsum(n)
        where = np.repeat(self.word_off[ids] - total + n, n) + np.arange(total[-1] if len(n) else 0)
        return self.word_bytes[where], np.concatenate([[0], total])[ends]


_KEPT: dict = {}


def _classes() -> np.ndarray:
    if "classes" not in _KEPT:
        _KEPT["classes"] = class_table()
    return _KEPT["classes"]


def parse_ranks(content: bytes) -> dict[bytes, int]:
    """A rank file: one line for each token, base64 and rank."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


def encoder(content: bytes) -> ByteBPE:
    """One encoder for each worker process and rank file."""
    key = hashlib.sha1(content).digest()
    if key not in _KEPT:
        _KEPT[key] = ByteBPE(parse_ranks(content))
    return _KEPT[key]


def read_ranks(path: str, most: int = 16 << 20) -> bytes:
    """The rank file's content, which goes to the executors with the task; its size is checked."""
    with open(path, "rb") as f:
        content = f.read(most + 1)
    if len(content) > most:
        raise ValueError(f"{path} is larger than {most} bytes")
    return content


def encode_decode(docs: DataFrame, ranks: bytes, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False, chunk: int = 1 << 20) -> DataFrame:
    """Encode every text, decode the ids again, and report both.

    Result: id_col, n_tokens, ids_sha256, decoded_sha256, n_decoded (bytes) and, with ``keep_ids``, ids
    (array<int>) and ends (array<int>: the byte offset at which each id's bytes end in the decoded text).
    """
    more = ", ids array<int>, ends array<int>" * keep_ids
    ddl = f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_decoded long{more}"
    out_schema = common.arrow_schema(ddl)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(shared.value)
        for batch in batches:
            _, offsets = common.text_bytes(batch.column(1))
            for i, j in common.slices(offsets, chunk):
                texts = [x or "" for x in batch.column(1).slice(i, j - i).to_pylist()]
                ids, ends = bpe.encode(texts)
                raw, at = bpe.decode(ids, ends)
                raw, listed = raw.tobytes(), ids.tolist()
                e, a = ends.tolist(), at.tolist()
                rows = [batch.column(0).slice(i, j - i), pa.array(np.diff(ends))]
                rows.append(pa.array([hashlib.sha256(",".join(map(str, listed[p:q])).encode()).hexdigest() for p, q in zip(e, e[1:])]))
                rows.append(pa.array([hashlib.sha256(raw[p:q]).hexdigest() for p, q in zip(a, a[1:])]))
                rows.append(pa.array(np.diff(at)))
                if keep_ids:
                    lengths = bpe.word_len
                    rows.append(pa.array([listed[p:q] for p, q in zip(e, e[1:])], pa.list_(pa.int32())))
                    rows.append(pa.array([np.cumsum(lengths[ids[p:q]]).tolist() for p, q in zip(e, e[1:])], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(rows, out_schema)], schema=out_schema)

    return common.named(docs, id_col, text_col).mapInArrow(run, ddl)
