"""Scoring texts with a probabilistic suffix tree over words.

Symbols are all words and the end of text (which also stands before the first word).  A context of any
length with at least ``least_context`` training occurrences is kept if its suffix is kept and its
next-symbol counts diverge from those of its suffix: the log-likelihood ratio must reach ``divergence``,
and one next symbol must be seen twice (else the context would say what its suffix says).  With
``represented``, symbols seen once count as one symbol in that ratio, as in the distribution that is kept.
Both are absolute, so the tree grows with the corpus, in width and in depth.  Next symbols seen twice or
more are smoothed with the suffix's distribution, the rest of the mass goes to the suffix, so every state
is a proper distribution; the root is the add-one-half word distribution.  A text is scored by the
longest kept suffix at every word.

The tree is never in one place.  Pages of words, stored once and dealt by page, send their distinct words
to hash buckets and get the training counts back.  A depth takes two exchanges.  Distinct (context, next
symbol) pairs go out as eight bytes each, and their training counts come back.  A page can then tell what
its own occurrences add to the sums of the divergence test and of the smoothing; an occurrence of a pair
seen m times adds 1/m of what the pair counts for once.  Distinct contexts go out with these; a bucket of
contexts adds them up and answers for those it keeps.  A page sends a key once at most, so that a common one
is as many entries as there are pages.  Only tokens whose next symbol was seen twice after the context's
suffix make pairs, and only where the count of the words before, known from the depth above, reaches
``least_context``.  A page keeps places only for tokens whose context was kept and that can have a longer one;
the others have their probability.  Of its texts it keeps the stretches that such longer contexts can reach
(``Page.left``), so that a deep pass reads what is still open and not the corpus.  Depths end when no token is open.

Null texts count as empty (one token, the end).  Documents of any length are scored whole; repeated rows
are scored and counted like any other, ties cannot arise.  With nothing to learn from all counts are zero;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import common
from quire.llm.shingles import word_hashes

#: The end of text in place of a word's hash, and words seen once or never in training, which no context needs.
END, ONCE, NEVER = np.uint64(0), np.uint64(1), np.uint64(2)
PAGE = 3 << 19
SPREAD = np.uint64(0x9E3779B97F4A7C15)
#: The count from which a next symbol has its own probability.
LEAST_NEXT = 2
#: The place of the first token of a stretch that is cut: no context that is asked for goes beyond.
FAR = 1 << 32
#: What a pair takes on its way to a bucket, with room for its sort there.
PAIR_BYTES = 12
PAGES = "page long, ids binary, held binary, first binary, words binary, tokens binary, sent binary"


def _packed(x: np.ndarray, below: int) -> bytes:
    """Numbers below ``below`` in two or four bytes each; ``_unpacked`` knows which."""
    return x.astype("<u2" if below <= 1 << 16 else "<u4").tobytes()


def _unpacked(x: bytes, below: int) -> np.ndarray:
    return np.frombuffer(x, "<u2" if below <= 1 << 16 else "<u4").astype(np.int64)


def pages(docs: DataFrame, held: str) -> DataFrame:
    """Texts as rows of about 1.5 MB: document ids, folds, word offsets, distinct words, tokens and training counts."""
    out_schema = common.arrow_schema(PAGES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        for batch in batches:
            data, offsets = common.text_bytes(batch.column(1))
            ids = np.array(batch.column(0).fill_null(common.NO_ID), np.int64)
            fold = np.array(batch.column(2).fill_null(False).to_pylist(), bool)
            for i, j in common.slices(offsets, PAGE):
                h, first = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                h[h < 3] += np.uint64(3)
                n = j - i
                with_ends = np.insert(h, first[1:], END)
                first = first + np.arange(n + 1)
                words, tokens = np.unique(with_ends, return_inverse=True)
                trained = np.bincount(tokens[~np.repeat(fold[i:j], np.diff(first))], minlength=len(words))
                row = (uuid.uuid4().int >> 65, ids[i:j].tobytes(), fold[i:j].tobytes(), first.astype("<u4").tobytes(), words.tobytes(), _packed(tokens, len(words)), trained.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, out_schema)], schema=out_schema)

    return docs.select("doc_id", "text", F.col(held).alias("held")).mapInArrow(run, PAGES)


def word_counts(paged: DataFrame, buckets: int) -> DataFrame:
    """(page, part, counts): the training counts of a page's distinct words that fall in a bucket, in their order;
    beside them each bucket's totals N and V as rows with a null page."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = common.arrow_schema("bucket int, page long, words binary, sent binary")
        for batch in batches:
            for page, words, sent in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                w, n = np.frombuffer(words, np.uint64), np.frombuffer(sent, np.uint32)
                bucket = (w % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                use = np.flatnonzero(np.diff(ends))
                rows = [(int(b), page, w[order[ends[b] : ends[b + 1]]].tobytes(), n[order[ends[b] : ends[b + 1]]].tobytes()) for b in use]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    ddl = "bucket int, page long, counts binary, n_tokens long, n_words long"

    def total(table: pa.Table) -> pa.Table:
        schema = common.arrow_schema(ddl)
        bucket, page = table.column("bucket")[0].as_py(), table.column("page").to_pylist()
        parts = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
        w, n = np.concatenate(parts), np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("sent").to_pylist()])
        distinct, which = np.unique(w, return_inverse=True)
        c = np.bincount(which, n, minlength=len(distinct)).astype(np.int64)
        at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).tolist()
        back = c[which].astype("<u8")
        rows = [(bucket, p, back[a:b].tobytes(), None, None) for p, a, b in zip(page, at, at[1:])]
        rows.append((bucket, None, None, int(c.sum()), int((c > 0).sum())))
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    sent = paged.select("page", "words", "sent").mapInArrow(split, "bucket int, page long, words binary, sent binary")
    return sent.groupBy("bucket").applyInArrow(total, ddl)


class Symbols:
    """Words as symbols 2.., other words as 1, the end as 0, with root probabilities."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n: int, v: int, end_count: int):
        order = np.argsort(words)
        self.words, counts = words[order], counts[order]
        self.below = n + 0.5 * (v + 1)
        p = np.concatenate([[(end_count + 0.5) / self.below, 0.0], (counts + 0.5) / self.below])
        p[1] = max(1 - p.sum(), 0.5 / self.below)
        self.root = p

    def of(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, words), max(0, len(self.words) - 1))
        found = self.words[at] == words if len(self.words) else np.zeros(len(words), bool)
        return np.where(words == END, 0, np.where(found, at + 2, 1)).astype(np.int64)


class Tree:
    """The smoothing in memory, for small trees: kept contexts, next-symbol log-probabilities and back-off weights."""

    def __init__(self, symbols: Symbols):
        self.symbols, self.size = symbols, len(symbols.root)
        self.context = {(): 0}
        self.parent, self.rest = [0], [0.0]
        self.keys = np.zeros(0, np.int64)  # context * size + symbol, sorted
        self.logs = np.zeros(0)

    def log_p(self, context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """ln p(symbol | context), backing off along kept suffixes."""
        out = np.zeros(len(context))
        parent, rest = np.array(self.parent), np.array(self.rest)
        left, state = np.arange(len(context)), context
        while len(left):
            root = state == 0
            out[left[root]] += np.log(self.symbols.root[symbol[left[root]]])
            left, state = left[~root], state[~root]
            key = state * self.size + symbol[left]
            at = np.minimum(np.searchsorted(self.keys, key), max(0, len(self.keys) - 1))
            hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), bool)
            out[left[hit]] += self.logs[at[hit]]
            left, state = left[~hit], state[~hit]
            out[left] += rest[state]
            state = parent[state]
        return out

    def add(self, contexts: list[tuple[int, ...]], of: np.ndarray, symbol: np.ndarray, n: np.ndarray, totals: np.ndarray, prior: float) -> None:
        """Add contexts whose kept next symbols are (of, symbol, n); their suffixes must be in the tree."""
        if not contexts:
            return
        parents = np.array([self.context.get(c[1:], 0) for c in contexts])
        below = self.log_p(parents[of], symbol)
        p = (n + prior * np.exp(below)) / (totals[of] + prior)
        kept, under = np.bincount(of, p, len(contexts)), np.bincount(of, np.exp(below), len(contexts))
        rest = np.log(np.maximum(1 - kept, 1e-12) / np.maximum(1 - under, 1e-12))
        first = len(self.parent)
        for i, c in enumerate(contexts):
            self.context[c] = first + i
        self.parent += parents.tolist()
        self.rest += rest.tolist()
        keys = np.append(self.keys, (first + of) * self.size + symbol)
        logs = np.append(self.logs, np.log(p))
        order = np.argsort(keys)
        self.keys, self.logs = keys[order], logs[order]


def context_keys(symbol: np.ndarray, place: np.ndarray, depth: int, at: np.ndarray) -> np.ndarray:
    """A key of the ``depth`` symbols before each token at ``at``; before a text (``place`` 0) stands the end."""
    place = place[at]
    key = np.full(len(at), depth, np.uint64)
    for back in range(1, depth + 1):
        key = common.mix(key * SPREAD + np.where(place < back, END, symbol[np.maximum(at - back, 0)]))
    return key


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct value of ``x`` stands, in their order, and which one every element is."""
    order = np.argsort(x)
    new = common.runs(x[order])
    which = np.empty(len(x), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def level(n: np.ndarray, least: float) -> np.ndarray:
    """The number of binary digits of counts, 0 where a count is below ``least``."""
    return np.where(n >= least, np.frexp(np.asarray(n, np.float64))[1], 0).astype("u1")


class Page:
    """A page at one depth: what it asks for, sorted by key, in an order that does not depend on when it asks.

    At first it has its texts, later stretches of them; a stretch that is ``cut`` begins after the text does.
    """

    def __init__(self, row: dict, depth: int, below: float, least: float):
        self.row, self.depth, self.least = row, depth, least
        self.first = np.frombuffer(row["first"], np.uint32).astype(np.int64)
        self.words = np.frombuffer(row["words"], np.uint64)
        tokens, n = _unpacked(row["tokens"], len(self.words)), int(self.first[-1])
        self.tokens, self.gram = tokens, np.frombuffer(row["gram"], "u1")
        if row["live"] is None:
            count = np.frombuffer(row["counts"], "<u8")
            self.doc, self.cut, self.ends = np.arange(len(self.first) - 1), np.zeros(len(self.first) - 1, bool), int(level(count[self.words == END], least)[0])
            self.live, self.q, again = np.arange(n), np.log((count + 0.5) / below)[tokens], np.ones(n, bool)
        else:
            self.doc, self.ends = np.frombuffer(row["doc"], np.uint32).astype(np.int64), row["ends"]
            self.cut = np.unpackbits(np.frombuffer(row["cut"], np.uint8), count=len(self.doc)).astype(bool)
            self.live = np.flatnonzero(np.unpackbits(np.frombuffer(row["live"], np.uint8), count=n))
            self.q = np.frombuffer(row["q"], "<f4").astype(np.float64)
            again = np.unpackbits(np.frombuffer(row["again"], np.uint8), count=len(self.live)).astype(bool)
        if not depth or not len(self.live):
            self.use, self.paired, self.of_pair = (np.zeros(0, np.int64) for _ in range(3))
            self.key, self.pair, self.pair_n = (np.zeros(0, np.uint64) for _ in range(3))
            return
        self.place = np.arange(n) - np.repeat(self.first[:-1] - FAR * self.cut, np.diff(self.first))
        enough = self.place >= depth - 1
        # The words before a token are a context and its next symbol of the depth above, or fewer words: at least as frequent.
        seen = self.before(self.gram)
        self.gram = np.where((seen > 0) | ~enough, self.gram, np.uint8(0))
        self.use = np.flatnonzero((enough & (seen > 0))[self.live])  # of the live ones
        at = self.live[self.use]
        self.key = context_keys(self.words[tokens], self.place, depth, at)
        self.trained = np.repeat(~np.frombuffer(row["held"], bool)[self.doc], np.diff(self.first))[at]
        # A next symbol seen less than twice, alone or after the context's suffix, is in no pair seen twice.
        symbol = self.words[tokens[at]]
        self.paired = np.flatnonzero((symbol != ONCE) & (symbol != NEVER) & again[self.use])
        pair = common.mix(self.key[self.paired] * SPREAD + symbol[self.paired])
        found, self.of_pair = distinct(pair)
        self.pair = pair[found]
        self.pair_n = np.bincount(self.of_pair, self.trained[self.paired], len(found)).astype(np.int64)

    def before(self, gram: np.ndarray) -> np.ndarray:
        """What ``gram`` has for the token before each; nothing where a stretch is cut."""
        seen = np.append(np.uint8(0), gram[:-1])
        seen[self.first[:-1]] = np.where(self.cut, 0, self.ends)
        return seen

    def spent(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The sums of ``q`` at the tokens ``at`` for each document of the page."""
        return np.bincount(np.repeat(self.doc, np.diff(self.first))[at], q, len(self.row["held"]))

    def left(self, live: np.ndarray, q: np.ndarray, again: np.ndarray, gram: np.ndarray) -> dict:
        """The page for the next depth, of what the tokens ``live`` with kept contexts can still need.

        A longer context has only words whose own ``gram`` is not zero, but for the ``depth`` words before the
        first of them: this is the reach of a token.  Tokens without reach are done.
        """
        go = (self.before(gram)[live] > 0) & (self.place[live] >= self.depth)
        done = np.frombuffer(self.row["done"], "<f8") + self.spent(live[~go], q[~go])
        live, q, again = live[go], q[go], again[go]
        n, begins = len(gram), np.zeros(len(gram), bool)
        begins[self.first[:-1]] = True
        frequent = gram > 0
        opens = frequent & (begins | ~np.append(False, frequent[:-1]))
        run = np.cumsum(opens) - 1  # of a frequent token
        of, starts = run[live - 1], np.flatnonzero(opens)
        last = np.zeros(len(starts), np.int64)
        last[of] = live  # in order: the last one of a run stays
        used = np.flatnonzero(last)
        stretch = np.repeat(np.arange(len(self.doc)), np.diff(self.first))
        from_ = np.maximum(starts[used] - self.depth, self.first[:-1][stretch[starts[used]]])
        keep = np.cumsum(np.bincount(from_, minlength=n + 1) - np.bincount(last[used] + 1, minlength=n + 1))[:n] > 0
        opens = keep & (begins | ~np.append(False, keep[:-1]))
        at, tokens = np.flatnonzero(opens), self.tokens[keep]
        whole = begins[at] & ~self.cut[stretch[at]]
        new = np.cumsum(keep) - 1
        known = np.zeros(len(self.words), bool)
        known[tokens] = True
        bits = np.zeros(len(tokens), bool)
        bits[new[live]] = True
        return {
            "done": done.tobytes(),
            "doc": self.doc[stretch[at]].astype("<u4").tobytes(),
            "first": np.append(new[at], len(tokens)).astype("<u4").tobytes(),
            "cut": np.packbits(~whole).tobytes(),
            "words": self.words[known].tobytes(),
            "tokens": _packed((np.cumsum(known) - 1)[tokens], int(known.sum())),
            "gram": gram[keep].tobytes(),
            "live": np.packbits(bits).tobytes(),
            "again": np.packbits(again).tobytes(),
            "q": q.astype("<f4").tobytes(),
            "n_live": len(live),
        }

    def contexts(self) -> np.ndarray:
        """The distinct contexts, sorted; ``of_context`` has each used token's."""
        found, self.of_context = distinct(self.key)
        return self.key[found]

    def counted(self, answers: dict[int, bytes], buckets: int) -> np.ndarray:
        """How often each used token's pair was seen in training; a pair that did not go out occurs once at most."""
        n = np.zeros(len(self.use), np.int64)
        parts = [_counts(answers[b], j - i) for b, i, j in _dealt(self.pair, buckets)]
        if parts:
            n[self.paired] = np.concatenate(parts)[self.of_pair]
        return n

    def sums(self, n: np.ndarray, represented: bool) -> list[np.ndarray]:
        """For each context what this page adds to its training occurrences, to those whose pair was seen twice, and to two sums
        over its distinct pairs: the logarithms of the divergence test, and the suffix's probabilities."""
        q, twice, total = self.q[self.use], self.trained & (n >= LEAST_NEXT), int(self.of_context.max()) + 1
        m = np.maximum(n, 1)
        gain = (np.log(m) - q) * (twice if represented else self.trained)
        # Every occurrence of a pair adds its share, so that all pages together count the pair once.
        return [np.bincount(self.of_context, x, total) for x in (self.trained, twice, gain, np.exp(q) * twice / m)]


def _dealt(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each bucket in use; buckets are ranges of the sorted 64-bit keys."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    ends = np.searchsorted(bucket, np.arange(buckets + 1))
    return [(int(b), int(ends[b]), int(ends[b + 1])) for b in np.flatnonzero(np.diff(ends))]


def _told(n: np.ndarray) -> bytes:
    """Counts in a byte each; those from 255 on follow in eight."""
    return np.minimum(n, 255).astype("u1").tobytes() + n[n >= 255].astype("<i8").tobytes()


def _counts(x: bytes, size: int) -> np.ndarray:
    n = np.frombuffer(x, "u1", size).astype(np.int64)
    n[n == 255] = np.frombuffer(x, "<i8", offset=size)
    return n


def _whole(n: np.ndarray) -> bytes:
    """Whole numbers in four bytes each, or in eight; ``_read_whole`` can tell by the length."""
    return n.astype("<u4" if n.max(initial=0) < 1 << 32 else "<u8").tobytes()


def _read_whole(x: bytes, size: int) -> np.ndarray:
    return np.frombuffer(x, "<u4" if len(x) == 4 * size else "<u8")


def _answered(keys: np.ndarray, buckets: int, answers: dict[int, bytes], kind: str) -> np.ndarray:
    """The answers of buckets by remainder, put back into the order of the keys."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    out = np.zeros(len(keys), kind)
    for b in np.flatnonzero(np.diff(ends)).tolist():
        out[order[ends[b] : ends[b + 1]]] = np.frombuffer(answers[b], kind)
    return out


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = common.arrow_schema(ddl)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


#: What only the end needs, and what a depth changes; both are dealt by page, so that nothing of them is shuffled.
FIXED = "page long, ids binary, sizes binary, base binary, known binary"
STATE = "page long, held binary, done binary, doc binary, first binary, cut binary, words binary, counts binary, tokens binary, gram binary, live binary, again binary, q binary, ends int, n_live long"
#: Pairs on their way to a bucket, contexts on theirs, and the answers that pages get.
PAIRS = "bucket int, page long, key binary, n binary"
CONTEXTS = "bucket int, page long, key binary, n binary, twice binary, sums binary"
ANSWER = "bucket int, page long, n binary, hit binary, total binary, rest binary"


def started(paged: DataFrame, counted: DataFrame, buckets: int, below: float, least: float, parts: int) -> DataFrame:
    """Pages with the training counts of their words; words seen less than twice share two places."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        answers = dict(zip(right.column("bucket").to_pylist(), right.column("counts").to_pylist()))
        for row in left.to_pylist():
            words, first = np.frombuffer(row["words"], np.uint64), np.frombuffer(row["first"], np.uint32).astype(np.int64)
            tokens, count = _unpacked(row["tokens"], len(words)), _answered(words, buckets, answers, "<u8")
            per = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has its end
            base, known = per(np.log((count + 0.5) / below)[tokens]), per((count > 0)[tokens].astype(np.int64)).astype("<u4")
            gram = level(count, least)[tokens]
            common_words = (count >= LEAST_NEXT) | (words == END)
            short = np.concatenate([words[common_words], [ONCE, NEVER]]).astype(np.uint64)
            of = np.where(common_words, np.cumsum(common_words) - 1, len(short) - 1 - (count > 0))
            counts = np.concatenate([count[common_words], [1, 0]]).astype("<u8")
            n = len(tokens)
            fixed = (row["page"], row["ids"], np.diff(first).astype("<u4").tobytes(), base.astype("<f8").tobytes(), known.tobytes())
            rows.append((*fixed, row["held"], np.zeros(len(base)).tobytes(), None, row["first"], None, short.tobytes(), counts.tobytes(), _packed(of[tokens], len(short)), gram.tobytes(), None, None, None, None, n))
        return pa.Table.from_batches([_batch(rows, FIXED + STATE[len("page long") :])])

    answers = counted.where("page is not null").select("page", "bucket", "counts")
    found = paged.select("page", "ids", "held", "first", "words", "tokens").groupBy("page").cogroup(answers.groupBy("page")).applyInArrow(run, FIXED + STATE[len("page long") :])
    return common.cut_by(found, "page", parts, "state")


def deeper(state: DataFrame, depth: int, buckets: int, below: float, least: float, divergence: float, prior: float, represented: bool, parts: int) -> DataFrame:
    """The pages with the contexts of one more depth."""

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                p = Page(batch.slice(i, 1).to_pylist()[0], depth, below, least)
                yield _batch([(b, p.row["page"], p.pair[i:j].tobytes(), _told(p.pair_n[i:j])) for b, i, j in _dealt(p.pair, buckets)], PAIRS)

    def added(table: pa.Table) -> pa.Table:
        bucket, page = table.column("bucket")[0].as_py(), table.column("page").to_pylist()
        sent = [np.frombuffer(x, np.uint64) for x in table.column("key").to_pylist()]
        n = np.concatenate([_counts(x, len(k)) for x, k in zip(table.column("n").to_pylist(), sent)])
        found, which = distinct(np.concatenate(sent))
        back = np.bincount(which, n, len(found)).astype(np.int64)[which]
        ends = np.cumsum([0, *map(len, sent)]).tolist()
        return pa.Table.from_batches([_batch([(bucket, p, _told(back[i:j]), None, None, None) for p, i, j in zip(page, ends, ends[1:])], ANSWER)])

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, rows = dict(zip(right.column("bucket").to_pylist(), right.column("n").to_pylist())), []
        for row in left.to_pylist():
            p = Page(row, depth, below, least)
            if len(p.use):
                key = p.contexts()
                n, twice, *sums = p.sums(p.counted(answers, buckets), represented)
                gives = twice > 0 if represented else n > 0
                rows += [(b, row["page"], key[i:j].tobytes(), _told(n[i:j].astype(np.int64)), _told(twice[i:j].astype(np.int64)), np.concatenate([x[i:j][gives[i:j]] for x in sums]).astype("<f4").tobytes()) for b, i, j in _dealt(key, buckets)]
        return pa.Table.from_batches([_batch(rows, CONTEXTS)])

    def judged(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sent = [np.frombuffer(r["key"], np.uint64) for r in rows]
        found, of = distinct(np.concatenate(sent))
        size = len(found)
        n, twice = (np.concatenate([_counts(r[c], len(k)) for r, k in zip(rows, sent)]) for c in ("n", "twice"))
        total, kept = np.bincount(of, n, size), np.bincount(of, twice, size)
        sums = np.concatenate([np.frombuffer(r["sums"], "<f4").reshape(2, -1) for r in rows], axis=1).astype(np.float64)
        gives = of[twice > 0 if represented else n > 0]
        gain, under = (_exact_sums(gives, x, size) for x in sums)
        if represented:
            others = np.maximum(total - kept, 0)
            gain += np.where(others > 0, others * np.log(np.maximum(others, 1) / np.maximum(1 - under, 1e-12)), 0.0)
        gain -= total * np.log(np.maximum(total, 1))
        total[(total < least) | (gain < divergence) | (kept == 0)] = 0
        rest = np.log(np.maximum(1 - (kept + prior * under) / (total + prior), 1e-12) / np.maximum(1 - under, 1e-12))
        out, ends = [], np.cumsum([0, *map(len, sent)]).tolist()
        for r, i, j in zip(rows, ends, ends[1:]):
            at = of[i:j]
            hit = total[at] > 0
            if hit.any():
                out.append((r["bucket"], r["page"], None, np.packbits(hit).tobytes(), _whole(total[at[hit]]), rest[at[hit]].astype("<f4").tobytes()))
        return pa.Table.from_batches([_batch(out, ANSWER)])

    def moved(left: pa.Table, right: pa.Table) -> pa.Table:
        answers, rows = right.to_pylist(), []
        counts, kept = {r["bucket"]: r["n"] for r in answers if r["hit"] is None}, {r["bucket"]: r for r in answers if r["hit"] is not None}
        for row in left.to_pylist():
            p = Page(row, depth, below, least)
            if not len(p.live):
                rows.append(tuple(row[c] for c in names))
                continue
            q, gram = p.q.copy(), p.gram.copy()
            alive, again = np.zeros(len(p.live), bool), np.zeros(len(p.live), bool)
            if len(p.use):
                n, key = p.counted(counts, buckets), p.contexts()
                total, rest = np.zeros(len(key)), np.zeros(len(key))
                for b, i, j in _dealt(key, buckets):
                    if b in kept:
                        at = i + np.flatnonzero(np.unpackbits(np.frombuffer(kept[b]["hit"], np.uint8), count=j - i))
                        total[at], rest[at] = _read_whole(kept[b]["total"], len(at)), np.frombuffer(kept[b]["rest"], "<f4")
                total, rest = total[p.of_context], rest[p.of_context]
                below_q = q[p.use]
                own = np.where(n >= LEAST_NEXT, np.log((n + prior * np.exp(below_q)) / (total + prior)), rest + below_q)
                q[p.use] = np.where(total > 0, own, below_q)
                gram[p.live[p.use]] = level(n, least)
                alive[p.use], again[p.use] = total > 0, n >= LEAST_NEXT
            row["done"] = (np.frombuffer(row["done"], "<f8") + p.spent(p.live[~alive], q[~alive])).tobytes()
            row |= p.left(p.live[alive], q[alive], again[alive], gram) | {"counts": None, "ends": p.ends}
            rows.append(tuple(row[c] for c in names))
        return pa.Table.from_batches([_batch(rows, STATE)])

    names = [x.split(" ")[0] for x in STATE.split(", ")]
    by_page = state.groupBy("page")
    counts = common.cut(state.where("n_live > 0").mapInArrow(paired, PAIRS).groupBy("bucket").applyInArrow(added, ANSWER), "counts")
    common.let_go(state.sparkSession)  # the shuffle of the pairs
    sent = state.where("n_live > 0").groupBy("page").cogroup(counts.groupBy("page")).applyInArrow(summed, CONTEXTS)
    kept = common.cut(sent.groupBy("bucket").applyInArrow(judged, ANSWER), "kept")
    common.let_go(state.sparkSession)  # the shuffle of the contexts
    made = common.cut_by(by_page.cogroup(counts.unionByName(kept).groupBy("page")).applyInArrow(moved, STATE), "page", parts, "state")
    common.discard(counts, kept)
    return made


def _exact_sums(of: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Sums by group that do not depend on the order of arrival."""
    order = np.lexsort((x, of))
    return np.bincount(of[order], x[order], n)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def suffix_tree_scores(docs: DataFrame, held: str = "held_out", least_context: float = 30.0, divergence: float = 30.0, prior: float = 8.0, depth: int | None = None, represented: bool = False, bucket_bytes: int = 16 << 20) -> DataFrame:
    """Score every document; those with a true ``held`` column take no part in learning.  ``depth`` may end the tree early."""
    # About 16 MB of text to a part, which stays dealt by page.
    parts = max(1, math.ceil((docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / (16 << 20)))
    paged = common.cut_by(pages(docs, held).repartition(parts, "page"), "page", parts, "pages")
    common.let_go(docs.sparkSession)  # the shuffle of the pages
    size = paged.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    buckets = max(1, math.ceil(size / bucket_bytes))
    counted = common.cut(word_counts(paged, buckets), "counts")
    totals = counted.where("page is null").agg(F.sum("n_tokens"), F.sum("n_words")).first()
    n_all, v_all = int(totals[0] or 0), int(totals[1] or 0)
    below = n_all + 0.5 * (v_all + 1)
    # A context that says something new has a next symbol seen twice.
    least = max(float(LEAST_NEXT), least_context)
    full = started(paged, counted, buckets, below, least, parts)
    common.discard(paged, counted)
    fixed, state = full.select(*[x.split(" ")[0] for x in FIXED.split(", ")]), full.select(*[x.split(" ")[0] for x in STATE.split(", ")])
    deep = 0
    while depth is None or deep < depth:
        live = state.agg(F.sum("n_live")).first()[0] or 0
        if not live or not n_all:
            break
        deep += 1
        with common.small_batches(docs.sparkSession, 8):  # pages are rows of more than 1 MB
            last, state = state, deeper(state, deep, max(1, math.ceil(live * PAIR_BYTES / bucket_bytes)), below, least, divergence, prior, represented, parts)
        if deep > 1:
            common.discard(last)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = common.arrow_schema(SCORES)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                p = Page(row, 0, below, least)
                score = np.frombuffer(row["done"], "<f8") + p.spent(p.live, p.q)
                ids, fold, sizes, known, base = (np.frombuffer(row[c], kind) for c, kind in (("ids", np.int64), ("held", bool), ("sizes", "<u4"), ("known", "<u4"), ("base", "<f8")))
                columns = [ids, fold, sizes, known, np.full(len(ids), n_all), base / math.log(10), score / math.log(10)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return common.restored(fixed.join(state, "page").mapInArrow(scored, SCORES))
