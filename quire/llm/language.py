"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams (1 to ``longest`` letters, words padded
with ``_``).  A document's own most frequent n-grams are ranked the same way; the out-of-place distance
to a profile adds, for each of them, how far its rank is from its rank there, or the profile's length
if it is missing.  The nearest profile wins; ties go to the language that sorts first.

Profiles are fitted on a sample of labelled documents bounded by ``sample`` for each language, chosen
by a hash of doc_id; all documents are predicted from their whole texts.  Null texts, empty texts and
texts without letters get ``und`` with score 0, and so does every text if nothing can be learned.
Repeated rows are predicted alike; ties of n-gram counts share a rank in a document.  Very long texts are
read whole; an empty table gives an empty result; only the columns named are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm import common

#: Letters and some numerals (such as one half), which ``words`` leaves out.
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Texts of about so many bytes are ranked at once.
CHUNK = 1 << 19
#: More languages than this are refused: one profile of each goes to every executor.
MOST_LANGUAGES = 4096


def words(text: str | None) -> Counter:
    """The runs of letters (general category L) of a text in lower case, and how often each occurs."""
    found = Counter(WORD.findall((text or "").lower()))
    for word in [w for w in found if not w.isalpha()]:
        n = found.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            found[part] += n
    return found


def grams(word: str, longest: int) -> list[str]:
    w = f"_{word}_"
    return [w[i : i + n] for n in range(1, longest + 1) for i in range(len(w) - n + 1) if w[i : i + n] != "_"]


def remainder(id_col: str, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % divisor


def profiles(labelled: DataFrame, size: int = 400, longest: int = 3, sample: int = 4000) -> dict[str, dict[str, int]]:
    """For each language the ranks of its ``size`` most frequent n-grams, learned from (doc_id, text, lang)."""
    counts = {r["lang"]: r["count"] for r in labelled.where("lang is not null").groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if not counts:
        return {}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    spread = 1 << 30
    limit = F.create_map(*[F.lit(y) for lang, n in counts.items() for y in (lang, int(spread * min(1.0, sample / n)))])
    chosen = labelled.where("lang is not null").where(F.pmod(F.xxhash64("doc_id"), F.lit(spread)) < limit[F.col("lang")])
    ddl = "lang string, gram string, n long"
    out_schema = common.arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_lang: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                of_lang.setdefault(lang, Counter()).update(words(text))
        for lang, found in of_lang.items():
            total: Counter = Counter()
            for word, n in found.items():
                for g in grams(word, longest):
                    total[g] += n
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(total)), pa.array(list(total)), pa.array(list(total.values()))], schema=out_schema)

    counted = common.cut(chosen.select("text", "lang").mapInArrow(run, ddl).groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    found: dict[str, dict[str, int]] = {}
    for r in counted.withColumn("place", place).where(F.col("place") <= size).collect():  # languages x size rows at most
        found.setdefault(r["lang"], {})[r["gram"]] = r["place"] - 1
    return found


#: A character takes so many bits of an n-gram's key.
BITS = 21


def _keys(codes: np.ndarray, owner: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact keys of all n-grams of padded words, and the text of each; ``owner`` has the text of every character, -1 for no letter."""
    letter = owner >= 0
    begins = letter & np.append(True, ~letter[:-1] | (owner[1:] != owner[:-1]))
    word = np.cumsum(begins)[letter] - 1
    n_words = int(word[-1]) + 1 if len(word) else 0
    at = np.arange(len(word)) + 2 * word + 1
    padded = np.full(len(word) + 2 * n_words, ord("_"), np.int64)
    padded[at] = codes[letter]
    starts = np.flatnonzero(begins[letter])
    lengths = np.diff(np.append(starts, len(word))) + 2
    of_word = np.repeat(np.arange(n_words), lengths)
    text = np.repeat(owner[letter][starts], lengths)
    keys, texts = [padded[at]], [text[at]]
    key = padded
    for n in range(2, longest + 1):
        m = len(padded) - n + 1
        if m <= 0:
            break
        key = key[:m] + (padded[n - 1 :] << BITS * (n - 1))
        inside = of_word[:m] == of_word[n - 1 :]
        keys.append(key[inside])
        texts.append(text[:m][inside])
    return np.concatenate(keys), np.concatenate(texts)


class _Ranker:
    """The rank of every profiled n-gram in every profile, and predictions for many texts at once."""

    def __init__(self, ranks: dict[str, dict[str, int]], size: int, longest: int):
        self.langs, self.size, self.longest = sorted(ranks), size, longest
        key = lambda g: sum(ord(c) << BITS * i for i, c in enumerate(g))
        every = sorted({(key(g), g) for lang in ranks for g in ranks[lang]})
        self.known = np.array([k for k, _ in every], np.int64)
        # The last row is that of n-grams in no profile.
        self.table = np.array([[ranks[lang].get(g, -1) for lang in self.langs] for _, g in every] + [[-1] * len(self.langs)], np.int64)
        self.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [(UNKNOWN, 0.0)] * len(texts)
        if not self.langs:
            return found
        lowered = [(t or "").lower() for t in texts]
        codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
        keys, of = _keys(codes, np.where(self.letter[codes], owner, -1), self.longest)
        order = np.argsort(of, kind="stable")
        keys, ends = keys[order], np.searchsorted(of[order], np.arange(len(texts) + 1))
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            if a == b:
                continue
            distinct, counts = np.unique(keys[a:b], return_counts=True)
            falling = -np.sort(-counts)
            rank = np.searchsorted(-falling, -counts, side="left")  # how many are strictly more frequent
            use = rank < self.size
            own, rank = distinct[use], rank[use]
            at = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
            there = self.table[np.where(self.known[at] == own, at, len(self.known))]
            apart = np.where(there < 0, self.size, np.minimum(np.abs(there - rank[:, None]), self.size)).sum(0)
            best = int(np.argmin(apart))
            found[i] = self.langs[best], float(1 - apart[best] / (self.size * len(own)))
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def identify(docs: DataFrame, ranks: dict[str, dict[str, int]], size: int = 400, longest: int = 3, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_pred and score (0 to 1) for every row."""
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col("`text`").alias("text_to_rank"))
    ddl_schema = source.drop("text_to_rank").schema.add("lang_pred", "string").add("score", "double")
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(ddl_schema)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranker = _Ranker(ranks, size, longest)
        for batch in batches:
            _, offsets = common.text_bytes(batch.column(n))
            for i, j in common.slices(offsets, CHUNK):
                part = batch.slice(i, j - i)
                found = ranker.predict_all(part.column(n).to_pylist())
                columns = [part.column(c).cast(f.type) for c, f in zip(range(n), out_schema)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], schema=out_schema)

    return source.mapInArrow(run, ddl_schema)


def language_id(docs: DataFrame, size: int = 400, longest: int = 3, sample: int = 4000, folds: int = 3, held: int = 1, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc_id, held_out, lang_pred and score; documents of fold ``held`` take no part in learning."""
    if not 1 <= longest <= 3:
        raise ValueError("n-grams have one to three letters")
    fold = remainder("doc_id", folds)
    ranks = profiles(common.named(docs.where(fold != held), "doc_id", "text", "lang"), size, longest, sample)
    found = identify(docs, ranks, size, longest, keep)
    return found.withColumn("held_out", fold == held)
