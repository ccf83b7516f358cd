"""Each operator against a brute-force version, with odd rows, ties, repeats, empty tables and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import bpe, chat, components, language, lines, media, near, packing, queries, repeats, suffix_tree, topk

LOW = -(1 << 63)


def by_id(rows):
    return {r[0]: (r[1] or "").encode() for r in rows}


def test_media_round_trip(docs, rows, empty):
    got = {r.doc_id: r for r in media.store_texts(docs, with_media=True).collect()}
    for key, text in by_id(rows).items():
        r, payload = got[key], media.text_payload(text)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(text), len(payload), hashlib.sha256(payload).hexdigest())
        assert len(payload) % 576 == 0 and payload and r.tail_crc32 == zlib.crc32(payload[-32:])
        assert r.media_sha256 == hashlib.sha256(r.media).hexdigest() and r.media_bytes == len(r.media)
        assert all(bytes(r.media)[k.start : k.start + k.length] == payload[i * 12 * 576 : i * 12 * 576 + 576] for i, k in enumerate(r.keyframes))
    assert media.store_texts(empty).count() == 0


def test_media_probe(spark):
    good = media.mux(bytes(576 * 100))
    frame = spark.createDataFrame([(1, bytearray(good)), (2, bytearray(b"junk")), (3, None), (4, bytearray(good[:200]))], "doc_id long, media binary")
    got = {r.doc_id: r for r in media.probe(frame, "doc_id", "media").collect()}
    assert got[1].codec == "raw " and got[1].n_samples == 100 and got[1].seconds == pytest.approx(100 / 24) and got[1].n_keyframes == 9
    assert all(got[i].track == -1 and got[i].error for i in (2, 3) if i in got)
    assert got[3].error


def test_media_probe_odd_containers(spark):
    """Deep nesting, impossible counts and truncation give rows with an error; fragments give their samples."""
    import struct

    deep = b""
    for _ in range(3000):
        deep = media.box(b"moov", deep)
    good = media.mux(bytes(576 * 4))
    at = good.index(b"stsz") + 8
    many = good[: at + 4] + struct.pack(">I", 4_000_000_000) + good[at + 8 :]
    at = good.index(b"trak") - 4
    (size,) = struct.unpack_from(">I", good, at)
    # The same track without samples of its own, then two fragments of five samples.
    track = media.mux(bytes(576))
    empty = [media.full(b"stts", bytes(4)), media.full(b"stss", bytes(4)), media.full(b"stsc", bytes(4)), media.full(b"stsz", bytes(8)), media.full(b"stco", bytes(4))]
    stsd_at = track.index(b"stsd") - 4
    stsd = track[stsd_at : stsd_at + struct.unpack_from(">I", track, stsd_at)[0]]
    part = lambda name: track[track.index(name) - 4 :][: struct.unpack_from(">I", track, track.index(name) - 4)[0]]
    minf = media.box(b"minf", part(b"vmhd"), part(b"dinf"), media.box(b"stbl", stsd, *empty))
    mdhd = media.full(b"mdhd", struct.pack(">IIIIHH", 0, 0, 10, 0, 0x55C4, 0))
    trak = media.box(b"trak", part(b"tkhd"), media.box(b"mdia", mdhd, part(b"hdlr"), minf))
    trex = media.full(b"trex", struct.pack(">5I", 1, 1, 2, 7, 0x10000))
    head = part(b"ftyp") + media.box(b"moov", part(b"mvhd"), trak, media.box(b"mvex", trex))

    def fragment(sizes=None):
        fields = struct.pack(f">{len(sizes)}I", *sizes) if sizes else b""
        make = lambda offset: media.box(b"moof", media.full(b"mfhd", struct.pack(">I", 1)), media.box(b"traf", media.full(b"tfhd", struct.pack(">I", 1), flags=0x20000), media.full(b"trun", struct.pack(">IiI", 5, offset, 0x2000000), fields, flags=0x5 | (0x200 if sizes else 0))))
        return make(len(make(0)) + 8)

    one, two = fragment([3, 4, 5, 6, 7]), fragment()
    whole = head + one + media.box(b"mdat", bytes(25)) + two + media.box(b"mdat", bytes(35))
    rows = [(1, bytearray(deep)), (2, bytearray(many)), (3, bytearray(good[:-1])), (4, bytearray(good[: at + size])), (5, bytearray(whole))]
    got = {r.doc_id: r for r in media.probe(spark.createDataFrame(rows, "doc_id long, media binary"), "doc_id", "media").collect()}
    assert all(got[i].track == -1 and got[i].error for i in (1, 2, 3, 4))
    r, first, second = got[5], len(head) + len(one) + 8, len(head) + len(one) + 33 + len(two) + 8
    assert (r.error, r.n_samples, r.seconds, r.codec) == (None, 10, 2.0, "raw ")
    assert [(k.start, k.length) for k in r.keyframes] == [(first, 3), (second, 7)]


def test_language_brute_force(spark, docs, rows):
    """Profiles and distances recomputed without tables of numbers; numerals are no letters, long texts are read whole."""
    import unicodedata

    odd = [(500, "½ ²"), (501, "½a²b"), (502, "ǅ" * 3 + " das ist"), (503, " ".join(f"wort{i}" for i in range(30000))), (504, "一二三 漢字")]
    texts = {r[0]: r[1] or "" for r in rows if r[0] is not None} | dict(odd)
    lang = {r[0]: r[2] for r in rows if r[0] is not None}
    frame = spark.createDataFrame([(k, t, lang.get(k)) for k, t in texts.items()], "doc_id long, text string, lang string")

    def counted(text):
        letters = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in text.lower())
        return Counter(f"_{w}_"[i : i + n] for w in letters.split() for n in (1, 2, 3) for i in range(len(w) + 3 - n) if f"_{w}_"[i : i + n] != "_")

    total = defaultdict(Counter)
    for k, t in texts.items():
        if lang.get(k) and zlib.crc32(str(k).encode()) % 3 != 1:
            total[lang[k]] += counted(t)
    profile = {x: {g: i for i, (g, _) in enumerate(sorted(c.items(), key=lambda z: (-z[1], z[0].encode()))[:400])} for x, c in total.items()}
    got = {r.doc_id: r for r in language.language_id(frame).collect()}
    for k, t in texts.items():
        own = counted(t)
        if not own:
            assert (got[k].lang_pred, got[k].score) == ("und", 0.0)
            continue
        rank = {g: sum(m > n for m in own.values()) for g, n in own.items()} if len(own) < 3000 else None
        if rank is None:
            falling = sorted(own.values(), reverse=True)
            rank = {g: falling.index(n) for g, n in own.items()}
        used = {g: i for g, i in rank.items() if i < 400}
        apart = {x: sum(min(abs(p[g] - i), 400) if g in p else 400 for g, i in used.items()) for x, p in profile.items()}
        best = min(sorted(apart), key=apart.get)
        assert got[k].lang_pred == best and got[k].score == pytest.approx(1 - apart[best] / (400 * len(used)))


def brute_topk(vectors, k=5):
    out = set()
    for q, x in vectors:
        if q % 50 == 0:
            best = sorted(((-sum(a * b for a, b in zip(x, y)), i) for i, y in vectors if i != q))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


def test_topk(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=8).astype("float32")]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # ties
    bad = [(900, None), (901, [1.0] * 7 + [None]), (902, [float("nan")] * 8), (950, [float("inf")] * 8)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    v = topk.integer_vectors(frame, "vec_id", "embedding")
    got = {tuple(r) for r in topk.top_k(v.where("vec_id % 50 = 0"), v, block=64, query_block=4).collect()}
    assert got == brute_topk([(i, [math.floor(256 * float(np.float32(x))) for x in e]) for i, e in rows])
    few = v.where("vec_id < 3")
    assert topk.top_k(few.where("vec_id = 0"), few).count() == 2
    assert topk.top_k(v.limit(0), v.limit(0)).count() == 0


def brute_repeats(texts, length):
    seen, out = set(), {}
    for key in sorted(texts, key=lambda k: LOW if k is None else k):
        b = texts[key]
        step = np.zeros(len(b) + 1, int)
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                step[s] += 1
                step[s + length] -= 1
            seen.add(w)
        gone = np.cumsum(step[:-1]) > 0
        spans = int((gone[1:] & ~gone[:-1]).sum() + (len(gone) > 0 and gone[0]))
        out[key] = (len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest())
    return out


@pytest.mark.parametrize("length", [100, 64])
def test_repeats(docs, rows, empty, length):
    got = {r[0]: tuple(r)[1:5] for r in repeats.repeated_spans(docs, length, bucket_bytes=1 << 14).collect()}
    assert got == brute_repeats(by_id(rows), length)
    if length == 100:
        assert repeats.repeated_spans(empty).count() == 0
        texts = {r.doc_id: r.kept for r in repeats.repeated_spans(docs, with_text=True).select("doc_id", "kept").collect()}
        assert texts[3] == "" and texts[15].startswith("zwölf") and texts[21] == ""


def test_repeats_keep_characters(spark):
    head = "é" * 100
    frame = spark.createDataFrame([(1, "x" + head), (2, "yy" + head + "ü")], "doc_id long, text string")
    r = repeats.repeated_spans(frame, with_text=True).where("doc_id = 2").first()
    assert r.kept.startswith("yy") and r.kept.endswith("ü") and "�" not in r.kept


def test_language(docs, rows, empty, spark):
    english, german = "the quick brown fox jumps over the lazy dog and then the other one", "der schnelle braune fuchs springt über den faulen hund und dann noch einer"
    made = [(i, f"{english if i % 2 else german} {i}", "en" if i % 2 else "de", "s") for i in range(60)] + [(100, None, "en", "s"), (101, "12 34 !!", None, "s"), (102, "the dog and the fox", None, "s")]
    frame = spark.createDataFrame(made, "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r for r in language.language_id(frame).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(60)) and got[102].lang_pred == "en"
    assert got[100].lang_pred == got[101].lang_pred == "und" and got[100].score == 0
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= got[i].score <= 1 for i in got)
    assert language.language_id(empty).count() == 0
    assert {r.lang_pred for r in language.language_id(frame.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_language_distance():
    """The out-of-place distance of one text, by hand."""
    ranks = {"a": {"x": 0, "_x": 1}, "b": {"y": 0}}
    ranker = language._Ranker(ranks, 10, 2)
    found = Counter(g for w in ["x"] for g in language.grams(w, 2))  # x, _x, x_ once each: all have rank 0
    apart = sum(min(10, abs(ranks["a"][g] - 0)) if g in ranks["a"] else 10 for g in found)
    assert ranker.predict("x") == ("a", pytest.approx(1 - apart / (10 * len(found))))


def brute_lines(texts, size):
    seen, out = set(), {}
    for key in sorted(texts, key=lambda k: LOW if k is None else k):
        ls = texts[key].decode().split("\n")
        gone = set()
        for i in range(len(ls) - size + 1):
            w = tuple(ls[i : i + size])
            if not "".join(w).split():
                continue
            if w in seen:
                gone |= set(range(i, i + size))
            seen.add(w)
        runs = [i for i in gone if i - 1 not in gone]
        out[key] = ("\n".join(x for i, x in enumerate(ls) if i not in gone), len(ls), len(gone), len(runs))
    return out


@pytest.mark.parametrize("size", [1, 2, 3])
def test_lines(docs, rows, empty, size):
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed, r.n_runs) for r in lines.line_dedup(docs, size).collect()}
    assert got == brute_lines(by_id(rows), size)
    if size == 2:
        assert lines.line_dedup(empty).count() == 0


def test_lone_passages(spark):
    """A long line goes wherever it comes again, alone or beside a repeated run; the pipeline asks for that."""
    import corpus_pipeline

    passage = " ".join(f"p{i}" for i in range(60))
    texts = {1: f"a\n{passage}\nb", 2: f"c\n{passage}\nd", 3: passage, 4: f"short\nd\n{passage}\na\nb", 5: "a\nshort", 6: f"{passage}\nb\n{passage}"}
    frame = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: (r.text, r.n_removed, r.n_runs) for r in lines.line_dedup(frame, 2, passage_words=60).collect()}
    assert got == {1: (texts[1], 0, 0), 2: ("c\nd", 1, 1), 3: ("", 1, 1), 4: ("short\nd\na\nb", 1, 1), 5: (texts[5], 0, 0), 6: ("", 3, 1)}
    assert {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, frame, "").collect()} == {k: t for k, (t, n, _) in got.items() if t}


def test_chat(spark):
    rows = [(1, 0, "a", "Hello there.\n\nHow do I sort a list?"), (1, 1, "b", "> How do I  sort a LIST?\nUse sorted().\nIt is stable."), (1, 2, "a", "On Monday b wrote:\n> > How do I sort a list?\n> Use sorted().\n> It is stable.\nThanks!"), (1, 3, "c", "unrelated"), (1, 4, "c", "> nothing known\nx"), (None, 0, None, None), (1, 5, "d", ">Thanks!\n:)"), (2, 1, "d", "> Thanks!"), (1, 3, "c", "unrelated")]
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, passage int, depth int")
    got = {(r.conv_id, r.turn): (r.text, r.reply_to, r.thread, r.depth, r.n_quotes, r.n_linked) for r in chat.link_quotations(frame).collect()}
    assert got[1, 1] == ("Use sorted().\nIt is stable.", 0, 0, 1, 1, 1)
    assert got[1, 2] == ("Thanks!", 1, 0, 2, 2, 2)
    assert got[1, 5] == (":)", 2, 0, 3, 1, 1)
    assert got[1, 4] == ("x", None, 4, 0, 1, 0) and got[2, 1] == ("", None, 1, 0, 1, 0) and got[None, 0] == ("", None, 0, 0, 0, 0)
    assert len(got) == 8 and chat.link_quotations(frame.limit(0)).count() == 0


def test_suffix_tree(docs, rows, empty):
    held = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(False))
    got = {r.doc_id: r for r in suffix_tree.suffix_tree_scores(docs.select("doc_id", "text", held.alias("held_out")), least_context=1e-3, divergence=5.0).collect()}
    tokens = {k: [*t.lower().split(), None] for k, t in by_id(rows).items()}
    c = Counter(x for k, w in tokens.items() if k is None or k % 5 != 1 for x in w)
    n, v = sum(c.values()), len(c)
    for k, w in tokens.items():
        r = got[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
        assert r.score < 0
    assert suffix_tree.suffix_tree_scores(empty.select("doc_id", "text", F.lit(False).alias("held_out"))).count() == 0


def brute_tree(texts, held, least, divergence, prior, represented=False):
    """Scores by a tree in dictionaries, of any depth."""
    seqs = {k: [*t.lower().split(), None] for k, t in texts.items()}
    c = Counter(x for k, w in seqs.items() if k not in held for x in w)
    below = sum(c.values()) + 0.5 * (len(c) + 1)
    tree, deepest = {}, 0

    def p(context, x):
        while context and context not in tree:
            context = context[1:]
        if not context:
            return (c[x] + 0.5) / below
        n, total, rest = tree[context]
        return (n[x] + prior * p(context[1:], x)) / (total + prior) if n[x] > 1 else rest * p(context[1:], x)

    while True:
        found = defaultdict(Counter)
        for k, w in seqs.items():
            for i, x in enumerate(w if k not in held else []):
                context = tuple([None, *w][i - deepest : i + 1])
                if i >= deepest and (not deepest or context[1:] in tree):
                    found[context][x] += 1
        new = {}
        for context, n in found.items():
            total = sum(n.values())
            gain = [m * math.log(m / total / p(context[1:], x)) for x, m in n.items() if m > 1 or not represented]
            once = total - sum(m for m in n.values() if m > 1)
            if represented and once:
                gain.append(once * math.log(once / total / (1 - sum(p(context[1:], x) for x in n if n[x] > 1))))
            if total >= least and max(n.values()) > 1 and sum(gain) >= divergence:
                own = [x for x in n if n[x] > 1]
                under = sum(p(context[1:], x) for x in own)
                new[context] = (n, total, (1 - (sum(n[x] for x in own) + prior * under) / (total + prior)) / (1 - under))
        if not new:
            break
        tree |= new
        deepest += 1
    return deepest, {k: sum(math.log10(p(tuple([None, *w][: i + 1]), x)) for i, x in enumerate(w)) for k, w in seqs.items()}


@pytest.mark.parametrize("represented,divergence", [(False, 30.0), (True, 2.0)])
def test_suffix_tree_grows(spark, represented, divergence):
    """Contexts go as deep and as rare as the counts allow, over many pages and buckets."""
    rng = np.random.default_rng(8)
    texts = {}
    for i in range(40):
        words = []
        for a in rng.integers(0, 2, 10):
            words += [f"w{a}", "and", "then", f"v{a}", f"rare{rng.integers(0, 300)}"]
        texts[i] = " ".join(words)
    texts |= {200: "", 201: "w0 and then", 202: texts[3]}
    held = {k for k in texts if k % 5 == 1}
    deepest, want = brute_tree(texts, held, 4, divergence, 8.0, represented)
    assert deepest >= 3
    frame = spark.createDataFrame([(k, t, k in held) for k, t in texts.items()], "doc_id long, text string, held_out boolean").repartition(5)
    got = {r.doc_id: r.score for r in suffix_tree.suffix_tree_scores(frame, least_context=4, divergence=divergence, represented=represented, bucket_bytes=1 << 14).collect()}
    assert got == {k: pytest.approx(x) for k, x in want.items()}


def test_suffix_tree_sums_of_pages():
    """What each page adds for its own occurrences makes up the sums over distinct pairs, which go out in nine bytes each."""
    rng = np.random.default_rng(5)
    words = np.array([0, 1, 2, 10, 11, 12, 13], np.uint64)
    texts = [[np.append(rng.integers(3, 7, 400), 0) for _ in range(2)] for _ in range(3)]
    count = np.bincount(np.concatenate(sum(texts, [])), minlength=7)
    below = count.sum() + 0.5 * 6
    rows = []
    for i, own in enumerate(texts):
        tokens = np.concatenate(own)
        first = np.cumsum([0, *map(len, own)]).astype("<u4")
        rows.append({"page": i, "first": first.tobytes(), "words": words.tobytes(), "counts": count.astype("<u8").tobytes(), "tokens": suffix_tree._packed(tokens, 7), "gram": suffix_tree.level(count, 2)[tokens].tobytes(), "held": bytes(2), "live": None})
    pages = [suffix_tree.Page(r, 1, below, 2.0) for r in rows]
    pairs, found = Counter(), defaultdict(lambda: np.zeros(4))
    for p in pages:
        assert sum(len(p.pair[i:j].tobytes()) + len(suffix_tree._told(p.pair_n[i:j])) for _, i, j in suffix_tree._dealt(p.pair, 3)) <= 9 * len(p.pair) + 8 * (p.pair_n > 254).sum()
        pairs.update(dict(zip(p.pair.tolist(), p.pair_n.tolist())))
    for p in pages:
        answers = {b: suffix_tree._told(np.array([pairs[x] for x in p.pair[i:j].tolist()])) for b, i, j in suffix_tree._dealt(p.pair, 3)}
        keys = p.contexts()
        for key, *sums in zip(keys.tolist(), *p.sums(p.counted(answers, 3), True)):
            found[key] += sums
    n = defaultdict(Counter)
    for own in sum(texts, []):
        for a, b in zip([0, *own], own):
            n[a][b] += 1
    q = np.log((count + 0.5) / below)
    want = [(sum(c.values()), sum(m for m in c.values() if m > 1), sum(m * (math.log(m) - q[x]) for x, m in c.items() if m > 1), sum(math.exp(q[x]) for x, m in c.items() if m > 1)) for c in n.values()]
    assert sorted(map(tuple, found.values())) == [pytest.approx(x) for x in sorted(want)]
    counts = np.array([0, 254, 255, 1 << 33])
    assert suffix_tree._counts(suffix_tree._told(counts), 4).tolist() == counts.tolist()
    assert all(suffix_tree._read_whole(suffix_tree._whole(x), len(x)).tolist() == x.tolist() for x in (counts, counts[:3], counts[:0]))


def test_suffix_tree_pages_shrink():
    """A page keeps the stretches that open tokens can reach; it asks there for what the whole page would ask for."""
    rng = np.random.default_rng(6)
    texts = [np.append(np.where(rng.random(300) < 0.6, rng.integers(3, 5, 300), rng.integers(5, 400, 300)), 0) for _ in range(6)]
    tokens, least = np.concatenate(texts), 8.0
    words = np.concatenate([np.arange(3), np.arange(10, 407)]).astype(np.uint64)
    count = np.bincount(tokens, minlength=400)
    below, first = count.sum() + 0.5 * 401, np.cumsum([0, *map(len, texts)]).astype("<u4")
    fixed = {"page": 0, "first": first.tobytes(), "words": words.tobytes(), "counts": count.astype("<u8").tobytes(), "tokens": suffix_tree._packed(tokens, 400), "gram": suffix_tree.level(count, least)[tokens].tobytes(), "held": bytes(6), "done": bytes(48)}
    whole = fixed | {"live": None}
    slim, sizes, asked = whole, [], []
    for depth in range(1, 5):
        p, s = suffix_tree.Page(whole, depth, below, least), suffix_tree.Page(slim, depth, below, least)
        assert (s.key.tolist(), s.pair.tolist(), s.pair_n.tolist()) == (p.key.tolist(), p.pair.tolist(), p.pair_n.tolist())
        sizes.append(len(s.tokens))
        asked.append(len(s.use))
        for x in (p, s):
            seen = Counter(x.key.tolist())
            pairs = dict(zip(x.pair.tolist(), x.pair_n.tolist()))
            n = np.zeros(len(x.use), np.int64)
            n[x.paired] = [pairs[y] for y in x.pair[x.of_pair].tolist()]
            hit = np.array([seen[y] >= least for y in x.key.tolist()], bool)
            gram = x.gram.copy()
            gram[x.live[x.use]] = suffix_tree.level(n, least)
            live, q, again = x.live[x.use][hit], x.q[x.use][hit], (n >= 2)[hit]
            if x is s:
                gone = np.setdiff1d(np.arange(len(x.live)), x.use[hit])
                now = x.row | {"done": (np.frombuffer(x.row["done"], "<f8") + x.spent(x.live[gone], x.q[gone])).tobytes(), "ends": x.ends, "counts": None}
                x.row = now
                slim = now | x.left(live, q, again, gram)
            else:
                bits = np.zeros(len(gram), bool)
                bits[live] = True
                whole = fixed | {"live": np.packbits(bits).tobytes(), "doc": np.arange(6, dtype="<u4").tobytes(), "cut": bytes(1), "ends": x.ends, "q": q.astype("<f4").tobytes(), "again": np.packbits(again).tobytes(), "gram": gram.tobytes()}
        end = suffix_tree.Page(slim, 0, below, least)
        q = np.log((count + 0.5) / below)
        assert np.frombuffer(slim["done"], "<f8") + end.spent(end.live, end.q) == pytest.approx([q[x].sum() for x in texts])
    assert asked[3] > 0 and sizes[0] == len(tokens) and sizes[1] < 0.7 * sizes[0] and sizes[3] < 0.4 * sizes[0]


def test_tree_is_a_distribution():
    """The next-symbol probabilities of every state sum to one, whatever was kept."""
    rng = np.random.default_rng(1)
    symbols = suffix_tree.Symbols(np.arange(10, 18, dtype=np.uint64), rng.integers(5, 50, 8), 400, 60, 20)
    tree = suffix_tree.Tree(symbols)
    tree.add([(2,), (3,)], np.array([0, 0, 1]), np.array([4, 5, 6]), np.array([7.0, 3.0, 9.0]), np.array([20.0, 11.0]), 4.0)
    tree.add([(5, 3)], np.array([0]), np.array([6]), np.array([5.0]), np.array([6.0]), 4.0)
    every = np.arange(len(symbols.root))
    for state in range(len(tree.parent)):
        assert np.exp(tree.log_p(np.full(len(every), state), every)).sum() == pytest.approx(1)


def brute_near(texts, width, percent):
    sets = {}
    for k, t in texts.items():
        w = t.lower().split()
        sets[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    up = {k: k for k in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    order = sorted(texts, key=lambda k: LOW if k is None else k)
    for i, a in enumerate(order):
        for b in order[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)), key=order.index)
                up[y] = x
    return {k: (len(sets[k]), root(k)) for k in texts}


@pytest.mark.parametrize("width,short", [(2, 24), (5, 2)])
def test_near(docs, rows, empty, width, short):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(docs, width, 80, short=short).collect()}
    assert got == brute_near(by_id(rows), width, 80)
    if width == 2:
        assert near.near_duplicates(empty).count() == 0


def test_near_hot_group(spark):
    """A group of near copies around the threshold, some of them alone, and texts that share a passage only."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    base, passage = [word() for _ in range(150)], [word() for _ in range(90)]
    texts = {}
    for i in range(160):
        w = list(base)
        for j in rng.sample(range(150), rng.choice((1, 3, 6, 8, 9, 10, 12, 20))):
            w[j] = word()
        texts[i] = " ".join(w).encode()
    for i in range(160, 240):
        texts[i] = " ".join(passage + [word() for _ in range(rng.choice((8, 12, 30)))]).encode()
    frame = spark.createDataFrame([(k, t.decode()) for k, t in texts.items()], "doc_id long, text string")
    want = brute_near(texts, 2, 80)
    assert 20 < len(set(c for _, c in want.values())) < 240
    for k, wide in ((64, 1024), (40, 96), (512, 512)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near.near_duplicates(frame, 2, 80, k=k, wide=wide, short=8).collect()}
        assert got == want


def test_near_leaves_no_steps(spark):
    """Counts of values and labelled lists are deleted as soon as nothing reads them."""
    from pathlib import Path

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    steps = lambda: {x.name for kind in ("shared", "labelled") for x in folder.glob(f"quire-{kind}-*")}
    before = steps()
    frame = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(40 + i % 2))) for i in range(6)], "doc_id long, text string")
    assert {r.component_id for r in near.near_duplicates(frame, 2).collect()} == {0}
    assert steps() == before


def test_near_bounds():
    assert near.least_shared(40, 100) == 40 and near.least_shared(64, 80) < 0.8 * 64
    # The chance to share fewer values is small whatever the similarity and the size of the sketch.
    from math import comb

    for k, percent in ((10, 50), (40, 80), (64, 60)):
        m, p = near.least_shared(k, percent), percent / 100
        assert sum(comb(k, i) * p**i * (1 - p) ** (k - i) for i in range(m)) <= near.MISSED


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 200)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def test_bpe(docs, rows, empty, spark):
    tiktoken = pytest.importorskip("tiktoken")
    tok = pytest.importorskip("public_tokenizers")
    ranks = bpe.read_ranks(queries.tokenizer_path(queries.MULTI_RANKS))
    reference = tiktoken.Encoding("own", pat_str=tok.PATTERN, mergeable_ranks=bpe.parse_ranks(ranks), special_tokens={})
    odd = [(1000 + i, t) for i, t in enumerate(["'s", "x'll've", " 's  'd", "''re", "a \n\n b  c\t", "½²中文 1234", "a" * 5000 + " " * 700 + "b", "\x1c\x85 ", "<|endoftext|>"])]
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = {r.doc_id: r for r in bpe.encode_decode(frame, ranks, keep_ids=True).collect()}
    for key, text in {**{r[0]: r[1] for r in rows}, **dict(odd)}.items():
        ids = reference.encode_ordinary(text or "")
        r = got[key]
        assert r.ids == ids and r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest() and (r.ends[-1] if ids else 0) == len((text or "").encode())
    assert bpe.encode_decode(empty, ranks).count() == 0


def test_packing(docs, rows, empty, spark):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(queries.tokenizer_path(queries.PACKING_VOCABULARY))
    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(5000, "a <|endoftext|> b")], "doc_id long, text string"))
    got = queries.packing_of(frame).toPandas()
    texts = {**{r[0]: r[1] or "" for r in rows}, 5000: "a <|endoftext|> b"}
    pieces = defaultdict(list)
    for r in got.itertuples():
        pieces[None if r.doc_id != r.doc_id else int(r.doc_id)].append(r)
    for key, text in texts.items():
        ids = np.array([*reference.encode(text, add_special_tokens=False).ids, 1], "<u4")
        own = sorted(pieces[key], key=lambda r: r.start)
        assert [r.start for r in own] == list(np.cumsum([0, *(r.length for r in own)])[:-1]) and sum(r.length for r in own) == len(ids)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids) for r in own)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert list(g["offset"]) == list(np.cumsum([0, *g["length"]])[:-1]) and g["length"].sum() <= 2048
    assert queries.packing_of(empty).count() == 0


def test_shared_ids(spark):
    """Rows that share an id, or have none, are all looked at and returned with their own text."""
    words = lambda a, n=40: " ".join(f"{a}{i}" for i in range(n))
    rows = [(None, words("a")), (None, words("b")), (None, words("b")), (1, words("c")), (1, words("d") + "\n" + words("e")), (2, words("d") + "\n" + words("e")), (2, None)]
    frame = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    found = lines.line_dedup(frame).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_removed) for r in found) == sorted((k or 0, "" if (k, t) == rows[5] else t or "", 2 * ((k, t) == rows[5])) for k, t in rows)
    found = repeats.repeated_spans(frame, with_text=True).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in found) == sorted([(0, words("a")), (0, words("b")), (0, ""), (1, words("c")), (1, rows[4][1]), (2, ""), (2, "")])
    found = near.near_duplicates(frame, 2).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [(0, 0, False), (0, 0, True), (0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False), (2, 2, True)]
    import corpus_pipeline

    kept = corpus_pipeline.suffix_dedup(spark, corpus_pipeline.minhash_near_dedup(spark, frame, ""), "")
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, words("a")), (0, words("b")), (1, words("c")), (1, rows[4][1]), (2, "")])


def test_nnls():
    rng = np.random.default_rng(2)
    a = rng.random((12, 20))
    x = np.maximum(rng.normal(size=20), 0)
    got = packing.nnls(a, a @ x)
    assert (got >= 0).all() and np.abs(a @ got - a @ x).max() < 1e-6
    assert all(sum(c) == 16 and list(c) == sorted(c, reverse=True) for c in packing.combinations(16, 3))


def test_pipeline(spark, docs, tmp_path):
    import corpus_pipeline

    docs.select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path)).cache()
        assert kept.columns == list(corpus_pipeline.COLUMNS)
        assert kept.where("n_chars <> length(text) and n_chars is not null").count() == 0
        sizes.append(kept.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[0] < docs.count() and sizes[2] < sizes[1]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() >= sizes[-1]
