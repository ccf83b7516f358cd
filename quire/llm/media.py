"""ISO media containers: a muxer for fixed-size samples and a reader of boxes and sample tables.

The reader walks nested boxes, decodes the sample tables (sizes, chunks, offsets, durations, sync
samples) and gives codec, duration and the byte ranges of key frames.  It never decodes a payload.
A container that cannot be read gives a row with ``error`` set and the other fields null.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm import common

#: Boxes that hold boxes (fixed values of the format).
NESTED = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
#: Bytes of a visual or audio sample entry before its own child boxes.
SAMPLE_BYTES = 576
MATRIX = struct.pack(">9i", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def box(kind: bytes, *body: bytes) -> bytes:
    size = 8 + sum(map(len, body))
    return b"".join((struct.pack(">I4s", size, kind), *body)) if size < 1 << 32 else b"".join((struct.pack(">I4sQ", 1, kind, size + 8), *body))


def full(kind: bytes, *body: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *body)


def mux(payload: bytes, sample: int = SAMPLE_BYTES, side: int = 24, key_every: int = 12, per_chunk: int = 32, timescale: int = 24) -> bytes:
    """Store ``payload`` (a positive multiple of ``sample`` bytes) as uncompressed 8-bit pictures of side x side."""
    if not payload or len(payload) % sample or side * side != sample:
        raise ValueError("the payload must be a positive multiple of the sample size")
    n = len(payload) // sample
    chunks = -(-n // per_chunk)
    last = n - (chunks - 1) * per_chunk
    keys = range(1, n + 1, key_every)
    entry = box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(16), struct.pack(">HHIIIH", side, side, 0x480000, 0x480000, 0, 1), bytes(32), struct.pack(">Hh", 40, -1))
    runs = [(1, per_chunk, 1)] + ([(chunks, last, 1)] if last != per_chunk and chunks > 1 else []) if chunks > 1 else [(1, last, 1)]
    ftyp = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")

    def moov(base: int) -> bytes:
        offsets = [base + i * per_chunk * sample for i in range(chunks)]
        big = offsets[-1] >= 1 << 32
        stbl = box(
            b"stbl",
            full(b"stsd", struct.pack(">I", 1), entry),
            full(b"stts", struct.pack(">III", 1, n, 1)),
            full(b"stss", struct.pack(f">I{len(keys)}I", len(keys), *keys)),
            full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            full(b"stsz", struct.pack(">II", sample, n)),
            full(b"co64" if big else b"stco", struct.pack(f">I{chunks}{'Q' if big else 'I'}", chunks, *offsets)),
        )
        dinf = box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1)))
        minf = box(b"minf", full(b"vmhd", bytes(8), flags=1), dinf, stbl)
        mdia = box(b"mdia", full(b"mdhd", struct.pack(">IIIIHH", 0, 0, timescale, n, 0x55C4, 0)), full(b"hdlr", bytes(4), b"vide", bytes(12), b"\0"), minf)
        tkhd = full(b"tkhd", struct.pack(">IIIII", 0, 0, 1, 0, n), bytes(16), MATRIX, struct.pack(">II", side << 16, side << 16), flags=3)
        mvhd = full(b"mvhd", struct.pack(">IIIIIH", 0, 0, timescale, n, 0x10000, 0x100), bytes(10), MATRIX, bytes(24), struct.pack(">I", 2))
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    head = 8 if len(payload) + 8 < 1 << 32 else 16
    base = len(ftyp) + len(moov(0)) + head
    return b"".join((ftyp, moov(base), box(b"mdat", payload)))


def boxes(data: memoryview, begin: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Kind, first and last byte (exclusive) of the body of every box between two positions."""
    at = begin
    while at + 8 <= end:
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            (size,), head = struct.unpack_from(">Q", data, at + 8), 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise ValueError(f"box {kind!r} at {at} has a bad size")
        yield kind, at + head, at + size
        at += size


#: Boxes nested deeper than this are refused.
DEEPEST = 32


def tracks(data: bytes) -> list[dict]:
    """Walk the nested boxes of a container and decode each track's sample tables and fragments."""
    view = memoryview(data)
    found: list[dict] = []
    fragments: list[tuple[int, dict]] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    todo = [(0, len(data), None, 0)]  # begin, end, where leaves go, depth
    while todo:
        begin, end, holder, depth = todo.pop()
        if depth > DEEPEST:
            raise ValueError("boxes are nested too deeply")
        inner = []
        for kind, a, b in boxes(view, begin, end):
            if kind == b"trak":
                found.append(own := {})
                inner.append((a, b, own, depth + 1))
            elif kind == b"traf":
                fragments.append((begin - 8, own := {b"trun": []}))
                inner.append((a, b, own, depth + 1))
            elif kind in NESTED:
                inner.append((a, b, None if kind == b"moof" else holder, depth + 1))
            elif kind == b"trex":
                track, _, *own = struct.unpack_from(">5I", view, a + 4)
                defaults[track] = tuple(own)
            elif kind == b"trun" and holder is not None:
                holder.setdefault(kind, []).append((a, b))
            elif holder is not None:
                holder[kind] = (a, b)
        todo += reversed(inner)
    own = [_decoded(view, t) for t in found]
    by_id = {struct.unpack_from(">I", view, t[b"tkhd"][0] + (20 if view[t[b"tkhd"][0]] == 1 else 12))[0]: d for t, d in zip(found, own) if b"tkhd" in t}
    for start, traf in fragments:
        _append_fragment(view, start, traf, by_id, defaults)
    return own


def _append_fragment(view: memoryview, moof: int, traf: dict, by_id: dict[int, dict], defaults: dict[int, tuple[int, int, int]]) -> None:
    """Add the samples of a track fragment to its track; a fragment that does not say starts at its ``moof``."""
    at, end = traf[b"tfhd"]
    flags, number = struct.unpack_from(">II", view, at)
    flags, at = flags & 0xFFFFFF, at + 8
    track = by_id[number]
    base, (duration, size, marks) = moof, defaults.get(number, (0, 0, 0))
    if flags & 0x1:
        (base,), at = struct.unpack_from(">Q", view, at), at + 8
    at += 4 if flags & 0x2 else 0
    if flags & 0x8:
        (duration,), at = struct.unpack_from(">I", view, at), at + 4
    if flags & 0x10:
        (size,), at = struct.unpack_from(">I", view, at), at + 4
    if flags & 0x20:
        (marks,) = struct.unpack_from(">I", view, at)
    here = base
    for a, b in traf[b"trun"]:
        run, n = struct.unpack_from(">II", view, a)
        run, a = run & 0xFFFFFF, a + 8
        if run & 0x1:
            here, a = base + struct.unpack_from(">i", view, a)[0], a + 4
        first = None
        if run & 0x4:
            (first,), a = struct.unpack_from(">I", view, a), a + 4
        fields = [bit for bit in (0x100, 0x200, 0x400, 0x800) if run & bit]
        if 4 * n * len(fields) > b - a or (not run & 0x200 and n * max(size, 1) > len(view)):
            raise ValueError("a fragment has more samples than its box or the container can hold")
        table = np.frombuffer(view[a : a + 4 * n * len(fields)], ">u4").astype(np.int64).reshape(n, len(fields))
        column = lambda bit, other: table[:, fields.index(bit)] if bit in fields else np.full(n, other, np.int64)  # noqa: E731, B023
        sizes, times, flag = column(0x200, size), column(0x100, duration), column(0x400, marks).copy()
        if first is not None and n and not run & 0x400:
            flag[0] = first
        starts = here + np.cumsum(sizes) - sizes
        keys = track["samples"] + np.flatnonzero(flag & 0x10000 == 0)
        for name, more in (("starts", starts), ("sizes", sizes), ("times", times), ("keys", keys)):
            track[name] = np.concatenate([track[name], more])
        track["samples"] += n
        track["duration"] = max(track["duration"], int(track["times"].sum()))
        here += int(sizes.sum())


def _table(view: memoryview, at: tuple[int, int] | None, width: int, kind: str = ">u4") -> np.ndarray:
    if at is None:
        return np.zeros((0, width), np.int64)
    (n,) = struct.unpack_from(">I", view, at[0] + 4)
    size = n * width * np.dtype(kind).itemsize
    if at[0] + 8 + size > at[1]:
        raise ValueError("a sample table is longer than its box")
    return np.frombuffer(view[at[0] + 8 : at[0] + 8 + size], kind).astype(np.int64).reshape(n, width)


def _decoded(view: memoryview, t: dict) -> dict:
    a = t[b"mdhd"][0]
    timescale, duration = struct.unpack_from(">IQ", view, a + 20) if view[a] == 1 else struct.unpack_from(">II", view, a + 12)
    codec = bytes(view[t[b"stsd"][0] + 12 : t[b"stsd"][0] + 16]).decode("latin-1")
    handler = bytes(view[t[b"hdlr"][0] + 8 : t[b"hdlr"][0] + 12]).decode("latin-1")
    if b"stsz" in t:
        same, n = struct.unpack_from(">II", view, t[b"stsz"][0] + 4)
        if n * max(same, 1) > len(view) or (not same and 12 + 4 * n > t[b"stsz"][1] - t[b"stsz"][0]):
            raise ValueError("there are more samples than the container can hold")
        sizes = np.full(n, same, np.int64) if same else np.frombuffer(view[t[b"stsz"][0] + 12 : t[b"stsz"][0] + 12 + 4 * n], ">u4").astype(np.int64)
    else:
        field, n = struct.unpack_from(">II", view, t[b"stz2"][0] + 4)
        raw = np.frombuffer(view[t[b"stz2"][0] + 12 : t[b"stz2"][1]], {8: "u1", 16: ">u2", 4: "u1"}[field])
        sizes = (np.stack([raw >> 4, raw & 15], 1).reshape(-1) if field == 4 else raw)[:n].astype(np.int64)
    chunks = (_table(view, t[b"co64"], 1, ">u8") if b"co64" in t else _table(view, t.get(b"stco"), 1))[:, 0]
    runs = _table(view, t.get(b"stsc"), 3)
    per = np.zeros(len(chunks), np.int64)
    for i, (first, count, _) in enumerate(runs.tolist()):
        per[first - 1 : runs[i + 1, 0] - 1 if i + 1 < len(runs) else None] = count
    if per.sum() != n:
        raise ValueError("chunks and sample sizes disagree")
    before = np.cumsum(sizes) - sizes
    first_of = np.cumsum(per) - per
    starts = np.repeat(chunks - np.append(before, 0)[np.minimum(first_of, n)], per) + before
    stts = _table(view, t.get(b"stts"), 2)
    if stts[:, 0].sum() != n:
        raise ValueError("durations and sample sizes disagree")
    times = np.repeat(stts[:, 1], stts[:, 0])
    keys = _table(view, t[b"stss"], 1)[:, 0] - 1 if b"stss" in t else np.arange(n)
    if len(keys) and (keys.min() < 0 or keys.max() >= n):
        raise ValueError("a sync sample does not exist")
    return {"handler": handler, "codec": codec, "timescale": timescale, "duration": duration, "samples": n, "starts": starts, "sizes": sizes, "times": times, "keys": keys}


TRACKS = "`{id}` long, track int, handler string, codec string, timescale long, duration long, seconds double, n_samples long, n_keyframes long, keyframes array<struct<start: long, length: long>>, error string"


def probe(media: DataFrame, id_col: str, bytes_col: str) -> DataFrame:
    """One row for each track of each container: codec, duration and key-frame byte ranges.

    A null or unreadable container gives one row with track -1 and ``error``.
    """
    ddl = TRACKS.format(id=id_col)
    out_schema = common.arrow_schema(ddl)

    def rows(key: int, data: bytes | None) -> Iterator[tuple]:
        try:
            if data is None:
                raise ValueError("no container")
            for i, t in enumerate(tracks(data)):
                ranges = [{"start": int(t["starts"][k]), "length": int(t["sizes"][k])} for k in t["keys"]]
                yield key, i, t["handler"], t["codec"], t["timescale"], t["duration"], t["duration"] / t["timescale"] if t["timescale"] else None, t["samples"], len(ranges), ranges, None
        except (ValueError, KeyError, struct.error, IndexError, OverflowError, TypeError) as e:
            yield key, -1, None, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                made = [r for k, d in zip(batch.column(0).slice(i, 64).to_pylist(), batch.column(1).slice(i, 64).to_pylist()) for r in rows(k, d)]
                if made:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made), out_schema)], schema=out_schema)

    return common.named(media, id_col, bytes_col).mapInArrow(run, ddl)


def text_payload(text: bytes, sample: int = SAMPLE_BYTES) -> bytes:
    """The bytes followed by bytes 255 up to a positive multiple of the sample size."""
    return text + b"\xff" * ((sample - len(text) % sample) if len(text) % sample or not text else 0)


DIGEST = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, duration long, n_samples long, keyframes array<struct<start: long, length: long>>"


def store_texts(docs: DataFrame, with_media: bool = False) -> DataFrame:
    """Store every text as a container, read it back through its sample tables and describe it.

    Null text counts as empty; equal texts give equal rows apart from doc_id.  With ``with_media`` the
    container itself is a further binary column ``media``.
    """
    ddl = DIGEST + ", media binary" * with_media
    out_schema = common.arrow_schema(ddl)

    def row(key: int, text: bytes) -> tuple:
        media = mux(text_payload(text))
        (t,) = tracks(media)
        starts, sizes = t["starts"], t["sizes"]
        # Samples that lie side by side are read as one range.
        first = np.flatnonzero(np.append(True, starts[1:] != starts[:-1] + sizes[:-1]))
        last = np.append(first[1:], len(starts)) - 1
        read = b"".join(media[a:b] for a, b in zip(starts[first].tolist(), (starts + sizes)[last].tolist()))
        ranges = [{"start": int(a), "length": int(n)} for a, n in zip(starts[t["keys"]], sizes[t["keys"]])]
        feature = f"{t['handler']}/{t['codec'].strip()};{t['duration']}/{t['timescale']};samples={t['samples']};keys=" + ",".join(f"{x['start']}+{x['length']}" for x in ranges)
        return (key, len(text), len(read), hashlib.sha256(read).hexdigest(), zlib.crc32(read[-32:]), len(media), hashlib.sha256(media).hexdigest(), feature, t["codec"], t["duration"], t["samples"], ranges) + ((media,) if with_media else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = common.text_bytes(batch.column(1))
            for i, j in common.slices(offsets, 4 << 20):
                made = [row(k, data[a:b].tobytes()) for k, a, b in zip(batch.column(0).slice(i, j - i).to_pylist(), offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*made), out_schema)], schema=out_schema)

    return common.named(docs, "doc_id", "text").mapInArrow(run, ddl)
