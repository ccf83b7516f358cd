"""Reading order of positioned boxes and figures on a page."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire import constants as K

PAGE = ["book", "page"]
PAIRS_AT_ONCE, PAGES_AT_ONCE = 1 << 20, 512


def _by_page(rows: DataFrame, order: str, least: int, out: list[str], found: Callable[[np.ndarray, dict[str, pa.Array]], tuple[np.ndarray, dict[str, np.ndarray]]]) -> DataFrame:
    """(book, page, further columns of ``out``) from pages of ``least`` rows or more, many whole pages at a time.

    Rows are dealt by page once and come in the order of ``order``; rows of a page that a batch cuts wait for
    the next.  ``found`` gets the first row of every page (and the end) and the columns, and gives the page of
    each result and its columns.
    """
    sized = rows.where("book is not null and page is not null").withColumn("_n", F.count("*").over(Window.partitionBy(*PAGE).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).where(F.col("_n") >= least)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join([f"{c} {kinds[c]}" for c in PAGE] + out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        missing = 0  # rows of the cut page that are still to come
        for batch in batches:
            n = batch["_n"].to_numpy(zero_copy_only=False)
            at = min(missing, len(n))
            missing -= at
            if missing == 0:
                if at and waiting:
                    waiting.append(batch.slice(0, at))
                    yield from whole(waiting)
                    waiting, batch, n = [], batch.slice(at), n[at:]
                end = 0
                while end < len(n) and end + n[end] <= len(n):
                    end += int(n[end])
                if end:
                    yield from whole([batch.slice(0, end)])
                if end < len(n):
                    waiting, missing = [batch.slice(end)], int(n[end]) - (len(n) - end)
            else:
                waiting.append(batch)

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        columns = {c: table[c].combine_chunks() if isinstance(table[c], pa.ChunkedArray) else table[c] for c in table.column_names}
        n, starts = columns["_n"].to_numpy(zero_copy_only=False), [0]
        while starts[-1] < len(n):
            starts.append(starts[-1] + int(n[starts[-1]]))
        first = np.array(starts)
        of, made = found(first, columns)
        if len(of):
            where = pa.array(first[:-1][of])
            yield pa.RecordBatch.from_arrays([columns[c].take(where) for c in PAGE] + [pa.array(x) for x in made.values()], names=PAGE + list(made))

    return sized.mapInArrow(run, schema)


def _floats(x: pa.Array) -> np.ndarray:
    """As doubles; NaN for null."""
    return x.cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)


def column_order(boxes: DataFrame, least: int = 4) -> DataFrame:
    """Boxes (book, page, ord, x0, y0, x1, y1, page_w) with ``pos``: two-column order where a page has one, else ``(y0, x0)``.

    ``two_columns`` tells which.  A page has two columns if both sides hold two boxes or more and none
    crosses the middle; full-width boxes part the page into bands.
    """
    middle, tol = F.col("page_w") / 2, F.col("page_w") * K.COLUMN_TOLERANCE
    side = F.when((F.col("x0") < middle - tol) & (F.col("x1") > middle + tol), "full").when((F.col("x0") + F.col("x1")) / 2 < middle, "left").otherwise("right")
    b = boxes.withColumn("side", side)
    left, right = F.col("side") == "left", F.col("side") == "right"
    fits = b.groupBy(*PAGE).agg(
        (
            (F.count("*") >= least)
            & (F.count_if(left) >= K.COLUMN_LINES)
            & (F.count_if(right) >= K.COLUMN_LINES)
            & F.coalesce(F.max(F.when(left & (F.col("x1") > middle + tol), 1).otherwise(0)) == 0, F.lit(True))
            & F.coalesce(F.max(F.when(right & (F.col("x0") < middle - tol), 1).otherwise(0)) == 0, F.lit(True))
        ).alias("two_columns")
    )
    # The band of a box: full-width boxes that start at or above it; a full-width box follows the band it closes.
    upto = Window.partitionBy(*PAGE).orderBy("y0").rangeBetween(Window.unboundedPreceding, 0)
    full = (F.col("side") == "full").cast("int")
    b = b.withColumn("seen", F.sum(full).over(upto))
    at = Window.partitionBy(*PAGE, "side").orderBy("y0", "ord")
    b = b.withColumn("band", F.when(F.col("side") == "full", F.row_number().over(at) - 1).otherwise(F.col("seen")))
    rank = F.when(left, 0).when(right, 1).otherwise(2)
    joined = b.join(fits, PAGE).withColumn("rank", rank)
    two = F.row_number().over(Window.partitionBy(*PAGE).orderBy("band", "rank", "y0", "ord"))
    plain = F.row_number().over(Window.partitionBy(*PAGE).orderBy("y0", "x0", "ord"))
    return joined.withColumn("pos", F.when(F.col("two_columns"), two).otherwise(plain)).drop("seen", "band", "rank", "side")


def runin_pairs(lines: DataFrame, tolerance: float = 1.5, gap: float = 0.04, least: int = 3) -> DataFrame:
    """(book, page, term, definition): glossary terms rejoined with definitions that stand apart in the stream.

    ``lines``: book, page, ord, x0, x1, base, bold_all, bold_start, upright, page_w.  A term is all bold, its
    definition does not start bold and begins just right of it on the same baseline; a definition with a
    further cell to its right, or with two terms, is left alone, and so are pages with fewer than ``least``
    pairs out of order.
    """
    needed = ["ord", "x0", "x1", "base", "bold_all", "bold_start", "upright", "page_w"]
    given = lines.select(*PAGE, F.col("ord").cast("long").alias("ord"), *[F.col(c).cast("double").alias(c) for c in ("x0", "x1", "base", "page_w")], *needed[4:7]).where("ord is not null and abs(base) < double('Infinity')")

    def found(first: np.ndarray, columns: dict[str, pa.Array]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        n = int(first[-1])
        page = np.repeat(np.arange(len(first) - 1), np.diff(first))
        ord_ = columns["ord"].to_numpy(zero_copy_only=False)
        x0, x1, base, wide = (_floats(columns[c]) for c in ("x0", "x1", "base", "page_w"))
        bold, starts_bold, upright = (columns[c].fill_null(missing).to_numpy(zero_copy_only=False).astype(bool) for c, missing in (("bold_all", False), ("bold_start", True), ("upright", False)))
        # Neighbours on a baseline are a range of rows: those of the page with a base within the tolerance.
        low, high = np.empty(n, np.int64), np.empty(n, np.int64)
        for a, b in zip(first[:-1], first[1:]):
            slack = tolerance + 1e-9 * (1 + np.abs(base[a:b]).max())
            low[a:b], high[a:b] = a + np.searchsorted(base[a:b], base[a:b] - slack, "left"), a + np.searchsorted(base[a:b], base[a:b] + slack, "right")
        followed, nearest = np.zeros(n, bool), np.full(n, -1, np.int64)
        ends = np.cumsum(high - low)
        a = 0
        while a < n:  # rows whose neighbours fit in a slice, one at least
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PAIRS_AT_ONCE, "right")))
            size = high[a:b] - low[a:b]
            term = np.repeat(np.arange(a, b), size)
            other = np.arange(len(term)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[a:b], size)
            apart = x0[other] - x1[term]
            near = (ord_[term] != ord_[other]) & (np.abs(base[term] - base[other]) <= tolerance) & (apart >= -1.0) & (apart <= wide[term] * gap)
            followed[term[near]] = True
            fit = near & bold[term] & ~starts_bold[other] & upright[term] & upright[other]
            t, d, x = term[fit], other[fit], apart[fit]
            by = np.lexsort((ord_[d], x, t))
            t, d = t[by], d[by]
            once = np.ones(len(t), bool)
            once[1:] = t[1:] != t[:-1]
            nearest[t[once]] = d[once]
            a = b
        term = np.flatnonzero(nearest >= 0)
        term = term[~followed[nearest[term]]]
        term = term[np.bincount(nearest[term], minlength=n)[nearest[term]] == 1]
        term = term[ord_[nearest[term]] != ord_[term] + 1]
        enough = np.bincount(page[term], minlength=len(first)) >= least
        term = term[enough[page[term]]]
        return page[term], {"term": ord_[term], "definition": ord_[nearest[term]]}

    return _by_page(given, "base", 2, ["term long", "definition long"], found)


def ocr_gutter(boxes: DataFrame, least: int = 4) -> DataFrame:
    """(book, page, gutter): the strip between 25 % and 75 % of the width that parts the boxes best; none if every strip cuts too many.

    ``boxes``: book, page, x0, x1, n_chars, page_w.
    """
    given = boxes.select(*PAGE, *[F.col(c).cast("double").alias(c) for c in ("x0", "x1", "page_w")], F.col("n_chars").cast("long").alias("n_chars"))

    def found(first: np.ndarray, columns: dict[str, pa.Array]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        x0, x1, page_w = (_floats(columns[c]) for c in ("x0", "x1", "page_w"))
        some0, some1 = (columns[c].is_valid().to_numpy(zero_copy_only=False) for c in ("x0", "x1"))
        chars = columns["n_chars"].fill_null(0).to_numpy(zero_copy_only=False)
        n, of, gutters = np.diff(first), [], []
        width = page_w[first[:-1]]
        for w in np.unique(width[~np.isnan(width)]):
            x = w * 0.25 + w * 0.0025 * np.arange(201)
            x = x[x <= w * 0.75]
            same = np.flatnonzero(width == w)
            for pages in np.split(same, np.arange(PAGES_AT_ONCE, len(same), PAGES_AT_ONCE)) if len(x) else ():
                # The boxes of these pages, and the place of each one's page among them.
                size = n[pages]
                box = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - first[:-1][pages], size)
                at, a, b, c, has_a, has_b = np.repeat(np.arange(len(pages)), size), x0[box], x1[box], chars[box], some0[box], some1[box]
                # Steps that a box crosses or leaves to one side are ranges; sums over boxes are running sums of their ends.
                starts, stops = np.searchsorted(x, a, "right"), np.searchsorted(x, b, "left")
                upto = lambda place, who, weight: _running(at[who], place[who], weight[who], len(pages), len(x))  # noqa: B023, E731
                over = lambda who: upto(starts, who, np.ones_like(c)) - upto(stops, who, np.ones_like(c))  # noqa: B023, E731
                crosses = has_a & has_b & (starts < stops)
                right = _running(at[has_a], np.zeros_like(at[has_a]), c[has_a], len(pages), len(x)) - upto(starts, has_a, c)
                narrow, lighter = over(crosses & (b - a < w * 0.30)), np.minimum(upto(stops, has_b, c), right)
                top = over(crosses) <= size[:, None] * 0.15
                top &= narrow == np.where(top, narrow, np.iinfo(np.int64).max).min(axis=1, keepdims=True)
                top &= lighter == np.where(top, lighter, np.iinfo(np.int64).min).max(axis=1, keepdims=True)
                # Runs of steps that are equally good; the one with its middle nearest to the page's, the left one of two.
                edge = np.diff(np.pad(top, ((0, 0), (1, 1))).astype(np.int8), axis=1)
                (row, begin), (_, end) = np.nonzero(edge == 1), np.nonzero(edge == -1)
                middle = (x[begin] + x[end - 1]) / 2
                by = np.lexsort((begin, np.abs(middle - w / 2), row))
                by = by[np.diff(row[by], prepend=-1) > 0]
                gutter = np.full(len(pages), np.nan)
                gutter[row[by]] = middle[by]
                sides = [np.bincount(at[who], minlength=len(pages)) for who in (has_b & (b <= gutter[at]), has_a & (a >= gutter[at]))]
                good = np.flatnonzero((sides[0] >= K.COLUMN_LINES) & (sides[1] >= K.COLUMN_LINES))
                of.append(pages[good])
                gutters.append(gutter[good])
        return np.concatenate([np.zeros(0, np.int64), *of]), {"gutter": np.concatenate([np.zeros(0), *gutters])}

    return _by_page(given, "x0", least, ["gutter double"], found)


def _running(row: np.ndarray, place: np.ndarray, weight: np.ndarray, rows: int, places: int) -> np.ndarray:
    """For each row, at each place, the sum of the weights up to there."""
    out = np.zeros((rows, places + 1), np.int64)
    np.add.at(out, (row, place), weight)
    return np.cumsum(out, axis=1)[:, :-1]


def is_decoration(x0: Column, y0: Column, x1: Column, y1: Column, page_w: Column, page_h: Column) -> Column:
    """A thin band over the page's width at its top or bottom edge."""
    return (y1 - y0 > 0) & (y1 - y0 < 60) & (x1 - x0 >= 0.9 * page_w) & ((y1 < 50) | (y0 < 0) | (y0 > page_h - 50))


def backends(pages: DataFrame) -> DataFrame:
    """(book, page, backend, confidence) from full_page, rasters (others), text_blocks and fonts of each page."""
    full, n = F.col("full_page"), F.col("rasters")
    chosen = F.when(full & (n > 0), F.struct(F.lit("caption_anchor").alias("backend"), F.lit(0.92).alias("confidence")))
    chosen = chosen.when((n >= 2) & ~full, F.struct(F.lit("geometric").alias("backend"), F.lit(0.95).alias("confidence")))
    chosen = chosen.when((F.col("text_blocks") >= 10) & (F.col("fonts") > 0) & ~full, F.struct(F.lit("geometric").alias("backend"), F.lit(0.75).alias("confidence")))
    chosen = chosen.otherwise(F.struct(F.lit("caption_anchor").alias("backend"), F.lit(0.9).alias("confidence")))
    return pages.select(*PAGE, chosen.alias("c")).select(*PAGE, "c.*")


def caption_owners(images: DataFrame, captions: DataFrame, tolerance: float = 30.0) -> DataFrame:
    """(book, page, image, caption, direction): each image with its nearest caption, all above or all below.

    The direction that gives more captions an image wins, then the smaller sum of distances, then above.
    ``images``: book, page, image, y0, y1; ``captions``: book, page, caption, top, bottom.
    """
    both = images.join(captions, PAGE)
    above = both.where(F.col("top") <= F.col("y0") + tolerance).select(*PAGE, "image", "caption", F.abs(F.col("y0") - F.col("top")).alias("d"), F.lit("above").alias("direction"))
    below = both.where(F.col("bottom") >= F.col("y1") - tolerance).select(*PAGE, "image", "caption", F.abs(F.col("bottom") - F.col("y1")).alias("d"), F.lit("below").alias("direction"))
    near = above.unionByName(below).groupBy(*PAGE, "direction", "image").agg(F.min(F.struct("d", "caption")).alias("m"))
    score = near.groupBy(*PAGE, "direction").agg(F.countDistinct("m.caption").alias("owners"), F.sum("m.d").alias("gap"))
    best = score.groupBy(*PAGE).agg(F.min_by("direction", F.struct(-F.col("owners"), "gap", "direction")).alias("direction"))
    return near.join(best, [*PAGE, "direction"]).select(*PAGE, "image", "m.caption", "direction")


def id_gaps(figures: DataFrame) -> DataFrame:
    """(book, gaps, expected): missing numbers between the first and last figure of each chapter.  ``figures``: book, chapter, number."""
    by = figures.groupBy("book", "chapter").agg(F.countDistinct("number").alias("n"), (F.max("number") - F.min("number") + 1).alias("span"))
    return by.groupBy("book").agg(F.sum(F.col("span") - F.col("n")).alias("gaps"), F.sum("span").alias("expected"))


def book_verdict(m: dict[str, Column]) -> Column:
    """red, yellow or green from captions, dump_all, ref_ratio, pdf_coverage, page_coverage, image_pages, fig_to_table, no_image and gap_ratio."""
    low = lambda c: F.coalesce(c, F.lit(False))
    many = m["image_pages"] > 30
    red = (m["captions"] == 0) | (m["dump_all"] >= 0.5) | low(m["ref_ratio"] < 0.50) | low(m["pdf_coverage"] < 0.40) | low((m["page_coverage"] < 0.35) & many) | low((m["fig_to_table"] < 0.20) & many) | ((m["captions"] < 5) & many) | (m["no_image"] > 0.25)
    yellow = low(m["ref_ratio"] < 0.80) | low(m["pdf_coverage"] < 0.70) | low((m["page_coverage"] < 0.60) & many) | (m["no_image"] > 0.10) | (m["gap_ratio"] > 0.10)
    return F.when(red, "red").when(yellow, "yellow").otherwise("green")
