"""Tables as arrays of rows of cells: cleaning, rendering, rejection of pseudo-tables, checks and continuation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire import constants as K
from quire.functions import text as T
from quire.options import Options


def clean_rows(rows: Column) -> Column:
    return F.transform(rows, lambda r: F.transform(r, lambda c: T.strip(F.replace(T.clean_text(F.coalesce(c, F.lit(""))), F.lit("\n"), F.lit(" ")))))


def filled(row: Column) -> Column:
    return F.filter(row, lambda c: ~T.is_blank(c))


def is_spanned_header(row: Column) -> Column:
    """One long string repeated in three or more cells and nothing else."""
    f = filled(row)
    return (F.size(f) >= K.HEADER_COLLAPSE_COLUMNS) & (F.size(F.array_distinct(f)) == 1) & (F.length(F.get(f, F.lit(0))) >= K.HEADER_COLLAPSE_LENGTH)


def collapse_headers(rows: Column) -> Column:
    """Spanned headers keep their text in the first cell only."""
    one = lambda r: F.transform(r, lambda c, i: F.when(i == 0, F.get(filled(r), F.lit(0))).otherwise(""))
    return F.transform(rows, lambda r: F.when(is_spanned_header(r), one(r)).otherwise(r))


def column_count(rows: Column) -> Column:
    return F.coalesce(F.array_max(F.transform(rows, F.size)), F.lit(0))


def content_share(rows: Column) -> tuple[Column, Column]:
    """Cells with content and all cells."""
    return F.size(F.flatten(F.transform(rows, filled))), F.size(F.flatten(rows))


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def render(rows: Column, options: Options = Options()) -> Column:
    """A pipe table, or null if the table is too small or too empty to keep."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def written(cleaned: Column) -> Column:
        kept, total = content_share(cleaned)

        def lines(width: Column) -> Column:
            out = F.transform(cleaned, lambda r: line(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r)))))
            return F.concat_ws("\n", F.slice(out, 1, 1), line(F.array_repeat(F.lit("---"), width)), F.slice(out, F.lit(2), F.greatest(F.size(out) - 1, F.lit(0))))

        return F.when((total > 0) & (kept / total >= K.CONTENT_MIN), _bound(column_count(cleaned), lines))

    cleaned = clean_rows(rows)
    return F.when(F.size(rows) >= 2, _bound(collapse_headers(cleaned) if options.header_collapse else cleaned, written))


def content_columns(rows: Column) -> Column:
    """How many column positions hold content in some row."""
    at = F.flatten(F.transform(rows, lambda r: F.filter(F.transform(r, lambda c, i: F.when(~T.is_blank(c), i)), lambda i: i.isNotNull())))
    return F.size(F.array_distinct(at))


def frame_reason(rows: Column, x0: Column, top: Column, x1: Column, bottom: Column, page_w: Column, page_h: Column, options: Options = Options()) -> Column:
    """Why a table is a page frame: at most one column (ruled or filled), and a huge cell or half the page."""
    if not options.frame_reject:
        return F.lit(None).cast("string")
    ruled = column_count(rows)
    held = content_columns(rows) if options.frame_content_columns else ruled
    shape = F.when(ruled <= K.FRAME_COLUMNS, "single column").otherwise(F.concat(F.lit("content in "), held.cast("string"), F.lit(" of "), ruled.cast("string"), F.lit(" columns")))
    longest = F.coalesce(F.array_max(F.transform(F.flatten(rows), lambda c: F.length(F.coalesce(c, F.lit(""))))), F.lit(0))
    covered = (x1 - x0) * (bottom - top) >= K.FRAME_AREA * page_w * page_h
    narrow = (F.size(rows) > 0) & ((ruled <= K.FRAME_COLUMNS) | (held <= K.FRAME_COLUMNS))
    return F.when(narrow & (longest > K.FRAME_CELL), F.concat(F.lit("page frame: "), shape, F.lit(", "), longest.cast("string"), F.lit("-char cell"))).when(
        narrow & (page_w > 0) & (page_h > 0) & covered, F.concat(F.lit("page frame: "), shape, F.lit(", bbox covers half the page or more"))
    )


def furniture_reason(rows: Column, top: Column, bottom: Column, page_h: Column, options: Options = Options()) -> Column:
    """Why a table is page furniture: it lies in the top or bottom tenth of the page."""
    if not options.furniture_reject:
        return F.lit(None).cast("string")
    there = (F.size(rows) > 0) & (page_h > 0)
    return F.when(there & (bottom <= K.FURNITURE_BAND * page_h), "running-header").when(there & (top >= page_h - K.FURNITURE_BAND * page_h), "running-footer")


def token_directions(rows: Column, page_text: Column) -> Column:
    """For each row the tokens of four letters or more found only as written, and found only reversed, in the page."""
    page = F.lower(page_text)
    count = lambda tokens, test: F.size(F.filter(tokens, test))

    def of(row: Column) -> Column:
        tokens = F.filter(F.regexp_extract_all(F.lower(F.array_join(row, " ")), F.lit("[a-z]{4,}"), F.lit(0)), lambda t: t != F.reverse(t))
        return F.struct(count(tokens, lambda t: page.contains(t) & ~page.contains(F.reverse(t))).alias("forward"), count(tokens, lambda t: ~page.contains(t) & page.contains(F.reverse(t))).alias("backward"))

    return F.transform(rows, of)


def is_reversed(directions: Column) -> Column:
    """A row, or the whole table, that reads backwards against the page."""
    bad = lambda f, b: (b >= K.REVERSED_TOKENS) & (b >= f * K.REVERSED_RATIO)
    total = lambda field: F.aggregate(directions, F.lit(0), lambda n, d: n + d[field])
    return F.exists(directions, lambda d: bad(d["forward"], d["backward"])) | bad(total("forward"), total("backward"))


def fake_table(rows: Column) -> Column:
    """single-column, mostly-empty or word-split for a block that is no table; null if it is one or is numbered as one."""
    width = column_count(rows)
    cells = F.flatten(rows)
    empty = F.size(F.filter(cells, lambda c: c == ""))
    pairs = F.transform(rows, lambda r: F.size(F.filter(F.transform(F.slice(r, F.lit(1), F.greatest(F.size(r) - 1, F.lit(0))), lambda c, i: c.rlike("[A-Za-z]$") & F.get(r, i + 1).rlike("^[a-z]")), lambda x: x)))
    splits = F.aggregate(pairs, F.lit(0), lambda n, x: n + x)
    numbered = F.array_join(F.get(rows, F.lit(0)), " ").rlike(K.TABLE_LABEL)
    share = empty / F.size(cells)
    split = (splits >= K.FRAGMENT_SPLITS) & (F.size(rows) <= K.FRAGMENT_ROWS) & (share >= K.FRAGMENT_EMPTY)
    return F.when((F.size(rows) == 0) | numbered, F.lit(None).cast("string")).when(width <= 1, "single-column").when(share > K.EMPTY_CELLS, "mostly-empty").when(split, "word-split")


def demote(rows: Column) -> Column:
    """The filled cells of a block as plain lines."""
    lines = F.filter(F.transform(rows, lambda r: F.trim(F.array_join(F.filter(r, lambda c: c != ""), " "))), lambda x: x != "")
    return F.when(F.size(lines) > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")


# Checks of structured tables.


def ragged_rows(rows: Column) -> Column:
    """Indexes of rows whose number of filled cells is not the commonest (the first seen, if several are)."""

    def other(counts: Column) -> Column:
        times = F.transform(F.array_distinct(counts), lambda n: F.struct(F.size(F.filter(counts, lambda m: m == n)).alias("times"), (-F.array_position(counts, n)).alias("first"), n.alias("n")))
        return _bound(F.array_max(times)["n"], lambda mode: F.filter(F.transform(counts, lambda n, i: F.when(n != mode, i)), lambda i: i.isNotNull()))

    return F.when(F.size(rows) >= 2, _bound(F.transform(rows, lambda r: F.size(filled(r))), other)).otherwise(F.array().cast("array<int>"))


def empty_first_cells(rows: Column, header: Column | None = None) -> Column:
    """Indexes of data rows without a label but with later values."""
    start = F.coalesce(header + 1, F.lit(1)) if header is not None else F.lit(1)
    bad = lambda r, i: (i >= start) & (F.size(r) > 0) & T.is_blank(F.coalesce(F.get(r, F.lit(0)), F.lit(""))) & (F.size(filled(r)) > 0)
    return F.filter(F.transform(rows, lambda r, i: F.when(bad(r, i), i)), lambda i: i.isNotNull())


def run_together_cells(rows: Column) -> Column:
    """How many cells join two words or a word and a bullet without a space."""
    return F.size(F.filter(F.flatten(rows), lambda c: c.rlike(K.RUN_TOGETHER)))


def multi_values(frame: DataFrame, key: str = "t", rows: str = "rows") -> DataFrame:
    """(key, hits): cells with several numeric tokens in a column where two or more cells hold just one."""
    cells = frame.select(key, F.posexplode(rows).alias("i", "r")).select(key, "i", F.posexplode("r").alias("j", "c")).where(T.strip(F.coalesce("c", F.lit(""))) != "")
    tokens = F.split(T.strip(F.col("c")), r"\s+")
    one = (F.size(tokens) == 1) & F.get(tokens, F.lit(0)).rlike(K.NUMERIC_TOKEN)
    several = F.size(F.filter(tokens, lambda t: F.regexp_replace(t, "^[,;]+|[,;]+$", "").rlike(K.NUMERIC_TOKEN))) > 1
    by = cells.groupBy(key, "j").agg(F.count_if(one).alias("single"), F.count_if(~one & several).alias("bad"))
    return by.where("single >= 2 and bad > 0").groupBy(key).agg(F.sum("bad").alias("hits"))


def multi_value_hits(rows: Column) -> Column:
    """As ``multi_values``, of one table: its rows are looked through once, without a row for each cell."""

    def kind(c: Column) -> Column:
        numeric = F.filter(F.split(c, r"\s+"), lambda t: F.regexp_replace(t, "^[,;]+|[,;]+$", "").rlike(K.NUMERIC_TOKEN))
        return F.when(c.rlike(K.NUMERIC_TOKEN), 1).when(c.rlike(r"\d") & (F.size(numeric) > 1), 2).otherwise(0)

    def hits(kinds: Column) -> Column:
        def of(j: Column) -> Column:
            column = F.transform(kinds, lambda r: F.get(r, j))
            return _bound(column, lambda k: F.when(F.size(F.filter(k, lambda x: x == 1)) >= 2, F.size(F.filter(k, lambda x: x == 2))).otherwise(0))

        return F.aggregate(F.transform(F.sequence(F.lit(0), F.greatest(column_count(kinds), F.lit(1)) - 1), of), F.lit(0).cast("long"), lambda n, x: n + x)

    return _bound(F.transform(rows, lambda r: F.transform(r, lambda c: _bound(T.strip(F.coalesce(c, F.lit(""))), kind))), hits)


def grid(cells: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row, col, text): every position a cell's span covers; a later cell (``ord``) overwrites an earlier one.

    ``cells`` has start_row, end_row, start_col, end_col (half open), ord, text, n_rows and n_cols.
    """
    span = lambda a, b, most: F.sequence(F.greatest(F.col(a), F.lit(0)), F.least(F.col(b), F.col(most)) - 1)
    inside = cells.where("least(end_row, n_rows) > greatest(start_row, 0) and least(end_col, n_cols) > greatest(start_col, 0)")
    covered = inside.select(*keys, "ord", "text", "start_col", "end_col", "n_cols", F.explode(span("start_row", "end_row", "n_rows")).alias("row"))
    covered = covered.select(*keys, "ord", "text", "row", F.explode(span("start_col", "end_col", "n_cols")).alias("col"))
    return covered.groupBy(*keys, "row", "col").agg(F.max_by("text", "ord").alias("text"))


def missing_tokens(source: Column, cells: Column) -> Column:
    """Tokens of the source text that no cell holds, without those glued from two neighbouring tokens of one cell."""
    tokens = lambda c: F.regexp_extract_all(F.lower(T.expand_ligatures(c, K.TABLE_LIGATURES)), F.lit("[a-z0-9]+"), F.lit(0))
    held = F.transform(cells, lambda c: tokens(F.coalesce(c, F.lit(""))))
    glued = F.flatten(F.transform(held, lambda t: F.when(F.size(t) > 1, F.transform(F.slice(t, F.lit(1), F.size(t) - 1), lambda x, i: F.concat(x, F.get(t, i + 1)))).otherwise(F.array().cast("array<string>"))))
    return F.array_sort(F.array_except(F.array_except(F.array_distinct(tokens(source)), F.flatten(held)), glued))


# Tables that run on over pages.


def edges_match(a: Column, b: Column, xa: Column, xb: Column, page_w: Column) -> Column:
    """Outer edges, and every edge of the shorter list, agree within a tolerance; the lists differ by one at most."""
    tol = page_w * K.MERGE_X
    near = lambda short, long: F.forall(short, lambda x: F.exists(long, lambda y: F.abs(x - y) <= tol))
    inner = F.when(F.size(xa) <= F.size(xb), near(xa, xb)).otherwise(near(xb, xa))
    outer = (F.abs(a["x0"] - b["x0"]) <= tol) & (F.abs(a["x1"] - b["x1"]) <= tol)
    return outer & (F.abs(F.size(xa) - F.size(xb)) <= 1) & inner


def continues(a: Column, b: Column, heading_veto: bool = True) -> Column:
    """Whether table ``b`` of the next page resumes ``a``: ends low, starts high, same columns and edges."""
    low = (a["page_h"] - a["bottom"]) <= K.MERGE_BOTTOM * a["page_h"]
    high = b["top"] <= K.MERGE_TOP * b["page_h"]
    same = (a["col_count"] > 0) & (a["col_count"] == b["col_count"])
    found = low & high & same & edges_match(a, b, a["xedges"], b["xedges"], a["page_w"])
    return found & ~a["heading_below"] & ~b["heading_above"] if heading_veto else found


def continuations(tables: DataFrame, heading_veto: bool = True) -> DataFrame:
    """Tables (one on a page: the last of it and the first) with ``resumes``: it continues that of the page before."""
    fields = ["page", "x0", "top", "x1", "bottom", "page_w", "page_h", "heading_above", "heading_below", "xedges", "col_count"]
    own = F.struct(*fields)
    w = Window.partitionBy("book").orderBy("page")
    before = F.lag(own).over(w)
    framed = tables.withColumn("col_count", column_count(F.col("rows"))).withColumn("own", own).withColumn("before", before)
    follows = F.col("before.page") == F.col("page") - 1
    return framed.withColumn("resumes", F.coalesce(follows & continues(F.col("before"), F.col("own"), heading_veto), F.lit(False))).drop("own", "before")


def merge_chains(tables: DataFrame) -> DataFrame:
    """(book, page, pages, md): each chain of continued tables once, on its first page, with repeated headers dropped.

    A chain whose merged table is too empty falls apart into its members.
    """
    marked = continuations(tables).withColumn("chain", F.sum(F.when(F.col("resumes"), 0).otherwise(1)).over(Window.partitionBy("book").orderBy("page")))
    head = F.get(F.first("rows").over(Window.partitionBy("book", "chain").orderBy("page")), F.lit(0))
    cleaned = lambda r: F.get(clean_rows(F.array(r)), F.lit(0))
    repeats = F.col("resumes") & (cleaned(F.get("rows", F.lit(0))) == cleaned(F.col("head"))) & F.exists(cleaned(F.col("head")), lambda c: c != "")
    tail = F.slice("rows", F.lit(2), F.greatest(F.size("rows") - 1, F.lit(0)))
    marked = marked.withColumn("head", head).withColumn("adds", F.when(repeats, tail).otherwise(F.col("rows")))
    parts = F.sort_array(F.collect_list(F.struct("page", "adds", "rows")))
    chains = marked.groupBy("book", "chain").agg(parts.alias("parts"))
    one = lambda page, pages, md: F.struct(page.alias("page"), pages.alias("pages"), md.alias("md"))
    alone = F.transform("parts", lambda p: one(p["page"], F.array(p["page"]), render(p["rows"])))
    whole = lambda md: F.when(md.isNull(), alone).otherwise(F.array(one(F.get("parts.page", F.lit(0)), F.col("parts.page"), md)))
    found = _bound(F.when(F.size("parts") > 1, render(F.flatten(F.col("parts.adds")))), whole)
    return chains.select("book", F.inline(found)).where("md is not null")


def review_reasons(table_text: Column, page_text: Column, stitched: Column, geometric: Column) -> Column:
    """Why a table needs a second look: it may continue another, or it holds doses."""
    caption = F.coalesce(stitched, F.lit(False)) | T.is_continued(page_text)
    first = F.when(caption, "continuation-page (orphan first row can be fused into the wrong label)").when(geometric, "continuation-page by geometry, no continuation caption (orphan first row can be fused into the wrong label)")
    second = F.when(T.dose_count(table_text) >= K.DOSE_MIN, "dosage/threshold values (a value on the wrong row = wrong clinical data)")
    return F.array_compact(F.array(first, second))
