"""Steps that would grow faster than their tables, seen from plans and counts on small ones."""

import difflib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.operators import layout as L
from quire.operators import sequential as S


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_words_of_a_page_are_looked_up_once(monkeypatch):
    """of the same line many times, each odd word is spelled out once, and a word longer than any of the page never."""
    seen, own = [], S.spellings
    monkeypatch.setattr(S, "spellings", lambda word: seen.append(word) or own(word))
    rows = pa.array([[["lexion of the ofice"]] * 50 + [["t" * 3000]]], pa.list_(pa.list_(pa.string())))
    (got,) = S.repair_ligatures.func(rows, pa.array(["flexion of the office"])).to_pylist()
    assert got["rows"] == [["flexion of the office"]] * 50 + [["t" * 3000]] and got["suspects"] == ["t" * 3000]
    assert len(got["repairs"]) == 100 and sorted(seen) == ["lexion", "ofice", "t" * 3000]


@pytest.fixture
def book(spark):
    lines = spark.createDataFrame([(1, i, 1, t) for i, t in enumerate(["Overview", "1.2 Overview", "Overview " + "and more " * 99, "x"] * 5)], "book long, line_no long, page int, text string")
    return lines, spark.createDataFrame([(1, i, 3, "Overview", 1) for i in range(40)], "book long, ord long, level int, title string, page int")


def test_equal_lines_meet_equal_titles_once(book):
    """lines of a page with one key are one row before they meet the entries; keys come before lines are dealt out."""
    got = S.deep_headings(*book)
    assert {(r.line_no, r.heading) for r in got.collect()} == {(0, "## Overview")} and got.count() == 40
    plan = optimized(got)
    assert "Aggregate [book#" in plan[plan.index("Join Inner") :] and "min(line_no#" in plan[plan.index("Join Inner") :]


def test_lines_are_keyed_once(book):
    """keys of lines and of titles are made once each, for both uses of the matches."""
    assert optimized(S.anchor_titles(book[1], book[0])).count("ArrowEvalPython") == 2
    assert {(r.ord, r.line_no) for r in S.anchor_titles(book[1].where("ord < 2").withColumn("level", F.lit(1)), book[0]).collect()} == {(0, 0), (1, 1)}


def test_titles_take_one_pass_of_python(spark):
    """whole texts go to one Python step, not to one that normalises and one that compares."""
    files = spark.createDataFrame([(1, "a", "Gait", "GAIT")], "book int, file string, title string, text string")
    assert optimized(S.check_titles(files)).count("EvalPython") == 1
    words = ["spasticty", "managment", "balance", "", "abcde"]
    assert [S._alike(w, words[:3]) for w in words] == [bool(difflib.get_close_matches(w, words[:3], 1, S.WORD_ALIKE)) for w in words]


def boxes(spark):
    rows = [(b, p, i, 50.0 + (i % 2) * 260 + (i * p) % 7 * 10, 280.0 + (i % 2) * 250 + i % 3, float(i * 7 % 11), (i + b) % 5) for b in range(6) for p in range(4) for i in range(b * 5 + p)]
    return spark.createDataFrame([(*r, 595.0) for r in rows] + [(1, 1, 90, None, 400.0, 3.0, 1, 595.0), (2, 1, 91, 60.0, None, None, None, 595.0), (3, None, 1, 1.0, 2.0, 3.0, 4, 595.0)], "book long, page int, ord long, x0 double, x1 double, base double, n_chars long, page_w double")


def test_gutters_without_a_row_for_each_step(spark):
    """no box is copied for the steps over the width; against loops."""
    got = L.ocr_gutter(boxes(spark))
    assert "Generate" not in optimized(got) and "Join" not in optimized(got)
    pages = {}
    for r in boxes(spark).where("page is not null").collect():
        pages.setdefault((r.book, r.page), []).append(r)
    want = {}
    for key, rows in pages.items():
        tried = []
        for x in [595 * 0.25 + 595 * 0.0025 * i for i in range(201)]:
            cross = [r for r in rows if r.x0 is not None and r.x1 is not None and r.x0 < x < r.x1]
            sides = sum(r.n_chars or 0 for r in rows if r.x1 is not None and r.x1 <= x), sum(r.n_chars or 0 for r in rows if r.x0 is not None and r.x0 >= x)
            tried.append((sum(r.x1 - r.x0 < 595 * 0.30 for r in cross), -min(sides)) if x <= 595 * 0.75 and len(cross) <= len(rows) * 0.15 else None)
        if len(rows) < 4 or not any(tried):
            continue
        best, runs = min(t for t in tried if t), []
        for i, t in enumerate(tried):
            if t == best:
                runs = [*runs[:-1], (*runs[-1][:1], i)] if runs and runs[-1][1] == i - 1 else [*runs, (i, i)]
        middles = [(595 * 0.25 + 595 * 0.0025 * a + 595 * 0.25 + 595 * 0.0025 * b) / 2 for a, b in runs]
        g = min(middles, key=lambda m: abs(m - 297.5))
        if sum(r.x1 is not None and r.x1 <= g for r in rows) >= 2 and sum(r.x0 is not None and r.x0 >= g for r in rows) >= 2:
            want[key] = round(g, 9)
    assert {(r.book, r.page): round(r.gutter, 9) for r in got.collect()} == want and len(want) > 5


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_pairs_without_a_join(spark, batch):
    """F8: lines are dealt once and not copied to neighbouring cells; pages may be cut by batches."""
    lines = boxes(spark).selectExpr("book", "page", "ord * 3 AS ord", "CASE WHEN ord % 2 = 0 THEN 50 ELSE 110 + ord % 3 END AS x0", "CASE WHEN ord % 2 = 0 THEN 100 ELSE 300 END AS x1", "floor(ord / 2) * 1.5 + ord % 2 AS base", "ord % 2 = 0 AS bold_all", "ord % 2 = 0 AS bold_start", "ord % 11 > 0 AS upright", "page_w")
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(key, batch)
    try:
        got = L.runin_pairs(lines)
        assert "Join" not in optimized(got)
        found = {(r.book, r.page, r.term, r.definition) for r in got.collect()}
    finally:
        spark.conf.set(key, before)
    want, pages = set(), {}
    for r in lines.where("page is not null and ord is not null").collect():
        pages.setdefault((r.book, r.page), []).append(r)
    for key, rows in pages.items():
        right = [(a, b) for a in rows for b in rows if a.base is not None and b.base is not None and a.ord != b.ord and abs(a.base - b.base) <= 1.5 and -1 <= b.x0 - a.x1 <= a.page_w * 0.04]
        near = {}
        for a, b in right:
            if a.bold_all and not b.bold_start and a.upright and b.upright:
                near[a.ord] = min(near.get(a.ord, (1e9, 0)), (b.x0 - a.x1, b.ord))
        near = {a: d for a, (_, d) in near.items() if d not in {x.ord for x, _ in right}}
        single = {(a, d) for a, d in near.items() if list(near.values()).count(d) == 1 and d != a + 1}
        want |= {(*key, a, d) for a, d in single} if len(single) >= 3 else set()
    assert found == want and want


def test_checks_without_rows_for_cells(spark):
    """the checks of a table need no second pass over its cells, and agree with the rows for each cell."""
    from quire.operators import tables as B

    rows = [(1, [["a", "1", "1 2"], ["b", "2", "3, 4"], ["", "3 4", None], ["c", "5% 6", "7"], [" ", "x 1 2", "8"]]), (2, []), (3, [["1 2"], ["3"]]), (4, [[], ["1", "2"], ["3 4", "5"], ["6", "7 8 9"]])]
    t = spark.createDataFrame(rows, "t int, rows array<array<string>>")
    want = {r.t: r.hits for r in B.multi_values(t).collect()}
    got = t.select("t", B.multi_value_hits(F.col("rows")).alias("hits"), B.ragged_rows(F.col("rows")).alias("ragged"))
    assert {r.t: r.hits for r in got.collect()} == {k: want.get(k, 0) for k in (1, 2, 3, 4)} and want
    assert {r.t: r.ragged for r in got.collect()} == {1: [2, 4], 2: [], 3: [], 4: [0]}
    assert "Generate" not in optimized(got)


def test_books_are_made_in_one_pass(spark, tmp_path):
    """documents and figures of a book come from one pass over pages and tables."""
    from quire.plans import corpus_queries as P

    data = "/root/testdata/sf0.001"
    pages, tables = P.I.pages(spark, data), P.I.tables(spark, data).selectExpr("*")
    assert optimized(P.P.converted(pages, tables)).count("Relation [") == 2
    assert optimized(P.book_documents(spark, data)).count("Relation [") == 2


def test_equal_notes_are_scanned_once(spark):
    """a text that notes share is scanned once, before its references go to the notes."""
    from quire.operators import citations as Q

    notes = spark.createDataFrame([(1, "as in Gait 2e Ch.3 and `Spasm Chapter 4` so\nsee Falls Ch5"), (2, None), (3, "none"), (4, "as in Gait 2e Ch.3 and `Spasm Chapter 4` so\nsee Falls Ch5"), (4, "Gait Ch 1")], "note int, text string")
    got = Q.scan_references(notes)
    assert sorted(((r.note, r.line, r.ord, r.names[0], r.chapter, r.edition) for r in got.collect()), key=repr) == sorted([(n, *x) for n in (1, 4) for x in ((0, 0, "Gait", 3, "2e"), (0, 1, "Spasm", 4, None), (1, 0, "Falls", 5, None))] + [(4, 0, 0, "Gait", 1, None)], key=repr)
    plan = optimized(got)
    assert "Join Inner, (text#" in plan and plan.index("Join Inner") < plan.index("Generate") < plan.index("Aggregate [text#")
