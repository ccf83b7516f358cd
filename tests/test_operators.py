"""Operators on hand-made inputs with known answers."""

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import chapters as C
from quire.operators import corpus, layout, tables
from quire.plans import book
from quire.sources import readers
from quire.streaming import ingest


def value(spark, column, **given):
    row = spark.createDataFrame([tuple(given.values()) or (0,)], list(given) or ["x"])
    return row.select(column.alias("v")).first().v


def test_clean_text(spark):
    assert value(spark, T.clean_text(F.col("s")), s="speciﬁc soft­hyphen hyphen-\nated a,\nb\nc\x01 É-\né") == "specific softhyphen hyphenated a, b\nc Éé"


def test_chapter_numbers(spark):
    for title, n in (("Chapter 5 Stroke", 5), ("45 - Evaluation of X", 45), ("3. Spasticity", 3), ("CHAPTER FIVE", 5), ("12.3 Stroke", None), ("2019 Update", None), ("Chest Bellows", None), ("Chapter Twenty-one Falls", 21)):
        assert value(spark, T.chapter_number(F.col("s")), s=title) == n


def test_kinds(spark):
    for title, kind in (("Suggested Readings", "references"), ("12.4 References", "references"), ("Preface to Second Edition", "front"), ("Index", "back"), ("Chapter 2 Balance", "body")):
        assert value(spark, T.classify_kind(F.col("s")), s=title) == kind
        assert value(spark, T.classify_kind(F.col("s"), T.normalise), s=title) == kind


def test_doses(spark):
    for s, n in (("10 mg IV, 2-4 mg/kg, 0.5 mL, 30 mEq/L", 4), ("smgat program 5mg", 1), ("prose", 0)):
        assert value(spark, T.dose_count(F.col("s")), s=s) == n


def test_figure_ids(spark):
    for s, want in (("64-5", "64.5"), ("64–5", "64.5"), ("30 — 44", "30.44"), ("3-l2", "3.12")):
        assert value(spark, T.figure_id(F.col("s")), s=s) == want


def test_html(spark):
    assert value(spark, T.html_to_text(F.col("s")), s="<p>a&amp;b<script>x</script></p><table><tr><td>1</td><td>2</td></tr></table><!-- c -->") == "a&b\n\n1 | 2"


def test_state_walk(spark):
    rows = [(1, i, lv, t, None) for i, (lv, t) in enumerate([(1, "Preface"), (1, "Chapter 1 Gait"), (2, "Overview"), (1, "2019 Update"), (1, "Chapter 2 Balance")])]
    o = spark.createDataFrame(rows, "book int, ord int, level int, title string, page int")
    got = C.chapter_states(o, spark.createDataFrame([(1, 1)], "book int, level int")).orderBy("ord").collect()
    assert [r.chapter for r in got] == [None, 1, 1, None, 2]


def table(page, top, bottom, rows, edges=(40.0, 180.0, 340.0), above=False, below=False):
    return (1, page, 40.0, top, 545.0, bottom, 595.0, 842.0, above, below, list(edges), rows)


TABLE = "book int, page int, x0 double, top double, x1 double, bottom double, page_w double, page_h double, heading_above boolean, heading_below boolean, xedges array<double>, rows array<array<string>>"
HEAD, BODY = ["Test", "Mean", "SD"], [["a", "1", "2"], ["b", "3", "4"]]


def test_merge(spark):
    found = spark.createDataFrame([table(1, 690.0, 798.0, [HEAD, *BODY]), table(2, 90.0, 180.0, [HEAD, *BODY]), table(3, 90.0, 180.0, [HEAD, *BODY], above=True), table(5, 400.0, 500.0, [HEAD, *BODY])], TABLE)
    got = {r.page: (r.pages, r.md.count("Test")) for r in tables.merge_chains(found).collect()}
    assert got == {1: ([1, 2], 1), 3: ([3], 1), 5: ([5], 1)}


def test_merge_falls_apart_if_too_empty(spark):
    blank = [["", "", ""]] * 15
    found = spark.createDataFrame([table(1, 690.0, 798.0, [HEAD, *blank]), table(2, 90.0, 180.0, [["", "", ""], *blank, ["x", "", ""]])], TABLE)
    assert [r.page for r in tables.merge_chains(found).collect()] == [1]


def test_checks(spark):
    assert value(spark, tables.ragged_rows(F.col("r")), r=[["A", "B", "C"], ["1", "2", "3"], ["4", "", ""]]) == [2]
    assert value(spark, tables.empty_first_cells(F.col("r")), r=[["H1", "H2"], ["", "x"], ["", ""]]) == [1]
    assert value(spark, tables.run_together_cells(F.col("r")), r=[["acetabulumHip joint", "Hip joint", "self-report"]]) == 1
    assert value(spark, tables.missing_tokens(F.col("s"), F.col("c")), s="Titubation Present HDL-Cb elephant", c=["Present", "HDL-C b", "eleph"]) == ["elephant", "titubation"]


def test_columns(spark):
    boxes = [(1, 1, i, *b, 600.0) for i, b in enumerate([(320.0, 90.0, 560.0, 190.0), (50.0, 100.0, 290.0, 200.0), (50.0, 300.0, 290.0, 400.0), (320.0, 320.0, 560.0, 420.0)])]
    got = layout.column_order(spark.createDataFrame(boxes, "book int, page int, ord int, x0 double, y0 double, x1 double, y1 double, page_w double")).orderBy("pos").collect()
    assert [r.ord for r in got] == [1, 2, 0, 3] and got[0].two_columns


def test_files_without_faults(spark):
    rows = [(1, i, f"ch{i}.md", i or None, i * 10 + 1, i * 10 + 10, "body", True, True) for i in range(5)]
    schema = "book int, seq int, file string, chapter_number int, page_start int, page_end int, kind string, on_disk boolean, listed boolean"
    assert corpus.violations(spark.createDataFrame(rows, schema)).count() == 0
    assert {r.check for r in corpus.violations(spark.createDataFrame(rows[:2] + rows[3:], schema)).collect()} == {"page_gap", "chapter_gap"}


def test_convert(spark):
    pages = spark.createDataFrame([(1, 1, "See Fig. 1-2 and Fig. 1-2."), (1, 2, "x")], "book int, page int, text string")
    found = spark.createDataFrame([table(2, 300.0, 500.0, [HEAD, *BODY]), table(1, 0.0, 60.0, [HEAD, *BODY])], TABLE)
    documents, stats = book.convert(pages, found)
    s, text = stats.first(), documents.first().text
    assert (s.pages, s.fig_refs, s.tables, s.rejected_tables) == (2, 1, 1, 1)
    assert text.index("<!-- page 1 -->") < text.index("see PDF page 1") < text.index("<!-- page 2 -->") < text.index("| Test |")


def test_readers(spark, tmp_path):
    (tmp_path / "books" / "Gait").mkdir(parents=True)
    (tmp_path / "books" / "Gait" / "ch01.md").write_text("front\n<!-- page 3 -->\nbody\n<!-- page 4 -->\n\n")
    pages = readers.marked_pages(readers.markdown(spark, str(tmp_path / "books")))
    assert {(r.page, r.text.strip()) for r in pages.collect()} == {(0, "front"), (3, "body"), (4, "")}
    (tmp_path / "ocr.jsonl").write_text('{"image": "Gait/7.png", "blocks": [{"text": "a", "bbox": [5, 6, 1, 2]}, {"text": "b", "bbox": null}]}\nnot json\n')
    r = readers.ocr_lines(spark, str(tmp_path / "ocr.jsonl")).collect()
    assert [(x.book, x.page, x.x0, x.y1, x.text) for x in r] == [("Gait", 7, 1.0, 6.0, "a")]


def test_ingest(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "out", "progress"))
    for n in (1, 2):
        spark.createDataFrame([("Gait", n, "See Fig. 1-2")], ingest.PAGES).write.mode("append").parquet(source)
        ingest.ingest(spark, source, target, checkpoint).awaitTermination()
        assert spark.read.parquet(target).count() == n


def test_imports_stay_apart():
    """Nothing outside the training-data subpackage imports it."""
    from pathlib import Path

    root = Path(__file__).resolve().parent.parent / "quire"
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "quire.llm" in p.read_text()]
