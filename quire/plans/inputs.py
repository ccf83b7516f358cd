"""Derived relations over the given tables.

The tables hold almost nothing that operators on book pages look for, so pages, tables, outlines and
files are derived by expressions that read the same in Spark and in DuckDB.  Placement goes by integer
arithmetic on keys; there is no randomness.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a page gets in front of its text, by doc_id % 12; {k} and {m} are small numbers.
SNIPPETS = [
    "CHAPTER {k}\nThe speciﬁc eﬀect was re-\nported,\nas seen in Fig. {k}–{m}A and Figure {k}.{m}.\n",
    "TABLE {k}-{m} Drugs (continued)\nGive 10 mg IV, 2-4 mg/kg or 0.5 mL of it.\n",
    "{k} Hip and Groin Region\nsoft­hyphen and control\x01char\n",
    "{k} Postoperative Rehabilitation Guide\n",
    "Part {k}\nSee Box {k}-{m} and 圖 {k}–{m} and 表 {k}.{m}\n",
    "<!-- page {k} -->\n \n<!-- page {m} -->\nreal text\n",
    "SECTION {k} Balance\nNormal 30 mEq/L; cont’d\n",
    "Figure {k}-{m}. Gait (A) and (B).\nTable {k}.{m} of Figure {k}-{m}\n",
    "FIVE STEPS TO FALLS\n3.2 Something Else\n",
    "Chapter Twenty-{k}\nunits: 5 IU and 40 mmHg\n",
    "",
    "plain words,\nthen more\n",
]


def concat(template: str) -> str:
    """SQL that fills {k} and {m} from doc_id, readable by both engines."""
    parts = [p for p in re.split(r"(\{[km]\})", template) if p]
    of = {"{k}": "CAST(doc_id % 7 + 1 AS STRING)", "{m}": "CAST(doc_id % 5 + 1 AS STRING)"}
    return "concat(" + ", ".join(of.get(p, "'" + p + "'") for p in parts) + ")" if parts else "''"


PAGE_TEXT = "concat(CASE doc_id % 12 " + " ".join(f"WHEN {i} THEN {concat(s)}" for i, s in enumerate(SNIPPETS)) + " END, coalesce(text, ''))"
PAGE = f"CAST(floor(doc_id / 20) AS BIGINT) AS book, CAST(doc_id % 20 + 1 AS INT) AS page, {PAGE_TEXT} AS text"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page(book, page, text): each document is a page, twenty make a book."""
    return read(spark, sf_dir, "documents", "doc_id", "text").selectExpr(*split_select(PAGE))


def split_select(select: str) -> list[str]:
    """The expressions of a select list."""
    out, depth, start, quoted = [], 0, 0, False
    for i, c in enumerate(select):
        quoted ^= c == "'"
        if not quoted:
            depth += (c == "(") - (c == ")")
            if c == "," and not depth:
                out.append(select[start:i])
                start = i + 1
    return [x.strip() for x in [*out, select[start:]]]


# The three cells of a line, and the shape of its table by l_orderkey % 8.
CELLS = (
    "CASE WHEN l_orderkey % 8 = 2 AND l_linenumber % 3 = 0 THEN 'Corticosteroids reduce inflammation' WHEN l_orderkey % 8 = 3 THEN repeat('word ', 120) WHEN l_partkey % 11 = 0 THEN NULL WHEN l_partkey % 5 = 0 THEN '' ELSE concat('Item', CASE WHEN l_suppkey % 4 = 0 THEN 'Name ' ELSE ' name ' END, CAST(l_partkey % 9 AS STRING)) END AS c0",
    "CASE WHEN l_orderkey % 8 = 2 AND l_linenumber % 3 = 0 THEN 'Corticosteroids reduce inflammation' WHEN l_orderkey % 8 IN (3, 4) THEN '' WHEN l_suppkey % 6 = 0 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), ' ', CAST(l_linenumber AS STRING)) ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS c1",
    "CASE WHEN l_orderkey % 8 = 2 AND l_linenumber % 3 = 0 THEN 'Corticosteroids reduce inflammation' WHEN l_orderkey % 8 IN (3, 4) THEN NULL WHEN l_orderkey % 8 = 5 THEN concat(CAST(l_linenumber AS STRING), ' mg', chr(10), 'daily') ELSE concat(l_returnflag, l_linestatus) END AS c2",
)
ROW_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
# Where each table lies on its page of 595 x 842, by its number % 4.
GEOMETRY = (
    "CAST(floor(t / 40) AS BIGINT) AS book, CAST(t % 40 + 1 AS INT) AS page, "
    "CAST(CASE WHEN t % 3 = 0 THEN 50 ELSE 52 END AS DOUBLE) AS x0, CAST(CASE t % 4 WHEN 0 THEN 690 WHEN 1 THEN 90 WHEN 2 THEN 20 ELSE 100 END AS DOUBLE) AS top, "
    "CAST(CASE WHEN t % 5 = 0 THEN 400 ELSE 545 END AS DOUBLE) AS x1, CAST(CASE t % 4 WHEN 0 THEN 798 WHEN 1 THEN 180 WHEN 2 THEN 70 ELSE 780 END AS DOUBLE) AS bottom, "
    "CAST(595 AS DOUBLE) AS page_w, CAST(842 AS DOUBLE) AS page_h, CAST(CASE WHEN t % 7 = 0 THEN 1 ELSE 0 END AS BOOLEAN) AS heading_above, CAST(CASE WHEN t % 9 = 0 THEN 1 ELSE 0 END AS BOOLEAN) AS heading_below"
)


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table(book, page, x0, top, x1, bottom, page_w, page_h, heading flags, xedges, rows): one table for each order."""
    lines = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS t", *ROW_ORDER, *CELLS)
    cells = F.when(F.col("t") % 8 == 1, F.array("c0")).otherwise(F.array("c0", "c1", "c2"))
    key = [F.col(c) for c in ROW_ORDER]
    rows = F.transform(F.sort_array(F.collect_list(F.struct(*key, cells.alias("cells")))), lambda r: r["cells"])
    grouped = lines.groupBy("t").agg(rows.alias("rows"))
    edges = F.when(F.col("t") % 6 == 0, F.array(F.col("x0"), F.col("x0") + 150)).otherwise(F.array(F.col("x0"), F.col("x0") + 150, F.col("x0") + 300))
    return grouped.selectExpr(*split_select(GEOMETRY), "t", "rows").withColumn("xedges", edges)


TABLES_SQL = f"""
raw AS (SELECT l_orderkey AS t, {", ".join(ROW_ORDER)}, {", ".join(CELLS)} FROM lineitem),
grouped AS (SELECT t, list(CASE WHEN t % 8 = 1 THEN [c0] ELSE [c0, c1, c2] END ORDER BY {", ".join(ROW_ORDER)}) AS rows FROM raw GROUP BY t),
tables AS (SELECT {GEOMETRY}, t, rows FROM grouped),
tab AS (SELECT *, CASE WHEN t % 6 = 0 THEN [x0, x0 + 150] ELSE [x0, x0 + 150, x0 + 300] END AS xedges FROM tables),
r AS (SELECT t, CAST(i AS INT) AS i, rows[i + 1] AS cells FROM (SELECT t, rows, unnest(range(0, len(rows))) AS i FROM tab)),
c AS (SELECT t, i, CAST(j AS INT) AS j, cells[j + 1] AS raw FROM (SELECT t, i, cells, unnest(range(0, len(cells))) AS j FROM r))"""

# Outline titles by p_partkey % 10, books by p_size.
OUTLINE = (
    "CAST(p_size AS BIGINT) AS book, p_partkey AS ord, CAST(1 + p_partkey % 3 AS INT) AS level, CAST(p_partkey % 97 + 1 AS INT) AS page, "
    "CASE p_partkey % 10 WHEN 0 THEN 'References' WHEN 1 THEN 'Index' WHEN 2 THEN concat('Chapter ', CAST(floor(p_partkey / 50) + 1 AS INT), ' Gait') WHEN 3 THEN 'Preface to Second Edition' "
    "WHEN 4 THEN concat(CAST(floor(p_partkey / 50) + 1 AS INT), ' - Evaluation') WHEN 5 THEN '12.3 Stroke' WHEN 6 THEN 'CHAPTER FIVE' WHEN 7 THEN '2019 Update' WHEN 8 THEN '12.4 Suggested Readings' ELSE 'Chest Bellows' END AS title"
)


def outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """outline(book, ord, level, page, title)."""
    return read(spark, sf_dir, "part", "p_partkey", "p_size").selectExpr(*split_select(OUTLINE))


# Files of a book from supplier and customer keys.
FILES = (
    "CAST(floor(c_custkey / 12) AS BIGINT) AS book, CAST(c_custkey % 12 AS INT) AS seq, concat('ch', CAST(c_custkey % 12 AS STRING), '_', c_mktsegment, '.md') AS file, "
    "CAST(CASE WHEN c_custkey % 12 IN (0, 7) THEN NULL WHEN c_custkey % 31 = 0 THEN 1 ELSE c_custkey % 12 + CASE WHEN c_custkey % 12 > 8 THEN 1 ELSE 0 END END AS INT) AS chapter_number, "
    "CAST((c_custkey % 12) * 10 + 1 AS INT) AS page_start, CAST((c_custkey % 12) * 10 + CASE WHEN c_nationkey % 5 = 0 THEN 11 WHEN c_nationkey % 5 = 1 THEN 8 ELSE 10 END AS INT) AS page_end, "
    "CASE WHEN c_custkey % 12 = 0 THEN 'front' WHEN c_nationkey % 13 = 0 THEN 'odd' ELSE 'body' END AS kind, CAST(CASE WHEN c_nationkey % 11 = 0 THEN 0 ELSE 1 END AS BOOLEAN) AS on_disk, CAST(CASE WHEN c_nationkey % 17 = 0 THEN 0 ELSE 1 END AS BOOLEAN) AS listed"
)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file(book, seq, file, chapter_number, page_start, page_end, kind, on_disk, listed)."""
    return read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_mktsegment").selectExpr(*split_select(FILES))
