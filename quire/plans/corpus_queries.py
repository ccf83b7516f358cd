"""Registered queries over files, books, citations and page layout, with their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import chapters as C
from quire.operators import citations as Q
from quire.operators import corpus as B
from quire.operators import layout as L
from quire.operators import sequential as S
from quire.plans import book as P
from quire.plans import inputs as I
from quire.plans.inputs import FILES, PAGE

# Derived relations in SQL that both engines read.
NAMES = (
    "CAST(floor(c_custkey / 12) AS BIGINT) AS g, concat(CASE floor(c_custkey / 12) % 3 WHEN 0 THEN 'Gait' WHEN 1 THEN 'Spasm' ELSE 'Gait' END, '_', CAST(CAST(floor(c_custkey / 12) % 4 + 1 AS INT) AS STRING), 'e_', CAST(CAST(floor(c_custkey / 12) AS INT) AS STRING)) AS folder, "
    "CASE CAST(floor(c_custkey / 12) AS INT) % 7 WHEN 0 THEN concat('0', CAST(c_custkey % 3 AS STRING), '_', CAST(c_custkey % 12 + 1 AS STRING), '_', c_mktsegment, '.md') WHEN 1 THEN concat('ch', CAST(c_custkey % 12 + 10 AS STRING), '_', CAST(c_custkey % 12 + 1 AS STRING), '_', c_mktsegment, '.md') "
    "WHEN 2 THEN concat('ch', CAST(c_custkey % 12 + 10 AS STRING), CASE WHEN c_custkey % 12 < 6 THEN concat('_Chapter', CAST(c_custkey % 12 + 1 AS STRING)) ELSE concat('_', c_mktsegment) END, '.md') WHEN 3 THEN concat('Ch', CAST(c_custkey % 12 + 1 AS STRING), '_', c_mktsegment, '.md') "
    "WHEN 4 THEN concat(CAST(c_custkey % 12 + 1 AS STRING), '.', c_mktsegment, '.md') WHEN 5 THEN concat('ch', CAST(c_custkey % 12 AS STRING), '_', c_mktsegment, '.md') ELSE concat('pages_', CAST(c_custkey % 12 AS STRING), '.md') END AS name"
)
NOTES = (
    "o_orderkey AS note, concat('as in Gait ', CAST(o_orderkey % 5 + 1 AS STRING), 'e Ch.', CAST(o_custkey % 15 AS STRING), CASE WHEN o_orderkey % 4 = 0 THEN concat(' and `Spasm Chapter ', CAST(o_custkey % 13 + 1 AS STRING), '` so') ELSE '' END, CASE WHEN o_orderkey % 6 = 0 THEN concat(chr(10), 'see Unknown Ch', CAST(o_orderkey % 9 AS STRING)) ELSE '' END) AS text"
)
STATS = (
    "p_partkey AS book, CAST(p_size AS BIGINT) AS pages, CAST(p_partkey % 40 AS BIGINT) * 1000 AS bytes, CAST(p_partkey % 60 AS BIGINT) AS tables, CAST(p_partkey % 23 AS BIGINT) AS lost, CAST(p_partkey % 10 AS DOUBLE) / 10 AS flag_rate, CAST(p_partkey % 14 AS BIGINT) AS dosage, CAST(p_partkey % 30 AS BIGINT) AS chapters, CAST(p_partkey % 150 AS BIGINT) AS tables_before"
)
PLAN = "c_custkey AS book, CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE c_nationkey END AS text_time, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey % 25 END AS manifest_time, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE c_custkey % 20 END AS held_time"
SOURCES = "concat('/a/', CAST(s_suppkey AS STRING), '.pdf') AS path, concat('Book ', CAST(CAST(floor(s_suppkey / CASE WHEN s_nationkey % 3 = 0 THEN 2 ELSE 1 END) AS INT) AS STRING), CASE WHEN s_nationkey % 2 = 0 THEN ' 2019' ELSE '' END, '.pdf') AS name"
BOOKS = "c_custkey AS book, CASE WHEN c_custkey % 7 = 0 THEN concat('/a/', CAST(c_custkey AS STRING), '.pdf') END AS configured, CASE WHEN c_custkey % 5 = 0 THEN concat('/a/', CAST(c_nationkey AS STRING), '.pdf') END AS header, concat('book ', CAST(c_custkey % 130 AS STRING), CASE WHEN c_custkey % 3 = 0 THEN ' 2019' ELSE '' END, '.pdf') AS name"
BOXES = (
    "CAST(floor(l_orderkey / 4) AS BIGINT) AS book, CAST(l_orderkey % 4 AS INT) AS page, l_partkey * 1000000 + l_suppkey * 1000 + CAST(l_quantity AS BIGINT) AS ord, CAST(CASE WHEN l_partkey % 9 = 0 AND l_orderkey % 3 > 0 THEN 40 WHEN l_suppkey % 2 = 0 THEN 50 ELSE CASE WHEN l_orderkey % 3 = 0 THEN 250 ELSE 320 END END AS DOUBLE) AS x0, CAST(l_partkey % 800 AS DOUBLE) AS y0, "
    "CAST(CASE WHEN l_partkey % 9 = 0 AND l_orderkey % 3 > 0 THEN 560 WHEN l_suppkey % 2 = 0 THEN 280 ELSE 550 END AS DOUBLE) AS x1, CAST(l_partkey % 800 + 10 AS DOUBLE) AS y1, CAST(595 AS DOUBLE) AS page_w, CAST(l_quantity AS BIGINT) AS n_chars"
)
IMAGES = "CAST(floor(l_orderkey / 4) AS BIGINT) AS book, CAST(l_orderkey % 4 AS INT) AS page, l_partkey * 1000000 + l_suppkey * 1000 + CAST(l_quantity AS BIGINT) AS image, CAST(l_partkey % 700 AS DOUBLE) AS y0, CAST(l_partkey % 700 + 60 AS DOUBLE) AS y1"
CAPTIONS = "CAST(floor(o_orderkey / 4) AS BIGINT) AS book, CAST(o_orderkey % 4 AS INT) AS page, CAST(o_custkey AS BIGINT) AS caption, CAST(o_custkey % 780 AS DOUBLE) AS top, CAST(o_custkey % 780 + 12 AS DOUBLE) AS bottom"
RASTERS = "CAST(floor(p_partkey / 20) AS BIGINT) AS book, CAST(p_partkey % 20 AS INT) AS page, CAST(CASE WHEN p_size % 3 = 0 THEN 1 ELSE 0 END AS BOOLEAN) AS full_page, p_partkey % 4 AS rasters, p_size AS text_blocks, p_partkey % 2 AS fonts"
FIGURES = "CAST(p_size AS BIGINT) AS book, p_partkey % 5 AS chapter, p_partkey % 37 AS number"
PRINTED = "p_partkey AS book, concat(CASE p_partkey % 3 WHEN 0 THEN 'Gait_2e' WHEN 1 THEN 'Balance' ELSE 'Falls' END, CASE WHEN p_partkey % 4 = 0 THEN '_2009' ELSE '' END, '.pdf') AS name, CASE p_partkey % 5 WHEN 0 THEN concat('Third Edition. Copyright ', CAST(p_partkey % 80 + 1940 AS STRING)) WHEN 1 THEN 'printed in 2001, 4th edition' WHEN 2 THEN 'no date' WHEN 3 THEN '[1985] edition: 6' ELSE '© 1999' END AS text"
LINES = (
    "CAST(floor(l_orderkey / 40) AS BIGINT) AS book, CAST(0 AS INT) AS page, l_partkey * 1000000 + l_suppkey * 1000 + CAST(l_quantity AS BIGINT) AS ord, CAST(CASE WHEN l_suppkey % 2 = 0 THEN 50 ELSE 110 END AS DOUBLE) AS x0, CAST(CASE WHEN l_suppkey % 2 = 0 THEN 100 ELSE 300 END AS DOUBLE) AS x1, CAST(l_partkey % 300 * 2 AS DOUBLE) AS base, l_suppkey % 2 = 0 AS bold_all, l_suppkey % 2 = 0 AS bold_start, l_partkey % 13 > 0 AS upright, CAST(595 AS DOUBLE) AS page_w"
)


def _derive(spark: SparkSession, sf_dir: str, table: str, select: str) -> DataFrame:
    return I.read(spark, sf_dir, table).selectExpr(*I.split_select(select))


def scan_only(spark, sf_dir):
    return B.scan_only(I.pages(spark, sf_dir).where("page % 3 <> 1 or book % 4 > 0").withColumn("text", F.when(F.col("book") % 5 == 0, F.substring("text", 1, 9)).otherwise(F.col("text"))))


def silent_failures(spark, sf_dir):
    garbled = F.translate("text", "aeiou", "ăęįőű")
    return B.silent_failures(I.pages(spark, sf_dir).withColumn("text", F.when(F.col("book") % 3 == 0, F.translate(garbled, "thnrsld ", "ţħńřšłđĸ")).otherwise(F.col("text"))))


def ocr_problems(spark, sf_dir):
    return B.ocr_problems(I.pages(spark, sf_dir).withColumn("text", F.when((F.col("book") % 4 == 0) & (F.col("page") % 2 == 0), " ").otherwise(F.col("text"))))


def book_plan(spark, sf_dir):
    d = _derive(spark, sf_dir, "customer", PLAN)
    part = lambda c: d.where(f"{c} is not null").select("book", F.col(c).alias("time"))
    return B.book_plan(part("text_time"), part("manifest_time"), part("held_time"), F.lit(7))


def source_lookup(spark, sf_dir):
    return B.source_lookup(_derive(spark, sf_dir, "customer", BOOKS), _derive(spark, sf_dir, "supplier", SOURCES))


def violations(spark, sf_dir):
    return B.violations(I.files(spark, sf_dir))


def triage(spark, sf_dir):
    return B.triage(_derive(spark, sf_dir, "part", STATS))


def index_totals(spark, sf_dir):
    return B.index_totals(I.pages(spark, sf_dir))


def chapter_tables(spark, sf_dir):
    return Q.chapter_tables(_derive(spark, sf_dir, "customer", NAMES))


def chapter_index(spark, sf_dir):
    return Q.chapter_index(_derive(spark, sf_dir, "customer", NAMES))


def scan_references(spark, sf_dir):
    return Q.scan_references(_derive(spark, sf_dir, "orders", NOTES)).withColumn("names", F.array_join("names", ","))


def reference_lint(spark, sf_dir):
    files = _derive(spark, sf_dir, "customer", NAMES).where("g < 21")
    return Q.lint(Q.scan_references(_derive(spark, sf_dir, "orders", NOTES)), Q.chapter_index(files), Q.chapter_tables(files)).drop("edition")


def reference_lint_all(spark, sf_dir):
    """As ``reference_lint``, whose SQL takes the folders below 21 only, over the files of all folders."""
    files = _derive(spark, sf_dir, "customer", NAMES)
    return Q.lint(Q.scan_references(_derive(spark, sf_dir, "orders", NOTES)), Q.chapter_index(files), Q.chapter_tables(files)).drop("edition")


def owning_chapters(spark, sf_dir):
    files = _derive(spark, sf_dir, "customer", NAMES)
    return Q.owning_chapters(files, files.select("folder").distinct().withColumn("seq", F.explode(F.array(F.lit(5), F.lit(12), F.lit(16)))))


def lint_embeds(spark, sf_dir):
    targets = _derive(spark, sf_dir, "customer", "c_custkey AS note, CASE WHEN c_custkey % 3 = 0 THEN lower(c_name) ELSE c_name END AS target")
    return Q.lint_embeds(targets, _derive(spark, sf_dir, "customer", "c_name AS name, c_custkey AS k").where("k % 2 = 0"))


def column_order(spark, sf_dir):
    return L.column_order(_derive(spark, sf_dir, "lineitem", BOXES).dropDuplicates(["book", "page", "ord"])).select("book", "page", "ord", "two_columns", "pos")


def ocr_gutter(spark, sf_dir):
    return L.ocr_gutter(_derive(spark, sf_dir, "lineitem", BOXES)).select("book", "page", F.round(F.col("gutter") * 1000).cast("long").alias("gutter_x1000"))


def runin_pairs(spark, sf_dir):
    return L.runin_pairs(_derive(spark, sf_dir, "lineitem", LINES).dropDuplicates(["book", "ord"]))


def backends(spark, sf_dir):
    return L.backends(_derive(spark, sf_dir, "part", RASTERS))


def caption_owners(spark, sf_dir):
    return L.caption_owners(_derive(spark, sf_dir, "lineitem", IMAGES).dropDuplicates(["book", "page", "image"]), _derive(spark, sf_dir, "orders", CAPTIONS))


def figure_gaps(spark, sf_dir):
    return L.id_gaps(_derive(spark, sf_dir, "part", FIGURES))


def _headings(spark, sf_dir):
    """Outline entries made of the headings of each book, without pages."""
    lines = C.book_lines(I.pages(spark, sf_dir))
    found = C.heading_lines(lines)
    return lines, found.select("book", F.col("line_no").alias("ord"), (F.col("line_no") % 3 + 1).cast("int").alias("level"), "title", "page")


def promoted_chapters(spark, sf_dir):
    o = I.outline(spark, sf_dir)
    return S.promote_chapters(o, o.select("book").distinct().withColumn("level", (F.col("book") % 3 + 1).cast("int"))).select("book", "ord", "new_level")


def ligature_repairs(spark, sf_dir):
    """The lines of every page with letters bitten off, against the page."""
    rows = F.transform(F.split("text", "\n", -1), lambda x: F.array(F.replace(x, F.lit("st"), F.lit("t")), F.replace(x, F.lit("ti"), F.lit("ti st "))))
    found = I.pages(spark, sf_dir).select("book", "page", S.repair_ligatures(rows, "text").alias("r"))
    return found.select("book", "page", F.size("r.repairs").alias("repairs"), F.size("r.suspects").alias("suspects"), F.md5(F.array_join(F.flatten("r.rows"), "|")).alias("rows_md5"))


def anchored_titles(spark, sf_dir):
    lines, titles = _headings(spark, sf_dir)
    return S.anchor_titles(titles, lines)


def deep_headings(spark, sf_dir):
    lines, titles = _headings(spark, sf_dir)
    return S.deep_headings(lines, titles).withColumn("line_no", F.col("line_no").cast("long"))


def title_checks(spark, sf_dir):
    pages = I.pages(spark, sf_dir).select("book", F.col("page").cast("string").alias("file"), F.when(F.col("page") % 4 == 0, "Chapter 2 Balance Training").otherwise(F.split("text", "\n")[0]).alias("title"), "text")
    return S.check_titles(pages)


def new_file_names(spark, sf_dir):
    d = _derive(spark, sf_dir, "part", PRINTED)
    edition, year = S.edition_and_year(F.col("text"))
    return d.select("book", S.new_file_name(F.col("name"), edition, year).alias("new_name"))


def book_documents(spark, sf_dir):
    """Whole books: pages with their tables, and what was counted on the way."""
    tables = I.tables(spark, sf_dir).withColumn("book", F.floor(F.col("t") / 20)).withColumn("page", (F.col("t") % 20 + 1).cast("int"))
    both = P.converted(I.pages(spark, sf_dir), tables)
    return both.withColumn("n_chars", F.length("text")).withColumn("text_md5", F.md5("text")).drop("text")


def chapter_strategies(spark, sf_dir):
    return P.chapter_files(I.pages(spark, sf_dir), I.outline(spark, sf_dir))


def queries() -> dict:
    own = [promoted_chapters, ligature_repairs, anchored_titles, deep_headings, title_checks, new_file_names, book_documents, chapter_strategies, scan_only, silent_failures, ocr_problems, book_plan, source_lookup, violations, triage, index_totals, chapter_tables, chapter_index, scan_references, reference_lint, reference_lint_all, owning_chapters, lint_embeds, column_order, ocr_gutter, runin_pairs, backends, caption_owners, figure_gaps]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    pages = f"p AS (SELECT {PAGE} FROM documents)"
    visible = "len(list_filter(string_split(text, chr(10)), lambda l: NOT regexp_matches(l, '^\\s*<!-- page (\\d+) -->\\s*$') AND regexp_matches(l, '\\S'))) > 0"
    stem = r"regexp_replace(lower(regexp_replace(regexp_replace(name, '\.[A-Za-z]+$', ''), '[ _-]+\d{4}$', '')), '[^a-z0-9]', '', 'g')"
    title = r"regexp_replace(regexp_replace(trim(replace({x}, '_', ' ')), '(?i)\.pdf$', ''), '\s+', ' ', 'g')"
    schemes = []
    for i, (name, pattern) in enumerate((*Q.SCHEMES, ("seq", Q.SEQUENCE))):
        t = f"nullif(regexp_extract(name, '{pattern}', 2), '')"
        if name == "C":
            t = f"coalesce({t}, CASE WHEN NOT regexp_matches(nx, '{pattern}') THEN regexp_replace(regexp_replace(nx, '\\.md$', ''), '^ch\\d+_', '') END)"
        schemes.append(f"SELECT folder, name, {i} AS rk, '{name}' AS strategy, TRY_CAST(regexp_extract(name, '{pattern}', 1) AS INT) AS number, {title.format(x=t)} AS title FROM fx WHERE regexp_matches(name, '{pattern}')")
    tables = f"""f AS (SELECT {NAMES} FROM customer), fx AS (SELECT *, lead(name) OVER (PARTITION BY folder ORDER BY name) AS nx FROM f {{where}}), a AS ({" UNION ALL ".join(schemes)}),
      b AS (SELECT folder, rk, strategy, number, first(title ORDER BY name) AS title FROM a WHERE title IS NOT NULL AND number > 0 GROUP BY 1, 2, 3, 4),
      e AS (SELECT folder, min(rk) AS rk FROM (SELECT folder, rk FROM b GROUP BY 1, 2 HAVING count(*) >= 3) GROUP BY folder), ct AS (SELECT folder, strategy, number, title FROM b JOIN e USING (folder, rk))"""
    index = "ci AS (SELECT fx.folder, coalesce(any_value(s), 'none') AS strategy, string_split(fx.folder, '_')[1] AS surname, count(*) AS files, coalesce(any_value(k), 0) AS chapters, coalesce(any_value(m), 0) AS max_chapter FROM fx LEFT JOIN (SELECT folder, any_value(strategy) AS s, count(*) FILTER (WHERE strategy <> 'seq') AS k, max(number) FILTER (WHERE strategy <> 'seq') AS m FROM ct GROUP BY folder) x ON x.folder = fx.folder GROUP BY fx.folder)"
    # The notes are of three shapes, so their references can be written down without parsing.
    refs = """rf AS (SELECT o_orderkey AS note, 0 AS line, 0 AS ord, 'Gait' AS hit, 'Gait,in,as' AS names, CAST(o_custkey % 15 AS INT) AS chapter, CAST(o_orderkey % 5 + 1 AS STRING) || 'e' AS edition FROM orders
      UNION ALL SELECT o_orderkey, 0, 1, 'Spasm', 'Spasm', CAST(o_custkey % 13 + 1 AS INT), NULL FROM orders WHERE o_orderkey % 4 = 0
      UNION ALL SELECT o_orderkey, 1, 0, NULL, 'Unknown,see', CAST(o_orderkey % 9 AS INT), NULL FROM orders WHERE o_orderkey % 6 = 0)"""
    box = f"bx AS (SELECT DISTINCT {BOXES} FROM lineitem), b1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book, page, ord) AS q FROM bx) WHERE q = 1)"
    return {
        "new_file_names": """WITH r AS (SELECT p_partkey AS book, p_partkey % 3 AS a, p_partkey % 4 = 0 AS dated, p_partkey % 5 AS k, p_partkey % 80 + 1940 AS y FROM part),
          v AS (SELECT *, CASE k WHEN 0 THEN CASE WHEN y >= 1980 OR y >= 1950 THEN y END WHEN 1 THEN 2001 WHEN 3 THEN 1985 WHEN 4 THEN 1999 END AS ty, CASE k WHEN 0 THEN 3 WHEN 1 THEN 4 WHEN 3 THEN 6 END AS te FROM r)
          SELECT book, CASE WHEN coalesce(ty, CASE WHEN dated THEN 2009 END) IS NOT NULL THEN CASE a WHEN 0 THEN 'Gait' WHEN 1 THEN 'Balance' ELSE 'Falls' END || '_' || CASE WHEN a = 0 THEN 2 ELSE coalesce(te, 1) END || 'e_' || coalesce(ty, 2009) || '.pdf' END AS new_name FROM v""",
        "scan_only": f"WITH {pages}, q AS (SELECT book, page, CASE WHEN book % 5 = 0 THEN text[1:9] ELSE text END AS text FROM p WHERE page % 3 <> 1 OR book % 4 > 0) SELECT book, sum(CASE WHEN page <= 5 THEN length(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')) ELSE 0 END) < 100 AS scan_only FROM q GROUP BY book",
        "silent_failures": rf"""WITH {pages}, q AS (SELECT book, page, CASE WHEN book % 3 = 0 THEN translate(translate(text, 'aeiou', 'ăęįőű'), 'thnrsld ', 'ţħńřšłđĸ') ELSE text END AS text, greatest(1, count(*) OVER (PARTITION BY book) // 6) AS st FROM p),
          s AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY page) AS k FROM q WHERE page - 1 >= st AND (page - 1) % st = 0 AND length(text) >= 100),
          g AS (SELECT book, sum(length(regexp_replace(text, '[^\x20-\x7e\n\t\r\x{{4e00}}-\x{{9fff}}\x{{3000}}-\x{{303f}}\x{{ff00}}-\x{{ffef}}\x{{a0}}-\x{{ff}}]', '', 'g'))) < 0.5 * sum(length(text)) AS garbled FROM s WHERE k <= 5 GROUP BY book)
          SELECT DISTINCT p.book, coalesce(garbled, false) AS garbled FROM p LEFT JOIN g USING (book)""",
        "ocr_problems": f"WITH {pages}, q AS (SELECT book, CASE WHEN book % 4 = 0 AND page % 2 = 0 THEN ' ' ELSE text END AS text FROM p) SELECT book, count(*) AS pages, count(*) FILTER (WHERE NOT ({visible})) AS empty, sum(length(text))::BIGINT AS chars, count(*) FILTER (WHERE NOT ({visible})) / count(*) > 0.35 OR sum(length(text)) / count(*) < 200 AS failed FROM q GROUP BY book",
        "book_plan": f"WITH d AS (SELECT {PLAN} FROM customer) SELECT book, force FROM (SELECT book, CASE WHEN manifest_time IS NULL AND held_time IS NOT NULL THEN CASE WHEN greatest(text_time, 7) > held_time THEN true END WHEN manifest_time IS NULL THEN false WHEN text_time > manifest_time THEN true END AS force FROM d WHERE text_time IS NOT NULL) WHERE force IS NOT NULL",
        "source_lookup": f"""WITH s AS (SELECT *, {stem} AS stem FROM (SELECT {SOURCES} FROM supplier)), b AS (SELECT *, {stem} AS stem FROM (SELECT {BOOKS} FROM customer)),
          n AS (SELECT b.*, (SELECT count(*) FROM s WHERE lower(s.name) = lower(b.name)) AS nn, (SELECT min(path) FROM s WHERE lower(s.name) = lower(b.name)) AS np, (SELECT count(*) FROM s WHERE s.stem = b.stem) AS sn, (SELECT min(path) FROM s WHERE s.stem = b.stem) AS sp FROM b)
          SELECT book, CASE WHEN configured IN (SELECT path FROM s) THEN configured WHEN header IN (SELECT path FROM s) THEN header WHEN nn = 1 THEN np WHEN nn > 1 THEN NULL WHEN sn = 1 THEN sp END AS path,
            CASE WHEN configured IN (SELECT path FROM s) THEN 'configured' WHEN header IN (SELECT path FROM s) THEN 'header' WHEN nn = 1 THEN 'name' WHEN nn > 1 THEN 'ambiguous' WHEN sn = 1 THEN 'stem' WHEN sn > 1 THEN 'ambiguous' ELSE 'missing' END AS how FROM n""",
        "violations": f"""WITH f AS (SELECT {FILES} FROM customer), h AS (SELECT * FROM f WHERE listed AND on_disk), s AS (SELECT *, lag(page_end) OVER w AS pe, lag(file) OVER w AS pf, max(chapter_number) OVER (PARTITION BY book ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM h WINDOW w AS (PARTITION BY book ORDER BY seq)),
          r AS (SELECT book, min(chapter_number) AS a, max(chapter_number) AS b FROM f WHERE listed GROUP BY book), m AS (SELECT book, string_agg(n::VARCHAR, ',' ORDER BY n) AS ms FROM (SELECT book, unnest(range(a, b + 1)) AS n FROM r) x WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.book = x.book AND f.listed AND f.chapter_number = n) GROUP BY book)
          SELECT book, 'unlisted_file' AS "check", file, NULL::VARCHAR AS detail FROM f WHERE on_disk AND NOT listed UNION ALL SELECT book, 'missing_file', file, NULL FROM f WHERE listed AND NOT on_disk
          UNION ALL SELECT book, 'duplicate_entry', file, NULL FROM f WHERE listed GROUP BY book, file HAVING count(*) > 1 UNION ALL SELECT book, 'schema', file, 'kind ' || kind FROM f WHERE listed AND kind = 'odd'
          UNION ALL SELECT book, 'page_overlap', file, 'pages overlap ' || pf FROM s WHERE page_start <= pe UNION ALL SELECT book, 'page_gap', file, 'pages ' || (pe + 1) || '-' || (page_start - 1) || ' in no file' FROM s WHERE page_start > pe + 1
          UNION ALL SELECT book, 'chapter_order', file, 'chapter ' || chapter_number || ' after chapter ' || top FROM s WHERE chapter_number < top UNION ALL SELECT book, 'chapter_gap', NULL, 'chapter numbers missing: ' || ms FROM m""",
        "triage": f"""WITH s AS (SELECT {STATS} FROM part), q AS (SELECT book, bytes / greatest(pages, 1) < 500 AS a, tables > 0 AND lost / nullif(tables, 0) > 0.25 AS b, flag_rate > 0.7 AS c, dosage >= 10 AS d, chapters / greatest(pages, 1) > 0.5 AS e, tables_before >= 50 AND tables < tables_before * 0.5 AS f FROM s)
          SELECT book, CASE WHEN a THEN 'BLOCKED' WHEN b OR c OR d THEN 'REVIEW' WHEN e OR f THEN 'ODD' ELSE 'OK' END AS tier, concat_ws(',', CASE WHEN a THEN 'bytes' END, CASE WHEN b THEN 'loss' END, CASE WHEN c THEN 'flags' END, CASE WHEN d THEN 'dosage' END, CASE WHEN e THEN 'chapters' END, CASE WHEN f THEN 'collapse' END) AS reasons FROM q""",
        "index_totals": f"WITH {pages} SELECT book, count(*) AS files, sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')))::BIGINT AS words FROM p GROUP BY ROLLUP (book)",
        "chapter_tables": f"WITH {tables.format(where='')} SELECT * FROM ct",
        "chapter_index": f"WITH {tables.format(where='')}, {index} SELECT * FROM ci",
        "scan_references": f"WITH {refs} SELECT note, line, ord, names, chapter, edition FROM rf",
        "reference_lint": f"""WITH {tables.format(where='WHERE g < 21')}, {index}, {refs}, h AS (SELECT rf.*, ci.folder, strategy, max_chapter, chapters >= 0.9 * max_chapter AS whole, edition IS NULL OR contains(folder, '_' || replace(edition, 'e', '') || 'e_') AS fits FROM rf JOIN ci ON ci.surname = rf.hit),
          k AS (SELECT * FROM (SELECT *, bool_or(fits) OVER (PARTITION BY note, line, ord) AS anyf FROM h) WHERE fits OR NOT anyf),
          v AS (SELECT note, line, ord, count(*) FILTER (WHERE k.strategy NOT IN ('none', 'seq')) AS mp, count(ct.title) AS hv, count(DISTINCT ct.title) AS tt, count(*) FILTER (WHERE k.strategy NOT IN ('none', 'seq') AND k.chapter > max_chapter AND whole) AS pv FROM k LEFT JOIN ct ON ct.folder = k.folder AND ct.number = k.chapter AND ct.strategy <> 'seq' GROUP BY 1, 2, 3)
          SELECT rf.note, rf.line, rf.ord, chapter, CASE WHEN coalesce(mp, 0) = 0 THEN 'UNVERIFIABLE' WHEN hv = 0 AND pv = mp THEN 'BAD_CHAPTER' WHEN hv = 0 THEN 'UNVERIFIABLE' WHEN tt > 1 THEN 'AMBIGUOUS' ELSE 'OK' END AS verdict FROM rf LEFT JOIN v USING (note, line, ord)""",
        "owning_chapters": rf"""WITH f AS (SELECT {NAMES} FROM customer), n AS (SELECT folder, TRY_CAST(regexp_extract(name, '(?i)^ch(\d+)_(\d+)[_ ](.+)\.md$', 1) AS INT) AS a, TRY_CAST(regexp_extract(name, '(?i)^ch(\d+)_(\d+)[_ ](.+)\.md$', 2) AS INT) AS b FROM f WHERE regexp_matches(name, '(?i)^ch\d+_\d+[_ ].+\.md$')),
          s AS (SELECT DISTINCT folder, unnest([5, 12, 16]) AS seq FROM f) SELECT s.folder, s.seq, max_by(b, a) AS owner FROM s LEFT JOIN n ON n.folder = s.folder WHERE a IS NULL OR a <= seq GROUP BY s.folder, s.seq""",
        "lint_embeds": "SELECT c_custkey AS note, CASE WHEN c_custkey % 3 = 0 THEN lower(c_name) ELSE c_name END AS target, CASE WHEN c_custkey % 2 = 1 THEN 'MISSING' WHEN c_custkey % 3 = 0 THEN 'CASE MISMATCH' ELSE 'ok' END AS verdict FROM customer",
        "column_order": f"""WITH {box}, s AS (SELECT *, CASE WHEN x0 < 267.75 AND x1 > 327.25 THEN 2 WHEN (x0 + x1) / 2 < 297.5 THEN 0 ELSE 1 END AS sd FROM b1),
          t AS (SELECT book, page, count(*) >= 4 AND count(*) FILTER (WHERE sd = 0) >= 2 AND count(*) FILTER (WHERE sd = 1) >= 2 AND count(*) FILTER (WHERE sd = 0 AND x1 > 327.25) = 0 AND count(*) FILTER (WHERE sd = 1 AND x0 < 267.75) = 0 AS two FROM s GROUP BY book, page),
          u AS (SELECT s.*, two, CASE WHEN sd = 2 THEN (SELECT count(*) FROM s f WHERE f.book = s.book AND f.page = s.page AND f.sd = 2 AND (f.y0 < s.y0 OR f.y0 = s.y0 AND f.ord < s.ord)) ELSE (SELECT count(*) FROM s f WHERE f.book = s.book AND f.page = s.page AND f.sd = 2 AND f.y0 <= s.y0) END AS band FROM s JOIN t USING (book, page))
          SELECT book, page, ord, two AS two_columns, CASE WHEN two THEN row_number() OVER (PARTITION BY book, page ORDER BY band, sd, y0, ord) ELSE row_number() OVER (PARTITION BY book, page ORDER BY y0, x0, ord) END::INT AS pos FROM u""",
        "backends": f"WITH r AS (SELECT {RASTERS} FROM part) SELECT book, page, CASE WHEN full_page AND rasters > 0 THEN 'caption_anchor' WHEN NOT full_page AND (rasters >= 2 OR text_blocks >= 10 AND fonts > 0) THEN 'geometric' ELSE 'caption_anchor' END AS backend, CASE WHEN full_page AND rasters > 0 THEN 0.92 WHEN NOT full_page AND rasters >= 2 THEN 0.95 WHEN NOT full_page AND text_blocks >= 10 AND fonts > 0 THEN 0.75 ELSE 0.9 END::DOUBLE AS confidence FROM r",
        "figure_gaps": f"WITH f AS (SELECT {FIGURES} FROM part), c AS (SELECT book, chapter, count(DISTINCT number) AS n, max(number) - min(number) + 1 AS s FROM f GROUP BY 1, 2) SELECT book, sum(s - n)::BIGINT AS gaps, sum(s)::BIGINT AS expected FROM c GROUP BY book",
        "caption_owners": f"""WITH i AS (SELECT DISTINCT {IMAGES} FROM lineitem), c AS (SELECT {CAPTIONS} FROM orders), j AS (SELECT i.*, caption, top, bottom FROM i JOIN c USING (book, page)),
          d AS (SELECT book, page, image, caption, 'above' AS direction, abs(y0 - top) AS d FROM j WHERE top <= y0 + 30 UNION ALL SELECT book, page, image, caption, 'below', abs(bottom - y1) FROM j WHERE bottom >= y1 - 30),
          n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY book, page, direction, image ORDER BY d, caption) AS q FROM d) WHERE q = 1),
          s AS (SELECT book, page, direction, row_number() OVER (PARTITION BY book, page ORDER BY count(DISTINCT caption) DESC, sum(d), direction) AS q FROM n GROUP BY book, page, direction)
          SELECT n.book, n.page, image, caption, n.direction FROM n JOIN s ON s.q = 1 AND s.book = n.book AND s.page = n.page AND s.direction = n.direction""",
    }
