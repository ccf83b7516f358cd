"""SQL for DuckDB that gives the results of the registered queries by other means."""

from __future__ import annotations

from quire import constants as K
from quire.plans.inputs import OUTLINE, PAGE, TABLES_SQL

PAGES = f"p AS (SELECT {PAGE} FROM documents)"


def _ligatures(x: str) -> str:
    for glyph, letters in K.LIGATURES.items():
        x = f"replace({x}, '{glyph}', '{letters}')"
    return x


def _clean(x: str) -> str:
    x = rf"regexp_replace({x}, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')"
    x = f"replace({_ligatures(x)}, chr(173), '')"
    x = rf"regexp_replace({x}, '([\p{{L}}\p{{N}}_])-\n([\p{{L}}\p{{N}}_])', '\1\2', 'g')"
    return rf"regexp_replace({x}, '([a-z,;])\n([a-z])', '\1 \2', 'g')"


def _has_text(x: str) -> str:
    return f"len(list_filter(string_split({x}, chr(10)), lambda l: NOT regexp_matches(l, '{K.PAGE_MARKER}') AND regexp_matches(l, '\\S'))) > 0"


def _markers(x: str) -> str:
    return rf"list_transform(list_filter(string_split({x}, chr(10)), lambda l: regexp_matches(l, '{K.PAGE_MARKER}')), lambda l: CAST(regexp_extract(l, '{K.PAGE_MARKER}', 1) AS INT))"


DOSE = K.DOSE.replace("'", "''")
CONT = K.CONTINUED.replace("'", "''")
REF = K.REFERENCE
HEADING = f"(regexp_matches(s, '{K.CHAPTER_HEADING}') OR regexp_matches(s, '{K.PART_HEADING}') OR regexp_matches(s, '{K.SECTION_HEADING}') OR regexp_matches(s, '{K.NUMBERED_HEADING}'))"
_UNNUMBERED = f"(regexp_matches(s, '{K.CHAPTER_HEADING}') OR regexp_matches(s, '{K.PART_HEADING}') OR regexp_matches(s, '{K.SECTION_HEADING}'))"
_STRIP = r"regexp_replace(regexp_replace({x}, '^\s+', ''), '\s+$', '')"
_SIGNATURE = r"lower(trim(regexp_replace(s, '^\d{1,2}\s+', '')))"

LINES = f"""{PAGES},
l0 AS (SELECT book, page, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM p),
ln AS (SELECT book, page, text, row_number() OVER (PARTITION BY book ORDER BY page, pos) - 1 AS line_no FROM l0)"""
HEADINGS = f"""{LINES},
h0 AS (SELECT *, {_STRIP.format(x="text")} AS s FROM ln),
h1 AS (SELECT * FROM h0 WHERE length(s) BETWEEN 3 AND 120),
run AS (SELECT book, {_SIGNATURE} AS g FROM h1 WHERE regexp_matches(s, '{K.NUMBERED_HEADING}') GROUP BY 1, 2 HAVING count(DISTINCT regexp_extract(s, '^(\\d{{1,2}})\\b', 1)) >= 3),
h AS (SELECT book, line_no, page, s AS title, CASE WHEN regexp_extract(s, '{K.CHAPTER_KEY}', 1) <> '' THEN upper(regexp_extract(s, '{K.CHAPTER_KEY}', 1)) ELSE s[1:20] END AS key
  FROM h1 WHERE {HEADING} AND ({_UNNUMBERED} OR NOT EXISTS (SELECT 1 FROM run WHERE run.book = h1.book AND run.g = {_SIGNATURE})))"""
TOC = f"""{HEADINGS},
t0 AS (SELECT *, CASE WHEN line_no - lag(line_no) OVER (PARTITION BY book ORDER BY line_no) <= 60 THEN 0 ELSE 1 END AS nw FROM h),
t1 AS (SELECT *, sum(nw) OVER (PARTITION BY book ORDER BY line_no) AS r FROM t0),
t2 AS (SELECT book, r, min(line_no) AS a, max(line_no) AS b, count(*) AS n, count(DISTINCT key) AS k,
         (SELECT count(DISTINCT x.key) FROM t1 x WHERE x.book = t1.book AND x.r = t1.r AND EXISTS (SELECT 1 FROM t1 y WHERE y.book = x.book AND y.key = x.key AND y.r > x.r)) AS again
       FROM t1 GROUP BY book, r),
toc AS (SELECT book, a, b FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY n DESC, r) AS q FROM t2 WHERE n >= 6 AND again >= greatest(3, k // 2)) WHERE q = 1)"""

TITLE = r"regexp_replace(regexp_replace(title, '^\s+', ''), '\s+$', '')"
_WORDS = "CASE lower(regexp_extract(title, '(?i)^\\s*chapter\\s+([a-z]+(?:-[a-z]+)?)\\b', 1)) " + " ".join(f"WHEN '{w}' THEN {n}" for w, n in K.NUMBER_OF_WORD.items()) + " END"
#: RE2 has no look-around: a bare number is followed by a separator or white space and then by a title; "12.3" is left out by hand.
NUMBER = (
    r"coalesce(TRY_CAST(nullif(regexp_extract(title, '(?i)^\s*(?:chapter|chap\.?|ch\.?)\s*(\d{1,3})\b', 1), '') AS INT), "
    r"CASE WHEN NOT regexp_matches(title, '^\s*\d{1,3}\.\d') THEN TRY_CAST(nullif(regexp_extract(title, '^\s*(\d{1,3})(?:\s*[.:)_\-–—]\s*|\s+)[^\d\s.]', 1), '') AS INT) END, " + _WORDS + ")"
)
KEYWORD = r"TRY_CAST(nullif(regexp_extract(title, '(?i)^\s*(?:chapter|chap\.)\s*(\d{1,3})\b', 1), '') AS INT)"
O = f"o0 AS (SELECT {OUTLINE} FROM part), o AS (SELECT *, {NUMBER} AS n, {KEYWORD} AS kw FROM o0)"
BARE = r"trim(regexp_replace(title, '(?i)^\s*(?:chapter\s*(?:\d{1,3}|[a-z]+(?:-[a-z]+)?)\b|\d{1,3}(?:\.\d{1,3})*\b)\s*[.:)\-–—]*\s*', ''))"
_N = "trim(regexp_replace(lower({x}), '[^0-9a-zÀ-ɏ㐀-鿿]+', ' ', 'g'))"

CELLS = f"""{TABLES_SQL},
cl AS (SELECT t, i, j, raw, {_STRIP.format(x="replace(" + _clean("coalesce(raw, '')") + ", chr(10), ' ')")} AS v, {_STRIP.format(x="coalesce(raw, '')")} <> '' AS has FROM c),
rw AS (SELECT t, i, list(v ORDER BY j) AS vs, count(*) AS n, count(*) FILTER (WHERE v <> '') AS f, count(DISTINCT v) FILTER (WHERE v <> '') AS d, max(v) AS mx, count(*) FILTER (WHERE has) AS fr FROM cl GROUP BY t, i),
co AS (SELECT t, i, n, f, fr, vs, CASE WHEN f >= 3 AND d = 1 AND length(mx) >= 15 THEN list_prepend(mx, list_transform(vs[2:], lambda x: '')) ELSE vs END AS cv FROM rw),
wd AS (SELECT t, max(n) AS width, count(*) AS n_rows, sum(n) AS cells, sum(len(list_filter(cv, lambda x: x <> ''))) AS kept FROM co GROUP BY t),
md AS (SELECT t, CASE WHEN any_value(n_rows) >= 2 AND any_value(kept) / any_value(cells) >= 0.05 THEN
   string_agg(CASE WHEN i = 0 THEN ln || chr(10) || '| ' || array_to_string(list_transform(range(0, width), lambda x: '---'), ' | ') || ' |' ELSE ln END, chr(10) ORDER BY i) END AS md
  FROM (SELECT co.t, i, width, n_rows, kept, cells, '| ' || array_to_string(list_concat(cv, list_transform(range(0, width - n), lambda x: '')), ' | ') || ' |' AS ln FROM co JOIN wd USING (t)) GROUP BY t)"""

CONTINUES = f"""g AS (SELECT *, (SELECT max(len(x)) FROM (SELECT unnest(rows) AS x)) AS cc FROM tab),
pr AS (SELECT b.t, (a.page_h - a.bottom <= 0.12 * a.page_h AND b.top <= 0.28 * b.page_h AND a.cc = b.cc AND abs(a.x0 - b.x0) <= 11.9 AND abs(a.x1 - b.x1) <= 11.9
   AND abs(len(a.xedges) - len(b.xedges)) <= 1
   AND len(list_filter(CASE WHEN len(a.xedges) <= len(b.xedges) THEN a.xedges ELSE b.xedges END, lambda x: len(list_filter(CASE WHEN len(a.xedges) <= len(b.xedges) THEN b.xedges ELSE a.xedges END, lambda y: abs(x - y) <= 11.9)) = 0)) = 0) AS loose,
   NOT a.heading_below AND NOT b.heading_above AS quiet FROM g a JOIN g b ON a.book = b.book AND b.page = a.page + 1),
cf AS (SELECT g.t, coalesce(loose AND quiet, false) AS merges, coalesce(loose, false) AS flagged FROM g LEFT JOIN pr USING (t))"""

_BLOCK = "p|div|br|li|ul|ol|h1|h2|h3|h4|h5|h6|section|article|header|footer|nav|main|aside|blockquote|pre|table|tr|thead|tbody|figure|figcaption|hr|dl|dt|dd|title|head|body|html"


def _html(x: str) -> str:
    x = rf"regexp_replace(regexp_replace({x}, '(?is)<script\b.*?(?:</script\s*>|$)', '', 'g'), '(?is)<style\b.*?(?:</style\s*>|$)', '', 'g')"
    x = rf"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    x = rf"regexp_replace({x}, '(?i)</t[dh]\s*>\s*<t[dh]\b[^>]*>', ' | ', 'g')"
    x = rf"regexp_replace({x}, '(?i)</?(?:{_BLOCK})\b[^>]*>', chr(10), 'g')"
    x = rf"regexp_replace({x}, '</?[a-zA-Z!][^>]*>', '', 'g')"
    for a, b in (("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        x = f"replace({x}, '{a}', '{b}')"
    x = f"replace({x}, '&#39;', chr(39))"
    x = rf"regexp_replace(replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t ]+', ' ', 'g')"
    x = f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: trim(l)), chr(10))"
    return rf"regexp_replace(regexp_replace(regexp_replace({x}, '\n{{3,}}', chr(10) || chr(10), 'g'), '^\s+', ''), '\s+$', '')"


SQL = {
    "clean_text": f"WITH {PAGES} SELECT book, page, md5({_clean('text')}) AS cleaned_md5, len(regexp_extract_all(text, '[{''.join(K.LIGATURES)}]'))::BIGINT AS ligatures FROM p",
    "annotate_references": f"WITH {PAGES} SELECT book, page, md5(regexp_replace(text, '{REF}', '\\0 <!-- REF: \\0 → see PDF page ' || page || ' -->', 'g')) AS annotated_md5, len(list_distinct(regexp_extract_all(text, '{REF}')))::BIGINT AS refs FROM p",
    "page_signals": rf"WITH {PAGES} SELECT book, page, len(regexp_extract_all(text, '{DOSE}'))::BIGINT AS doses, regexp_matches(text, '{CONT}') AS continued, {_has_text('text')} AS has_text, list_min({_markers('text')}) AS first_marker, list_max({_markers('text')}) AS last_marker, len(list_distinct(list_transform(regexp_extract_all(text, '\(([A-Ha-h])\)', 1), lambda x: upper(x)))) >= 2 AS multipanel FROM p",
    "html_to_text": f"SELECT page_id, length(x)::BIGINT AS n_chars, md5(x) AS text_md5 FROM (SELECT page_id, {_html('html')} AS x FROM pages)",
    "book_conversion_stats": rf"""WITH {PAGES}, q AS (SELECT book, page, {_clean('text')} AS text FROM p),
      d AS (SELECT book, len(list_distinct(regexp_extract_all(text, '{REF}'))) AS r, len(regexp_extract_all(text, '{DOSE}')) AS n, length(text) AS c, len(regexp_extract_all(text, '(?m)^(?:TABLE|Table) *\d+')) AS k, {_has_text('text')} AS h FROM q)
      SELECT book, count(*) AS pages, sum(r)::BIGINT AS fig_refs, sum(n)::BIGINT AS doses, sum(c)::BIGINT AS n_chars, sum(k)::BIGINT AS table_captions, count(*) FILTER (WHERE NOT h) AS textless, sum(k) >= 10 AS many_captions FROM d GROUP BY book""",
    "heading_lines": f"WITH {HEADINGS} SELECT book, line_no, page, title, key FROM h",
    "detect_chapters": f"WITH {TOC}, k AS (SELECT h.* FROM h LEFT JOIN toc USING (book) WHERE a IS NULL OR line_no < a OR line_no > b) SELECT book, line_no, page, title, key FROM (SELECT *, row_number() OVER (PARTITION BY book, key ORDER BY line_no) AS q FROM k) WHERE q = 1",
    "page_chunks": f"WITH {PAGES}, m AS (SELECT *, max(page) OVER (PARTITION BY book) AS most, (page - 1) // 6 AS g FROM p) SELECT book, (g * 6 + 1)::INT AS first, least(g * 6 + 6, most)::INT AS last, sum(length(text))::BIGINT AS n_chars, 'pages_' || (g * 6 + 1) || '-' || least(g * 6 + 6, most) || '.md' AS file FROM m GROUP BY book, g, most",
    "bookmark_chapters": f"""WITH {LINES}, {O}, f AS (SELECT book, page, min(line_no) AS a FROM ln GROUP BY book, page), tt AS (SELECT book, max(line_no) + 1 AS z FROM ln GROUP BY book),
      m AS (SELECT o.book, ord, title, a, row_number() OVER w AS number, coalesce(lead(a) OVER w, z) AS b, count(*) OVER (PARTITION BY o.book) AS k FROM o JOIN f ON f.book = o.book AND f.page = o.page JOIN tt ON tt.book = o.book WHERE level <= 2 WINDOW w AS (PARTITION BY o.book ORDER BY ord))
      SELECT m.book, number, trim(title) AS title, 'ch' || lpad(number::VARCHAR, greatest(2, length(number::VARCHAR))::INT, '0') || CASE WHEN safe <> '' THEN '_' || safe ELSE '' END || '.md' AS file, a AS line_start, b AS line_end
      FROM (SELECT *, replace(trim(regexp_replace(trim(title), '[^a-zA-Z0-9_ ]', '', 'g')[1:50]), ' ', '_') AS safe FROM m) m
      WHERE k >= 2 AND (b < a OR EXISTS (SELECT 1 FROM ln WHERE ln.book = m.book AND line_no >= a AND line_no < b AND NOT regexp_matches(text, '{K.PAGE_MARKER}') AND regexp_matches(text, '\\S')))""",
    "outline_titles": f"""WITH {O}, b AS (SELECT *, {BARE} AS bare FROM o), k AS (SELECT *, CASE WHEN {_N.format(x='bare')} <> '' THEN {_N.format(x='bare')} ELSE {_N.format(x='title')} END AS nt FROM b)
      SELECT book, ord, n AS number, kw AS keyword_number, bare AS bare_title, CASE WHEN regexp_matches(nt, '{K.REFERENCES_TITLE}') THEN 'references' WHEN regexp_matches(nt, '{K.FRONT_TITLE}') THEN 'front' WHEN regexp_matches(nt, '{K.BACK_TITLE}') THEN 'back' ELSE 'body' END AS kind FROM k""",
    "chapter_levels": f"""WITH {O}, s AS (SELECT *, lag(n) OVER (PARTITION BY book, level ORDER BY ord) AS before FROM o WHERE n IS NOT NULL),
      b AS (SELECT book, level, count(*) AS k, bool_and(before IS NULL OR n > before) AS up, bool_and(kw IS NOT DISTINCT FROM n) AS words FROM s GROUP BY book, level),
      g AS (SELECT book, first(level ORDER BY k DESC, level) AS level FROM b WHERE k >= 3 AND up GROUP BY book), bad AS (SELECT DISTINCT book FROM b WHERE k >= 3 AND NOT up),
      fw AS (SELECT book, first(level ORDER BY k DESC, level) AS level FROM b WHERE up AND words GROUP BY book)
      SELECT a.book, coalesce(g.level, CASE WHEN bad.book IS NULL THEN fw.level END) AS level, CASE WHEN g.level IS NOT NULL THEN 'ok' WHEN bad.book IS NOT NULL THEN 'numbers not increasing' WHEN fw.level IS NOT NULL THEN 'few chapters, titled Chapter N' ELSE 'no numbered titles' END AS reason
      FROM (SELECT DISTINCT book FROM o) a LEFT JOIN g USING (book) LEFT JOIN bad USING (book) LEFT JOIN fw USING (book)""",
    "chapter_states": f"""WITH {O}, x AS (SELECT *, book % 3 + 1 AS cl FROM o), y AS (SELECT *, max(CASE WHEN level <= cl THEN ord END) OVER (PARTITION BY book ORDER BY ord) AS src FROM x)
      SELECT y.book, y.ord, z.n AS chapter FROM y LEFT JOIN x z ON z.book = y.book AND z.ord = y.src AND z.level = z.cl""",
    "numbering_gaps": f"WITH {O}, x AS (SELECT book, n, lead(n) OVER (PARTITION BY book ORDER BY ord) AS nx FROM o WHERE level = book % 3 + 1 AND n IS NOT NULL) SELECT book, n AS after, nx AS before, nx - n - 1 AS missing FROM x WHERE nx - n > 1",
    "file_verdicts": rf"""WITH {PAGES}, q AS (SELECT book, page, regexp_replace(text[1:6000], '(?i)\bchapter(\d)', 'CHAPTER \1', 'g') AS h, CAST(book % 5 + 1 AS INT) AS n FROM p),
      l AS (SELECT *, list_filter(list_transform(string_split(h, chr(10)), lambda x: {_STRIP.format(x='x')}), lambda x: x <> '')[1:60] AS ls FROM q)
      SELECT book, page, CASE WHEN regexp_matches(h, '(?i)\bchapter\s*' || n || '\b') OR list_contains(ls, n::VARCHAR)
        OR len(list_filter(ls, lambda x: regexp_matches(x, '^' || n || '[.\s:]') AND regexp_matches(lower(regexp_replace(x, '^\d+[.\s:]\s*', '')), 'hip|and|groin'))) > 0
        OR regexp_matches(h, '(?im)(?:\b(?:fig(?:ure)?|table|box)\.?\s*|^)' || n || '\.\d{{1,2}}\b') THEN 'confirmed'
        WHEN len(list_filter(regexp_extract_all(h, '(?i)\bchapter\s*(\d{{1,3}})\b', 1), lambda x: x::INT <> n)) > 0 THEN 'contradicted' ELSE 'unknown' END AS verdict FROM l""",
    "table_render": f"WITH {CELLS} SELECT t, md5(md) AS md_md5 FROM md",
    "table_rejects": f"""WITH {CELLS}, k AS (SELECT t, count(DISTINCT j) FILTER (WHERE has) AS held, max(length(coalesce(raw, ''))) AS longest FROM cl GROUP BY t)
      SELECT t, CASE WHEN width <= 1 OR held <= 1 THEN CASE WHEN longest > 500 THEN 'page frame: ' || shape || ', ' || longest || '-char cell' WHEN (x1 - x0) * (bottom - top) >= 0.5 * page_w * page_h THEN 'page frame: ' || shape || ', bbox covers half the page or more' END END AS frame,
        CASE WHEN bottom <= 84.2 THEN 'running-header' WHEN top >= 757.8 THEN 'running-footer' END AS furniture
      FROM (SELECT *, CASE WHEN width <= 1 THEN 'single column' ELSE 'content in ' || held || ' of ' || width || ' columns' END AS shape FROM tab JOIN wd USING (t) JOIN k USING (t))""",
    "table_checks": f"""WITH {CELLS}, m0 AS (SELECT t, fr, count(*) AS k, min(i) AS f FROM co GROUP BY t, fr), mo AS (SELECT t, first(fr ORDER BY k DESC, f) AS mode FROM m0 GROUP BY t),
      rg AS (SELECT t, string_agg(i::VARCHAR, ',' ORDER BY i) FILTER (WHERE fr <> mode) AS x, count(*) AS n FROM co JOIN mo USING (t) GROUP BY t),
      em AS (SELECT t, string_agg(i::VARCHAR, ',' ORDER BY i) AS x FROM co JOIN (SELECT t, i FROM cl WHERE j = 0 AND NOT has) e USING (t, i) WHERE i >= 1 AND fr > 0 GROUP BY t),
      ru AS (SELECT t, count(*) AS x FROM c WHERE regexp_matches(raw, '{K.RUN_TOGETHER}') GROUP BY t),
      tk AS (SELECT t, j, regexp_split_to_array({_STRIP.format(x='raw')}, '\\s+') AS k FROM cl WHERE has),
      sg AS (SELECT t, j, count(*) FILTER (WHERE len(k) = 1 AND regexp_matches(k[1], '{K.NUMERIC_TOKEN}')) AS s, count(*) FILTER (WHERE NOT (len(k) = 1 AND regexp_matches(k[1], '{K.NUMERIC_TOKEN}')) AND len(list_filter(k, lambda x: regexp_matches(trim(x, ',;'), '{K.NUMERIC_TOKEN}'))) > 1) AS b FROM tk GROUP BY t, j),
      mv AS (SELECT t, sum(b) AS x FROM sg WHERE s >= 2 GROUP BY t)
      SELECT wd.t, CASE WHEN n_rows >= 2 THEN coalesce(rg.x, '') ELSE '' END AS ragged, coalesce(em.x, '') AS unlabelled, coalesce(ru.x, 0)::BIGINT AS run_together, coalesce(mv.x, 0)::BIGINT AS multi_values, width = 1 AS single_column
      FROM wd LEFT JOIN rg USING (t) LEFT JOIN em USING (t) LEFT JOIN ru USING (t) LEFT JOIN mv USING (t)""",
    "fake_tables": f"""WITH {CELLS}, sp AS (SELECT a.t, count(*) AS x FROM cl a JOIN cl b ON a.t = b.t AND a.i = b.i AND b.j = a.j + 1 WHERE regexp_matches(a.v, '[A-Za-z]$') AND regexp_matches(b.v, '^[a-z]') GROUP BY a.t),
      e AS (SELECT t, sum(n) AS n, sum(f) AS f, max(n) AS w, count(*) AS r, string_agg(nullif(trim(array_to_string(list_filter(vs, lambda x: x <> ''), ' ')), ''), chr(10) ORDER BY i) AS txt FROM co GROUP BY t),
      hd AS (SELECT t, regexp_matches(array_to_string(vs, ' '), '{K.TABLE_LABEL}') AS lab FROM co WHERE i = 0)
      SELECT t, CASE WHEN lab THEN NULL WHEN w <= 1 THEN 'single-column' WHEN (n - f) / n > 0.7 THEN 'mostly-empty' WHEN coalesce(sp.x, 0) >= 2 AND r <= 4 AND (n - f) / n >= 0.4 THEN 'word-split' END AS reason, md5(CASE WHEN txt IS NULL THEN '' ELSE txt || chr(10) END) AS plain_md5
      FROM e JOIN hd USING (t) LEFT JOIN sp USING (t)""",
    "content_retention": f"""WITH {CELLS}, ft AS (SELECT t, list(raw ORDER BY i, j) AS cs FROM c GROUP BY t),
      tk AS (SELECT t, i, j, regexp_extract_all(lower(coalesce(raw, '')), '[a-z0-9]+') AS k FROM c), tw AS (SELECT t, i, j, unnest(k) AS w, generate_subscripts(k, 1) AS q FROM tk),
      sr AS (SELECT t, unnest(list_distinct(regexp_extract_all(lower(concat_ws(' ', 'Titubation item3', cs[1], cs[2], 'inflammationcorticosteroids reduceinflammation')), '[a-z0-9]+'))) AS w FROM ft)
      SELECT ft.t, coalesce(m.x, '') AS missing FROM ft LEFT JOIN (SELECT t, string_agg(w, ' ' ORDER BY w) AS x FROM sr WHERE NOT EXISTS (SELECT 1 FROM tw WHERE tw.t = sr.t AND tw.w = sr.w)
        AND NOT EXISTS (SELECT 1 FROM tw a JOIN tw b ON a.t = b.t AND a.i = b.i AND a.j = b.j AND b.q = a.q + 1 WHERE a.t = sr.t AND a.w || b.w = sr.w) GROUP BY t) m USING (t)""",
    "reversed_tables": "SELECT DISTINCT l_orderkey AS t, l_orderkey % 5 = 0 AS reversed, CASE WHEN l_orderkey % 5 = 0 THEN 6 ELSE 0 END AS backward FROM lineitem",
    "grid_fill": """WITH x AS (SELECT l_orderkey AS t, l_partkey * 1000 + l_suppkey AS ord, l_partkey % 5 AS r0, least(6, l_partkey % 5 + 1 + l_suppkey % 3) AS r1, l_suppkey % 4 AS c0, least(4, l_suppkey % 4 + 1 + l_partkey % 2) AS c1 FROM lineitem)
      SELECT t, r.r::INT AS row, c.c::INT AS col, 'c' || max(ord) AS text FROM x JOIN range(0, 6) r(r) ON r.r >= r0 AND r.r < r1 JOIN range(0, 4) c(c) ON c.c >= c0 AND c.c < c1 GROUP BY 1, 2, 3""",
    "continuation_flags": f"WITH {TABLES_SQL}, {CONTINUES} SELECT t, merges, flagged FROM cf",
    "review_queue": f"""WITH {CELLS}, {CONTINUES}, {PAGES}, j AS (SELECT cf.t, flagged, coalesce(md, '') AS md, coalesce(text, '') AS text FROM cf JOIN md USING (t) LEFT JOIN p ON cf.t = p.book * 20 + p.page),
      q AS (SELECT t, CASE WHEN regexp_matches(text, '{CONT}') THEN 'continuation-page (orphan first row can be fused into the wrong label)' WHEN flagged THEN 'continuation-page by geometry, no continuation caption (orphan first row can be fused into the wrong label)' END AS a,
        CASE WHEN len(regexp_extract_all(md, '{DOSE}')) >= 2 THEN 'dosage/threshold values (a value on the wrong row = wrong clinical data)' END AS b FROM j)
      SELECT t, concat_ws('; ', a, b) AS reasons FROM q WHERE a IS NOT NULL OR b IS NOT NULL""",
}


def oracle_sql() -> dict[str, str]:
    from quire.plans import corpus_queries

    return SQL | corpus_queries.oracle_sql()
