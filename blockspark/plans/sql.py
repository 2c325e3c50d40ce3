"""SQL twins: what each registered query must return, written apart from the Spark plans."""

from __future__ import annotations

from blockspark.config import ChunkingConfig
from blockspark.operators.codescan import RULES
from blockspark.plans.fixtures import CODE, ELEMENT_CYCLE

NL = "chr(10)"
DOCS = "SELECT doc_id, coalesce(text, '') AS text, source FROM documents"
LINES = f"SELECT doc_id, unnest(string_split(text, {NL})) AS line, unnest(range(len(string_split(text, {NL})))) AS i FROM ({DOCS})"


def count(c: str, pattern: str) -> str:
    return f"(length({c}) - length(regexp_replace({c}, '{pattern}', '', 'g')))"


def tokens(c: str) -> str:
    cjk = count(c, "[一-鿿가-힯぀-ゟ゠-ヿ]")
    return f"CAST(trunc({cjk} / 1.5::DOUBLE + (length({c}) - {cjk}) / 4.0::DOUBLE) AS INTEGER)"


def words(c: str) -> str:
    return f"CASE WHEN trim({c}, chr(32)||chr(10)) = '' THEN 0 ELSE len(string_split_regex(trim({c}, chr(32)||chr(10)), '\\s+')) END::INTEGER"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def language(c: str) -> str:
    ko, zh, en = count(c, "[가-힯]"), count(c, "[一-鿿]"), count(c, "[a-zA-Z]")
    total = f"({ko} + {zh} + {en})"
    return f"CASE WHEN {total} = 0 THEN 'unknown' WHEN {ko} > {total} * 0.3::DOUBLE THEN 'ko' WHEN {zh} > {total} * 0.3::DOUBLE THEN 'zh' WHEN {en} > {total} * 0.5::DOUBLE THEN 'en' ELSE 'unknown' END"


def anchor(page: str, kind: str, order: str) -> str:
    short = f"CASE {kind} WHEN 'text' THEN 'txt' WHEN 'title' THEN 'ttl' WHEN 'table' THEN 'tbl' WHEN 'figure' THEN 'fig' END"
    return f"'[@p' || {page} || '_' || {short} || {order} || ']'"


BLOCKS = f"""SELECT lpad(doc_id::VARCHAR, 8, '0') AS doc_id, i, i // 20 + 1 AS page, i % 20 AS ro, CASE WHEN i % 7 = 0 THEN 'title' ELSE 'text' END AS type, line AS text,
  'p' || (i // 20 + 1) || '_b' || (i % 20) AS block_id FROM ({LINES})"""


def chunks(c: ChunkingConfig) -> str:
    """One step of the recursion per block number, for all documents at once."""
    return f"""
WITH RECURSIVE b AS (SELECT *, {tokens("text")} AS tok, type = 'title' AS head, {strip("text")} = '' AS blank, {strip("text")} AS label FROM ({BLOCKS})),
c AS (SELECT *, sum(tok) OVER (PARTITION BY doc_id ORDER BY i) AS cum FROM b),
o AS (SELECT e.doc_id, e.i, coalesce(min(z.i), e.i + 1) AS os FROM c e LEFT JOIN c z ON z.doc_id = e.doc_id AND z.i <= e.i AND z.cum - z.tok >= e.cum - {c.overlap_tokens} GROUP BY e.doc_id, e.i),
d AS (SELECT c.*, o.os, lag(o.os, 1, 0) OVER w AS os0, lag(cum, 1, 0) OVER w AS cum0, lead(c.i) OVER w IS NULL AS last FROM c JOIN o USING (doc_id, i) WINDOW w AS (PARTITION BY c.doc_id ORDER BY c.i)),
p AS (SELECT doc_id, i, cum - tok AS before FROM c),
r(doc_id, i, s, sec, out) AS (
  SELECT DISTINCT doc_id, -1::BIGINT, 0::BIGINT, NULL::VARCHAR, []::STRUCT(s BIGINT, e BIGINT, sec VARCHAR)[] FROM b
  UNION ALL
  SELECT doc_id, i, CASE WHEN full_ THEN greatest(s1, os) ELSE s1 END, sec1, CASE WHEN full_ THEN list_append(out1, {{'s': s1, 'e': i, 'sec': sec1}}) ELSE out1 END FROM (
    SELECT y.*, (cum - pp.before) >= {c.chunk_size} AND (blank OR (cum - pp.before) >= {c.max_chunk_size}) AS full_ FROM (
      SELECT x.doc_id, x.i, x.cum, x.os, x.blank, CASE WHEN shut THEN greatest(s, os0) ELSE s END AS s1, CASE WHEN head THEN label ELSE sec END AS sec1, CASE WHEN shut THEN list_append(out, {{'s': s, 'e': x.i - 1, 'sec': sec}}) ELSE out END AS out1 FROM (
        SELECT d.*, r.s, r.sec, r.out, d.head AND r.s < d.i AND d.cum0 - q.before >= {c.min_chunk_size} AS shut FROM r JOIN d ON d.doc_id = r.doc_id AND d.i = r.i + 1 LEFT JOIN p q ON q.doc_id = r.doc_id AND q.i = r.s) x) y
    JOIN p pp ON pp.doc_id = y.doc_id AND pp.i = y.s1)),
f AS (SELECT r.doc_id, CASE WHEN r.s <= r.i THEN list_append(out, {{'s': r.s, 'e': r.i, 'sec': r.sec}}) ELSE out END AS out FROM r JOIN d USING (doc_id, i) WHERE d.last),
g AS (SELECT doc_id, unnest(out) AS u, unnest(range(len(out))) AS k FROM f),
t AS (SELECT g.doc_id, k, any_value(u.sec) AS section, min(page) AS page_start, max(page) AS page_end, min(ro) AS reading_order_start, max(ro) AS reading_order_end, coalesce(string_agg(text, {NL}||{NL} ORDER BY b.i) FILTER (text <> ''), '') AS text,
  string_agg(block_id, ',' ORDER BY b.i) AS block_ids, string_agg({anchor("page", "type", "ro")}, ',' ORDER BY b.i) AS anchors FROM g JOIN b ON b.doc_id = g.doc_id AND b.i BETWEEN u.s AND u.e GROUP BY g.doc_id, k)
SELECT left(doc_id, 8) || '_c' || k AS chunk_id, doc_id, page_start::INTEGER AS page_start, page_end::INTEGER AS page_end, block_ids, section, text, {tokens("text")} AS token_count, length(text)::INTEGER AS char_count,
  reading_order_start::INTEGER AS reading_order_start, reading_order_end::INTEGER AS reading_order_end, anchors FROM t"""


MARKDOWN = f"""SELECT conv_id::VARCHAR AS doc_id, string_agg('## ' || role || ' ' || turn || {NL} || coalesce(text, '') || {NL} ||
  CASE turn % 3 WHEN 1 THEN '| a | b |' || {NL} || '|---|---|' || {NL} || '| ' || turn || ' | x |' || {NL} WHEN 2 THEN '![fig ' || turn || '](img/' || turn || '.png)' || {NL} || '$$x_' || turn || '$$' || {NL} ELSE '' END ||
  CASE WHEN turn % 2 = 0 THEN {NL} ELSE '' END, '' ORDER BY turn, role) AS markdown FROM conversations GROUP BY conv_id"""
MARKDOWN_LINES = f"SELECT doc_id, unnest(string_split(markdown, {NL})) AS line, unnest(range(len(string_split(markdown, {NL})))) AS i FROM ({MARKDOWN})"

LEGACY = f"""
WITH RECURSIVE b AS (SELECT *, {words("line")} AS n, regexp_matches(line, '^#{{1,2}}\\s+.+$') AS head, regexp_replace(line, '^#+\\s+', '') AS title, regexp_matches(line, '^#{{3,}}\\s+.+$') AS low, starts_with({strip("line")}, '|') AS bar, starts_with({strip("line")}, '![') AS image, {strip("line")} = '' AS blank FROM ({MARKDOWN_LINES})),
r(doc_id, i, s, k, sec, bar, out) AS (
  SELECT DISTINCT doc_id, -1::BIGINT, 0::BIGINT, 0::BIGINT, 'Introduction', false, []::STRUCT(s BIGINT, e BIGINT, sec VARCHAR)[] FROM b
  UNION ALL
  SELECT doc_id, i, CASE WHEN after THEN i + 1 ELSE s1 END, CASE WHEN after THEN 0 ELSE k1 END, sec1, bar AND NOT after, CASE WHEN after THEN list_append(out1, {{'s': s1, 'e': i, 'sec': sec1}}) ELSE out1 END FROM (
    SELECT *, NOT head AND NOT low AND NOT bar AND NOT image AND blank AND k1 >= 120 AS after FROM (
      SELECT *, CASE WHEN shut THEN i ELSE s END AS s1, CASE WHEN shut THEN 0 ELSE k END + n AS k1, CASE WHEN head THEN title ELSE sec END AS sec1, CASE WHEN shut THEN list_append(out, {{'s': s, 'e': i - 1, 'sec': sec}}) ELSE out END AS out1 FROM (
        SELECT b.*, r.s, r.k, r.sec, r.out, r.s < b.i AND ((head AND r.k > 20) OR (b.bar AND NOT head AND NOT low AND NOT r.bar AND r.k > 40)) AS shut FROM r JOIN b ON b.doc_id = r.doc_id AND b.i = r.i + 1)))),
f AS (SELECT r.doc_id, CASE WHEN r.s <= r.i THEN list_append(out, {{'s': r.s, 'e': r.i, 'sec': r.sec}}) ELSE out END AS out FROM r JOIN (SELECT doc_id, max(i) AS i FROM b GROUP BY doc_id) USING (doc_id, i)),
g AS (SELECT doc_id, unnest(out) AS u, unnest(range(len(out)))::INTEGER AS k FROM f)
SELECT g.doc_id, k, any_value(u.sec) AS section, string_agg(line, {NL} ORDER BY b.i) AS content FROM g JOIN b ON b.doc_id = g.doc_id AND b.i BETWEEN u.s AND u.e GROUP BY g.doc_id, k"""

TEXT_HASH = f"SELECT doc_id, source, sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS hash FROM ({DOCS})"
URL_HASH = "substr(sha256(split_part(rtrim(lower(url), '/'), '?', 1)), 1, 16)"
REGISTRY = f"SELECT 'texts' AS kind, hash, source AS path, lpad(doc_id::VARCHAR, 12, '0') AS date, doc_id AS seq FROM ({TEXT_HASH}) UNION ALL SELECT 'urls', {URL_HASH}, url, lpad(page_id::VARCHAR, 12, '0'), page_id FROM pages"

_NUMBERED = "CASE WHEN {n} THEN i || ' ' || line ELSE line END"
MODEL_BLOCKS = f"""SELECT doc_id::VARCHAR AS doc_id, i, 1 AS page, 'p1_b' || i AS block_id, ['title','text','text','text','title','title','text','table','figure','text'][i % 10 + 1] AS type, line AS text,
  CASE i % 10 WHEN 0 THEN '# ' || line WHEN 1 THEN '**Authors**: ' || line WHEN 2 THEN '*' || line || '*' WHEN 3 THEN '## Abstract' || {NL} || {NL} || line WHEN 4 THEN '## ' || i || ' ' || line WHEN 5 THEN '### ' || line WHEN 8 THEN '![' || i || ': ' || line || '](placeholder)' ELSE line END AS markdown,
  CASE WHEN i % 10 IN (7, 8) OR line = '' THEN 'unknown' ELSE {language("line")} END AS lang, CASE WHEN i % 10 IN (7, 8) THEN 0.0 ELSE 0.95 END::DOUBLE AS confidence FROM ({LINES})"""
PAGED = f"SELECT * REPLACE (i // 20 + 1 AS page), i % 20 AS ro FROM ({MODEL_BLOCKS})"
TITLES = f"""SELECT doc_id, first(title ORDER BY page) AS title FROM (SELECT doc_id, page, first({strip("text")} ORDER BY i) AS title FROM ({PAGED}) WHERE type = 'title' AND text <> '' GROUP BY doc_id, page) WHERE title <> '' GROUP BY doc_id"""
WRITTEN = f"""CASE WHEN type = 'title' THEN '# ' || {strip("CASE WHEN text <> '' THEN text ELSE markdown END")} WHEN type = 'table' THEN CASE WHEN text <> '' THEN '[Table]' || {NL} || {NL} || '```' || {NL} || text || {NL} || '```' ELSE '[Table]' END WHEN type = 'figure' THEN '[Figure]' WHEN markdown <> '' THEN markdown ELSE text END"""
RENDERED = f"""
WITH b AS (SELECT *, {WRITTEN} AS md, lag(page) OVER (PARTITION BY doc_id ORDER BY i) AS was FROM ({PAGED})), n AS (SELECT doc_id, max(page) AS pages FROM b GROUP BY doc_id)
SELECT b.doc_id, regexp_replace(coalesce('# ' || nullif(any_value(t.title), '') || {NL} || {NL}, '') || string_agg(CASE WHEN pages > 1 AND was <> page THEN {NL} || '---' || {NL} || '<!-- Page ' || page || ' -->' || {NL} || {NL} ELSE '' END || CASE WHEN md <> '' THEN md || {NL} || {NL} ELSE '' END, '' ORDER BY i), '\\n\\z', '') AS markdown
FROM b JOIN n USING (doc_id) LEFT JOIN ({TITLES}) t USING (doc_id) GROUP BY b.doc_id"""

_KIND = f"""CASE WHEN s = '' THEN 'B' WHEN regexp_matches(s, '^#{{1,6}}\\s+.+$') THEN 'H' WHEN regexp_matches(s, '^!\\[[^\\]]*\\]\\([^)]*\\)$') THEN 'F' WHEN regexp_matches(s, '^\\|.+\\|$') THEN 'T' WHEN regexp_matches(s, '^\\$\\$.+\\$\\$$') THEN 'M' ELSE 'P' END"""
MARKDOWN_BLOCKS = f"""
WITH l AS (SELECT *, {_KIND} AS kind FROM (SELECT *, {strip("line")} AS s FROM ({MARKDOWN_LINES}))),
m AS (SELECT *, count(*) FILTER (kind IN ('P', 'M')) OVER w AS t, max(i) OVER (PARTITION BY doc_id) + 1 AS n, min(CASE WHEN kind IN ('P', 'M') THEN i END) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ends,
  i - row_number() OVER (PARTITION BY doc_id, kind ORDER BY i) AS island FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, kind, min(i) AS a, max(i) AS z, max(n) AS n, max(ends) AS ends, regexp_replace(string_agg(line, {NL} ORDER BY i), '^\\s+|\\s+$', '', 'g') AS raw, string_agg(s, {NL} ORDER BY i) AS rows_, first(s ORDER BY i) AS s,
  string_agg(array_to_string(list_transform(string_split(trim(s, '|'), '|'), lambda x: trim(x)), ' | '), {NL} ORDER BY i) FILTER (NOT regexp_matches(s, '^\\|[\\s\\-|]+\\|$')) AS cells
  FROM m WHERE kind <> 'B' GROUP BY doc_id, kind, CASE kind WHEN 'P' THEN island WHEN 'T' THEN t ELSE i END)
SELECT doc_id, 1 AS page, (row_number() OVER (PARTITION BY doc_id ORDER BY CASE kind WHEN 'P' THEN z + 1 WHEN 'T' THEN coalesce(ends, n) ELSE z END, CASE WHEN kind = 'P' OR kind = 'T' AND ends IS NOT NULL THEN 0 ELSE 1 END) - 1)::INTEGER AS reading_order,
  CASE kind WHEN 'H' THEN 'title' WHEN 'F' THEN 'figure' WHEN 'T' THEN 'table' WHEN 'M' THEN 'formula' ELSE 'text' END AS type,
  CASE kind WHEN 'H' THEN regexp_replace(s, '^#{{1,6}}\\s+', '') WHEN 'F' THEN coalesce(nullif(trim(regexp_extract(s, '^!\\[([^\\]]*)\\]', 1)), ''), '[Figure]') WHEN 'M' THEN trim(s[3:-3]) WHEN 'T' THEN coalesce(cells, '') ELSE raw END AS text,
  CASE kind WHEN 'H' THEN regexp_extract(s, '^(#{{1,6}})', 1) || ' ' || regexp_replace(s, '^#{{1,6}}\\s+', '') WHEN 'T' THEN rows_ WHEN 'M' THEN s WHEN 'P' THEN raw END AS markdown FROM g"""

PARTS = f"""SELECT doc_id, part, bool_or(special) AS special, string_agg(line, {NL} ORDER BY i) AS content FROM (
  SELECT *, sum(CASE WHEN special OR was THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) - 1 AS part FROM (
    SELECT *, lag(special, 1, true) OVER (PARTITION BY doc_id ORDER BY i) AS was FROM (
      SELECT *, {strip("line")} = '' OR regexp_matches(line, '^(#|!\\[|<!--|\\*AI |\\||```|>)') AS special FROM ({MARKDOWN_LINES})))) GROUP BY doc_id, part"""
PARAGRAPHS = f"SELECT *, CASE WHEN NOT special THEN sum(CASE WHEN special THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY part) - 1 END AS para_idx FROM ({PARTS})"
TRANSLATED = f"SELECT *, CASE WHEN para_idx % 3 <> 0 THEN 'T' || para_idx || ' ' || left(content, 20) END AS translation FROM ({PARAGRAPHS})"

PAGED_CONVERSATIONS = f"""SELECT conv_id::VARCHAR AS doc_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS k, coalesce(text, '') AS text, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations"""
_MARK = f"({NL} || '---' || {NL} || '<!-- Page ' || (k + 2) || ' -->' || {NL})"
BOUNDARIES = f"""SELECT doc_id, k::INTEGER AS boundary, (stop - length({_MARK}))::INTEGER AS start, stop::INTEGER AS stop, tail, head FROM (
  SELECT *, sum(length(text) + length({_MARK})) OVER w AS stop, {strip("right(text, 500)")} AS tail, {strip("left(lead(text) OVER w, 500)")} AS head FROM ({PAGED_CONVERSATIONS}) WINDOW w AS (PARTITION BY doc_id ORDER BY k)) WHERE k < n - 1"""
MERGED = f"""
WITH p AS (SELECT *, CASE WHEN k < n - 1 AND k % 3 = 0 THEN 'merged ' || k END AS m FROM ({PAGED_CONVERSATIONS})), q AS (SELECT *, lag(m) OVER (PARTITION BY doc_id ORDER BY k) AS above, left(text, 500) AS a, right(text, 500) AS z FROM p),
c AS (SELECT *, CASE WHEN above IS NULL THEN 0 WHEN {strip("a")} = '' THEN length(a) ELSE length(a) - length(regexp_replace(a, '^\\s+', '')) + length({strip("a")}) END AS head,
  CASE WHEN m IS NULL OR {strip("z")} = '' THEN length(text) ELSE length(text) - (length(z) - length(regexp_replace(z, '\\s+$', ''))) - length({strip("z")}) END AS cut FROM q)
SELECT doc_id, string_agg(substr(text, head + 1, greatest(cut - head, 0)) || CASE WHEN m IS NOT NULL THEN {NL} || {NL} || m || {NL} || {NL} WHEN k < n - 1 THEN {_MARK} ELSE '' END, '' ORDER BY k) AS markdown FROM c GROUP BY doc_id"""


def missing(table: str, columns: dict[str, str]) -> str:
    rows = [f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS rows, count(*) FILTER ({c} IS NULL{' OR isnan(' + c + ')' if t == 'double' else ''}) AS missing, round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2)::DOUBLE AS missing_pct FROM {table}" for c, t in columns.items()]
    return " UNION ALL ".join(rows)


NUMERIC = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def describe() -> str:
    one = "SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}::DOUBLE), 4) AS mean, round(stddev_samp({c}::DOUBLE), 4) AS std, min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS q25, quantile_cont({c}::DOUBLE, 0.5) AS q50, quantile_cont({c}::DOUBLE, 0.75) AS q75, max({c})::DOUBLE AS max FROM lineitem"
    return " UNION ALL ".join(one.format(c=c) for c in NUMERIC)


def categorical(table: str, columns: tuple[str, ...]) -> str:
    one = "SELECT '{c}' AS \"column\", count(*) AS \"unique\", first(v ORDER BY n DESC, v) AS top, max(n) AS top_freq FROM (SELECT {c} AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})"
    return " UNION ALL ".join(one.format(c=c, t=table) for c in columns)


def outliers() -> str:
    one = "SELECT '{c}' AS \"column\", count(*) FILTER ({c} < lo OR {c} > hi) AS outliers, round(100.0 * count(*) FILTER ({c} < lo OR {c} > hi) / count(*), 2)::DOUBLE AS pct, round(any_value(lo), 4) AS lower, round(any_value(hi), 4) AS upper FROM lineitem, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (SELECT quantile_cont({c}::DOUBLE, 0.25) AS q1, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM lineitem))"
    return " UNION ALL ".join(one.format(c=c) for c in NUMERIC)


def correlations(above: float | None = None) -> str:
    pairs = [(a, b) for i, a in enumerate(NUMERIC) for b in NUMERIC[i + 1 :]]
    rows = " UNION ALL ".join(f"SELECT '{a}' AS col1, '{b}' AS col2, corr({a}::DOUBLE, {b}::DOUBLE) AS r FROM lineitem" for a, b in pairs)
    return f"SELECT col1, col2, round(r, 6) AS r FROM ({rows})" + (f" WHERE abs(r) > {above}" if above is not None else "")


LINE_BOXES = "SELECT l_suppkey AS region, l_orderkey * 10 + l_linenumber AS line_no, (l_partkey % 600 + 5)::DOUBLE AS x, (l_orderkey % 800 + 4)::DOUBLE AS y, (l_orderkey % 800)::DOUBLE AS lo, (l_orderkey % 800 + 8)::DOUBLE AS hi, l_discount AS conf, l_returnflag AS text FROM lineitem"


def sorted_lines(levels: int = 8) -> str:
    rows = f"SELECT *, NULL::INTEGER AS r, true AS o FROM ({LINE_BOXES})"
    for k in range(levels):
        mid = 600 / 2 ** (k + 1)
        rows = f"""SELECT region, line_no, x, y, lo, hi, conf, text, CASE WHEN sp AND r IS NULL AND o AND x >= {mid} THEN {k} ELSE r END AS r, o AND sp AS o FROM (
          SELECT *, coalesce(nh > 10 AND nl > 0 AND nr > 0 AND greatest(hl, hr) > least(ll, lr) AND greatest(0, least(hl, hr) - greatest(ll, lr)) / (greatest(hl, hr) - least(ll, lr)) > 0.3, false) AS sp FROM (
          SELECT *, count(*) FILTER (h) OVER w AS nh, count(*) FILTER (h AND x < {mid}) OVER w AS nl, count(*) FILTER (h AND x >= {mid}) OVER w AS nr, max(hi) FILTER (h AND x < {mid}) OVER w AS hl, max(hi) FILTER (h AND x >= {mid}) OVER w AS hr, min(lo) FILTER (h AND x < {mid}) OVER w AS ll, min(lo) FILTER (h AND x >= {mid}) OVER w AS lr
          FROM (SELECT *, r IS NULL AND o AS h FROM ({rows})) WINDOW w AS (PARTITION BY region)))"""
    return f"SELECT region, line_no, conf, text, (row_number() OVER (PARTITION BY region ORDER BY coalesce(r, {levels}) DESC, trunc(y / 10), x, line_no) - 1)::INTEGER AS nth FROM ({rows})"


def findings() -> str:
    files = f"SELECT doc_id::VARCHAR AS path, text AS content FROM ({DOCS}) UNION ALL SELECT 'app.py', replace('{CODE.replace(chr(39), chr(39) * 2)}', '~', {NL})"
    lines = f"SELECT path, unnest(string_split(content, {NL})) AS code, unnest(range(len(string_split(content, {NL})))) + 1 AS line FROM ({files})"
    quote = lambda x: x.replace("'", "''")
    one = "SELECT path, line::INTEGER AS line, '{m}' AS message, '{s}' AS severity, {code} AS code FROM l WHERE regexp_matches(code, '{p}', 'i')"
    return f"WITH l AS ({lines}) " + " UNION ALL ".join(one.format(m=quote(m), s=s, p=quote(p), code=strip("code")) for p, m, s in RULES)


ELEMENTS_IN_ORDER = ELEMENT_CYCLE
