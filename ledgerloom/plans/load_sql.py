"""The loader in DuckDB's SQL, step by step, for tables that are neither stacked nor continued: what load queries are held against."""

from __future__ import annotations

from ledgerloom.functions.periods import BESIDE, UNIT_TOKENS
from ledgerloom.operators.load import ENTITIES, MASTHEAD, NO_WORDS
from ledgerloom.plans import sql as Q

_K = "doc_id, table_no"
_words = lambda x: f"list_filter(regexp_split_to_array(lower(coalesce({x}, '')), '[^a-z0-9]+'), lambda w: w <> '')"
_MAST = "[" + ", ".join(f"'{w}'" for w in MASTHEAD) + "]"
_ENTITY = "entities(k, entity) AS (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in ENTITIES.items()) + ")"

TABLES = f"""u AS (SELECT unit_id, any_value(doc_id) doc_id, any_value(tables) tables FROM parsed GROUP BY 1), t0 AS (SELECT unit_id, doc_id, unnest(tables) t, generate_subscripts(tables, 1) AS pos FROM u),
t1 AS (SELECT t0.doc_id, (row_number() OVER (PARTITION BY t0.doc_id ORDER BY unit_id, pos))::INT table_no, unit_id, t, institution, doc_period FROM t0 LEFT JOIN filing f ON f.doc_id = t0.doc_id WHERE t IS NOT NULL),
t2 AS (SELECT *, len({_words('t.title')}) > 0 AND len({_words('t.label_header')}) > 0 AND len(list_filter({_words('t.title')}, lambda w: NOT list_contains(list_concat({_words('institution')}, {_MAST}), w))) = 0 AS mast FROM t1),
tb AS (SELECT doc_id, table_no, unit_id, institution, doc_period, CASE WHEN mast THEN t.label_header ELSE t.title END AS title, CASE WHEN mast THEN t.title ELSE t.label_header END AS label_header, t.section_id AS section_id, coalesce(t.continued_from_previous, false) AS continued, t.columns AS cols, t.rows AS rws FROM t2)"""

#: What labels name, then who of a pool (source: doc_id, table_no, id, label) counts for what.
MEMBERS = f"""mx AS (SELECT {Q.label_key('row_leaf_label')} AS mk, segment_key AS s, industry_key AS i, geo_key AS g FROM row_dim UNION ALL SELECT {Q.label_key('label')}, NULL, NULL, geo_key FROM geo_dim),
mm AS (SELECT mk, CASE WHEN min(s) = max(s) THEN min(s) END AS s, CASE WHEN min(i) = max(i) THEN min(i) END AS i, CASE WHEN min(g) = max(g) THEN min(g) END AS g FROM mx WHERE mk <> '' GROUP BY mk)"""


def exclusive(source: str, out: str) -> str:
    return f"""{out}l AS (SELECT x.*, s, i, g, coalesce(s <> 'SEG_TOTAL', false)::INT AS ms, coalesce(i <> 'IND_TOTAL', false)::INT AS mi, coalesce(g <> 'GLOBAL', false)::INT AS mg, (s IS NOT NULL)::INT + (i IS NOT NULL)::INT + (g IS NOT NULL)::INT AS n FROM {source} x LEFT JOIN mm ON mk = {Q.label_key('label')}),
{out}c AS (SELECT {_K}, count(*) FILTER (n = 1 AND ms = 1) AS ns, count(*) FILTER (n = 1 AND mi = 1) AS ni, count(*) FILTER (n = 1 AND mg = 1) AS ng FROM {out}l GROUP BY ALL),
{out}h AS (SELECT a.*, ms + mi + mg > 1 AS several, (ms = 1 AND ns >= 2)::INT AS hs, (mi = 1 AND ni >= 2)::INT AS hi, (mg = 1 AND ng >= 2)::INT AS hg FROM {out}l a JOIN {out}c USING ({_K})),
{out} AS (SELECT {_K}, id, label, CASE WHEN NOT several OR (hs = 1 AND hi + hg = 0) THEN s END AS seg, CASE WHEN NOT several OR (hi = 1 AND hs + hg = 0) THEN i END AS ind, CASE WHEN NOT several OR (hg = 1 AND hs + hi = 0) THEN g END AS geo, several AND hs + hi + hg <> 1 AS ambiguous FROM {out}h)"""


_NO_WORDS = ", ".join(f"'{w}'" for w in sorted(NO_WORDS | BESIDE | UNIT_TOKENS))
_END, _SPAN = Q.clamped("CASE WHEN own THEN leaf ELSE banner END", "CASE WHEN own THEN own_fin ELSE fin END", "CASE WHEN own THEN own_span ELSE span END", "doc_period")
COLUMNS = f"""{_ENTITY}, c0 AS (SELECT {_K}, doc_period, unnest(cols) col, generate_subscripts(cols, 1)::INT AS col_id FROM tb),
c1 AS (SELECT {_K}, doc_period, col_id, CASE WHEN NOT coalesce({Q.squeeze('lower(col."group")')} = {Q.squeeze('lower(col.leaf)')}, false) THEN col."group" END AS banner, col.leaf AS leaf FROM c0),
{Q.period('c1', 'leaf', 'pl', True)}, 
pw AS (SELECT *, nullif(array_to_string(list_filter(string_split(rest, ' '), lambda w: regexp_matches(w, '[a-z0-9]') AND NOT w IN ({_NO_WORDS})), ' '), '') AS words FROM pl), pg AS (SELECT *, words IS NOT NULL AND (SELECT count(DISTINCT words) FROM pw x WHERE x.doc_id = pw.doc_id AND x.table_no = pw.table_no) > 1 AS gap FROM pw),
c2 AS (SELECT * EXCLUDE (fin, span, rest, words), fin AS own_fin, span AS own_span, rest IS NOT NULL AND NOT gap AS own FROM pg), {Q.period('c2', 'banner', 'pb', True)},
c3 AS (SELECT *, min(col_id) OVER (PARTITION BY {_K}, banner) AS first_of FROM pb),
c4 AS (SELECT {_K}, col_id, banner, leaf, CASE WHEN banner IS NOT NULL THEN (dense_rank() OVER (PARTITION BY {_K} ORDER BY banner IS NULL, first_of) + 99)::INT END AS banner_id, CASE WHEN own OR rest IS NOT NULL THEN {_END} END AS period, CASE WHEN own OR rest IS NOT NULL THEN {_SPAN} END AS period_span,
 coalesce((SELECT entity FROM entities WHERE k = {Q.squeeze(f"lower({Q.plain('banner')})")}), (SELECT entity FROM entities WHERE k = regexp_extract(lower({Q.squeeze(Q.plain('leaf'))}), '^(the (group|bank|company))\\b', 1))) AS legal_entity,
 CASE WHEN regexp_matches(leaf, '^\\s*(\\+\\s*/\\s*\\(?-\\)?|change|movement|variance|% chg)', 'i') THEN 'derived' WHEN regexp_matches(leaf, '^\\s*notes?\\s*$', 'i') THEN 'reference' END AS col_role, gap FROM c3),
cp AS (SELECT {_K}, col_id AS id, leaf AS label FROM c4 UNION ALL SELECT DISTINCT {_K}, banner_id, banner FROM c4 WHERE banner_id IS NOT NULL), {exclusive('cp', 'ce')},
co AS (SELECT c4.*, coalesce(a.seg, b.seg) AS segment_key, coalesce(a.ind, b.ind) AS industry_key, coalesce(a.geo, b.geo) AS geo_key, a.ambiguous, coalesce(b.ambiguous, false) AS banner_ambiguous FROM c4 LEFT JOIN ce a ON a.doc_id = c4.doc_id AND a.table_no = c4.table_no AND a.id = c4.col_id LEFT JOIN ce b ON b.doc_id = c4.doc_id AND b.table_no = c4.table_no AND b.id = c4.banner_id)"""

_REND, _RSPAN = Q.clamped("label", "fin", "span", "doc_period")
_HEAD = "coalesce(row_type IN ('section_header', 'sub_header'), false)"
ROWS = f"""r0 AS (SELECT {_K}, doc_period, unnest(rws) r, generate_subscripts(rws, 1)::INT AS row_id FROM tb), r1 AS (SELECT {_K}, doc_period, row_id, r.row_id AS line_no, r.row_type AS row_type, coalesce(r.level, 0) AS level, r.parent AS parent, r.label AS label, r."values" AS vals FROM r0),
{Q.period('r1', 'label', 'rp', True)}, r2 AS (SELECT *, CASE WHEN {Q.mere_period('rest', True)} THEN {{'fin': {_REND}, 'span': {_RSPAN}}} END AS k FROM rp),
r3 AS (SELECT *, last_value(CASE WHEN {_HEAD} THEN k END IGNORE NULLS) OVER (PARTITION BY {_K} ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM r2),
rq AS (SELECT {_K}, row_id AS id, label FROM r1), {exclusive('rq', 're')},
ro AS (SELECT r3.doc_id, r3.table_no, row_id, line_no, row_type, level, parent, r3.label, {Q.squeeze(Q.strip_footnotes(Q.plain('r3.label')))} AS label_clean, vals, k.fin AS period, k.span AS period_span, CASE WHEN NOT ({_HEAD} AND k IS NOT NULL) THEN b.fin END AS banner_period, CASE WHEN NOT ({_HEAD} AND k IS NOT NULL) THEN b.span END AS banner_span, seg AS segment_key, ind AS industry_key, geo AS geo_key, ambiguous FROM r3 JOIN re ON re.doc_id = r3.doc_id AND re.table_no = r3.table_no AND re.id = row_id)"""

FACTS = f"""wi AS (SELECT {_K}, max(col_id) AS width FROM co GROUP BY ALL), sz AS (SELECT ro.*, coalesce(len(vals), 0) AS n, coalesce(width, 0) AS width FROM ro LEFT JOIN wi USING ({_K})),
x0 AS (SELECT {_K}, row_id, unnest(vals) v, generate_subscripts(vals, 1)::INT AS col_id FROM sz WHERE n <= width AND coalesce(row_type, 'data') NOT IN ('section_header', 'sub_header', 'note')), {Q.period('tb', 'title', 'tt', False)},
x1 AS (SELECT x0.doc_id, x0.table_no, x0.row_id, x0.col_id, v.value AS value_raw, co.* EXCLUDE (doc_id, table_no, col_id, period, period_span), co.period AS c_period, co.period_span AS c_span, ro.label, ro.period AS r_period, ro.period_span AS r_span, banner_period, banner_span, ro.segment_key AS r_seg, ro.industry_key AS r_ind, ro.geo_key AS r_geo, tt.fin AS t_period, tt.span AS t_span, doc_period, title
 FROM x0 JOIN co USING ({_K}, col_id) JOIN ro USING ({_K}, row_id) JOIN tt USING ({_K})),
x2 AS (SELECT *, {Q.unit_of_cell('value_raw')} AS u1, {Q.unit_of_label('label')} AS u2, {Q.unit_of_heading('leaf')} AS u3, {Q.unit_of_label('title')} AS u4 FROM x1),
x3 AS (SELECT *, coalesce(u1, CASE WHEN u2 = 'percent' THEN u2 END, u3, u2, u4) AS stated, CASE WHEN c_period IS NOT NULL THEN 'col' WHEN r_period IS NOT NULL THEN 'row' WHEN banner_period IS NOT NULL THEN 'row_banner' WHEN t_period IS NOT NULL THEN 'table_title' WHEN doc_period IS NOT NULL THEN 'document' END AS period_source FROM x2),
x4 AS (SELECT *, CASE period_source WHEN 'col' THEN c_period WHEN 'row' THEN r_period WHEN 'row_banner' THEN banner_period WHEN 'table_title' THEN t_period ELSE doc_period END AS period, CASE period_source WHEN 'col' THEN c_span WHEN 'row' THEN r_span WHEN 'row_banner' THEN banner_span WHEN 'table_title' THEN t_span END AS period_span FROM x3),
vo AS (SELECT doc_id, stated, count(DISTINCT table_no) n FROM x4 WHERE stated IS NOT NULL GROUP BY 1, 2), mo AS (SELECT doc_id, CASE WHEN count(*) = 1 THEN min(stated) END AS modal FROM vo v WHERE n = (SELECT max(n) FROM vo w WHERE w.doc_id = v.doc_id) GROUP BY 1),
wn AS (SELECT {_K}, max(c_period) AS col_period FROM x1 GROUP BY ALL),
ta AS (SELECT tt.doc_id, tt.table_no, unit_id, institution, doc_period, title, label_header, section_id, continued, col_period, coalesce(fin, col_period, doc_period) AS table_period, concat_ws('|', coalesce(section_id, ''), trim(regexp_replace(lower(title), '[^a-z0-9]+', '_', 'g'), '_'), coalesce(fin, col_period, doc_period)::VARCHAR) AS table_id FROM tt LEFT JOIN wn USING ({_K})),
fa AS (SELECT x4.doc_id, x4.table_no, row_id, col_id, value_raw, {Q.number('value_raw')} AS value_num, {Q.state('value_raw')} AS cell_state, coalesce(stated, modal) AS unit, stated, period, period_span, period_source, {Q.starts('period_span', 'period')} AS period_start, coalesce(legal_entity, 'CONSOLIDATED') AS legal_entity,
 coalesce(r_seg, segment_key, 'SEG_TOTAL') AS segment_key, coalesce(r_ind, industry_key, 'IND_TOTAL') AS industry_key, coalesce(r_geo, geo_key, 'GLOBAL') AS geo_key, col_role FROM x4 LEFT JOIN mo USING (doc_id))"""

_NUM = "coalesce(value_num, 0.0)"
#: Totals: blocks between breaks, plain sums, then every way of signs.
SUMS = f"""b0 AS (SELECT {_K}, row_id, level, coalesce(row_type, 'data') AS kind FROM ro), b1 AS (SELECT *, kind IN ('section_header', 'sub_header', 'total') AS breaks FROM b0), b2 AS (SELECT *, coalesce(sum(breaks::INT) OVER (PARTITION BY {_K} ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM b1),
ac AS (SELECT {_K}, col_id FROM co WHERE coalesce({Q.unit_of_heading('leaf')}, '') NOT IN ('percent', '%')), at_ AS (SELECT DISTINCT {_K} FROM ac),
to0 AS (SELECT {_K}, row_id AS total, grp FROM b2 JOIN at_ USING ({_K}) WHERE kind = 'total'),
da AS (SELECT t.doc_id, t.table_no, total, b.row_id, b.level FROM to0 t JOIN b2 b ON b.doc_id = t.doc_id AND b.table_no = t.table_no AND b.grp = t.grp AND NOT b.breaks AND b.kind <> 'note'),
dm AS (SELECT {_K}, total, row_id FROM da QUALIFY level = min(level) OVER (PARTITION BY {_K}, total)),
ca AS (SELECT t.doc_id, t.table_no, t.total, b.row_id FROM to0 t JOIN b2 b ON b.doc_id = t.doc_id AND b.table_no = t.table_no AND b.kind = 'total' AND b.grp = t.grp - 1),
me AS (SELECT *, true AS data FROM dm UNION ALL SELECT *, false FROM ca), mn AS (SELECT {_K}, total, count(*) AS members, count(*) FILTER (data) AS datas FROM me GROUP BY ALL),
go AS (SELECT t.doc_id, t.table_no, t.total, f.col_id, f.value_num AS goal FROM to0 t JOIN fa f ON f.doc_id = t.doc_id AND f.table_no = t.table_no AND f.row_id = t.total JOIN ac a ON a.doc_id = f.doc_id AND a.table_no = f.table_no AND a.col_id = f.col_id WHERE f.value_num IS NOT NULL),
mv AS (SELECT m.doc_id, m.table_no, m.total, m.row_id, data, g.col_id, goal, {_NUM} AS v FROM me m JOIN go g USING ({_K}, total) LEFT JOIN fa f ON f.doc_id = m.doc_id AND f.table_no = m.table_no AND f.row_id = m.row_id AND f.col_id = g.col_id),
pl_ AS (SELECT {_K}, total, col_id, any_value(goal) goal, sum(v) FILTER (data) s FROM mv GROUP BY ALL), ok AS (SELECT {_K}, total, bool_and(coalesce(abs(s - goal) <= datas, false)) AND max(datas) > 0 AS plain FROM pl_ JOIN mn USING ({_K}, total) GROUP BY ALL),
lv AS (SELECT {_K}, total, row_id, row_number() OVER (PARTITION BY {_K}, total ORDER BY row_id) - 1 AS bit FROM (SELECT {_K}, total, row_id FROM mv JOIN ok USING ({_K}, total) WHERE NOT plain GROUP BY ALL HAVING bool_or(v <> 0))),
ln AS (SELECT {_K}, total, count(*) AS live FROM lv GROUP BY ALL),
ma AS (SELECT {_K}, total, live, unnest(generate_series(0, (1 << live) - 1)) AS mask FROM ln WHERE live <= 14),
ms_ AS (SELECT ma.doc_id, ma.table_no, ma.total, mask, col_id, any_value(goal) goal, sum(CASE WHEN (mask >> bit) & 1 = 1 THEN -v ELSE v END) s FROM ma JOIN lv USING ({_K}, total) JOIN mv USING ({_K}, total, row_id) GROUP BY ALL),
wy AS (SELECT {_K}, total, mask FROM ms_ JOIN mn USING ({_K}, total) GROUP BY {_K}, total, mask HAVING bool_and(abs(s - goal) <= members)), wc AS (SELECT {_K}, total, count(*) AS ways, min(mask) AS mask FROM wy GROUP BY ALL),
su AS (SELECT {_K}, row_id, total AS sums_to, 1 AS sums_sign, 'added' AS outcome FROM dm JOIN ok USING ({_K}, total) WHERE plain
 UNION ALL SELECT me.doc_id, me.table_no, me.row_id, me.total, CASE WHEN (mask >> bit) & 1 = 1 THEN -1 ELSE 1 END, 'signed' FROM me JOIN wc USING ({_K}, total) LEFT JOIN lv USING ({_K}, total, row_id) WHERE ways = 1
 UNION ALL SELECT mn.doc_id, mn.table_no, mn.total, NULL, NULL, CASE WHEN ok.plain IS NULL THEN 'only ratios' WHEN coalesce(live, 0) > 14 THEN 'too large' ELSE coalesce(ways, 0) || ' ways' END FROM mn LEFT JOIN ok USING ({_K}, total) LEFT JOIN ln USING ({_K}, total) LEFT JOIN wc USING ({_K}, total) WHERE ok.plain IS NULL OR (NOT ok.plain AND coalesce(ways, 0) <> 1))"""

#: Parents: what a row names, if it is shallower, else the nearest row of the level above.
PARENTS = f"""n0 AS (SELECT {_K}, row_id, level, row_type, nullif(lower(trim(parent)), '') AS p, lower(trim(line_no)) AS k, lower(trim(label)) AS l FROM ro), raw_levels AS (SELECT {_K}, row_id, r.level AS lv FROM r0),
n1 AS (SELECT n0.*, coalesce(coalesce(row_type, '') <> 'section_header' AND lead(lv) OVER w > lv, false) AS heads FROM n0 JOIN raw_levels USING ({_K}, row_id) WINDOW w AS (PARTITION BY {_K} ORDER BY row_id)), n2 AS (SELECT *, CASE WHEN heads THEN 'h' || sum(heads::INT) OVER (PARTITION BY {_K} ORDER BY row_id) END AS hn FROM n1),
n3 AS (SELECT a.doc_id, a.table_no, a.row_id, a.level, a.row_type, coalesce((SELECT min(x.row_id) FROM n2 x WHERE x.doc_id = a.doc_id AND x.table_no = a.table_no AND x.hn = regexp_replace(a.p, '^h0*([1-9][0-9]*)$', 'h\\1')), (SELECT min(x.row_id) FROM n2 x WHERE x.doc_id = a.doc_id AND x.table_no = a.table_no AND x.k = a.p AND x.k <> ''), (SELECT max(x.row_id) FROM n2 x WHERE x.doc_id = a.doc_id AND x.table_no = a.table_no AND x.l = a.p AND x.row_id < a.row_id)) AS up FROM n2 a),
ad AS (SELECT DISTINCT {_K}, sums_to AS row_id, true AS adds FROM su WHERE sums_to IS NOT NULL), e0 AS (SELECT n3.*, coalesce(row_type, 'data') AS kind, coalesce(lead(level) OVER (PARTITION BY {_K} ORDER BY row_id) > level AND adds IS NULL, false) AS heads FROM n3 LEFT JOIN ad USING ({_K}, row_id)),
e1 AS (SELECT *, kind <> 'total' OR heads AS may FROM e0),
e2 AS (SELECT a.doc_id, a.table_no, a.row_id, max(CASE WHEN b.may THEN b.row_id END) AS notes, max(CASE WHEN b.may AND b.kind <> 'note' THEN b.row_id END) AS data FROM e1 a LEFT JOIN e1 b ON b.doc_id = a.doc_id AND b.table_no = a.table_no AND b.row_id < a.row_id AND b.level = a.level - 1 GROUP BY ALL),
pa AS (SELECT a.doc_id, a.table_no, a.row_id, CASE WHEN p.level < a.level THEN a.up WHEN a.kind = 'note' THEN notes ELSE data END AS row_parent FROM e1 a JOIN e2 USING ({_K}, row_id) LEFT JOIN e1 p ON p.doc_id = a.doc_id AND p.table_no = a.table_no AND p.row_id = a.up)"""

_TO_FACTS = f"{Q.SPELT}, {TABLES}, {MEMBERS}, {COLUMNS}, {ROWS}, {FACTS}"
_AXES = "segment_key, industry_key, geo_key"
CELLS_SQL = f"WITH {_TO_FACTS} SELECT fa.* EXCLUDE (stated), table_id FROM fa JOIN ta USING ({_K})"
COLUMNS_SQL = f"WITH {TABLES}, {MEMBERS}, {COLUMNS} SELECT {_K}, col_id, banner, leaf, banner_id, period, period_span, legal_entity, col_role, {_AXES} FROM co"
TABLES_SQL = f"WITH {_TO_FACTS} SELECT * FROM ta"
SUMS_SQL = f"WITH {_TO_FACTS}, {SUMS} SELECT * FROM su"
ROWS_SQL = f"""WITH {_TO_FACTS}, {SUMS}, {PARENTS} SELECT ro.doc_id, ro.table_no, ro.row_id, line_no, row_type, level, label, label_clean, period, period_span, banner_period, banner_span, {_AXES}, row_parent, sums_to, sums_sign, {Q.label_key('label')} AS label_key
FROM ro JOIN pa USING ({_K}, row_id) LEFT JOIN (SELECT * FROM su WHERE sums_to IS NOT NULL) USING ({_K}, row_id)"""
WARNINGS_SQL = f"""WITH {_TO_FACTS}, {SUMS} SELECT {_K}, 'row ' || row_id || ' is wider than the heading' AS warning FROM sz WHERE n > width AND n > 0
UNION ALL SELECT {_K}, 'table id comes twice: ' || table_id FROM ta QUALIFY count(*) OVER (PARTITION BY doc_id, table_id) > 1
UNION ALL SELECT {_K}, 'label names members of several axes: ' || label FROM (SELECT DISTINCT {_K}, label FROM re WHERE ambiguous UNION SELECT DISTINCT {_K}, leaf FROM co WHERE ambiguous UNION SELECT DISTINCT {_K}, banner FROM co WHERE banner_ambiguous)
UNION ALL SELECT {_K}, 'heading is a period beside words of its own: ' || leaf FROM co WHERE gap
UNION ALL SELECT {_K}, 'filing''s period is not among the table''s, latest ' || table_period FROM ta WHERE doc_period IS NOT NULL AND table_period <> doc_period AND (SELECT count(*) FROM co WHERE co.doc_id = ta.doc_id AND co.table_no = ta.table_no AND co.period IS NOT NULL) > 0 AND NOT EXISTS (SELECT 1 FROM co WHERE co.doc_id = ta.doc_id AND co.table_no = ta.table_no AND co.period = ta.doc_period) AND NOT EXISTS (SELECT 1 FROM tt WHERE tt.doc_id = ta.doc_id AND tt.table_no = ta.table_no AND tt.fin IS NOT NULL)
UNION ALL SELECT {_K}, 'total ' || row_id || ' not verified: ' || outcome FROM su WHERE sums_to IS NULL"""
COLUMN_SUMS_SQL = f"""WITH {_TO_FACTS}, h AS (SELECT {_K}, min(col_id) AS total_col FROM co WHERE trim(lower(leaf)) = 'total' GROUP BY ALL), s AS (SELECT fa.doc_id, fa.table_no, total_col, row_id, max(value_num) FILTER (col_id = total_col) AS total, sum(value_num) FILTER (col_id <> total_col) AS parts, count(*) FILTER (col_id <> total_col) AS n FROM fa JOIN h USING ({_K}) WHERE value_num IS NOT NULL GROUP BY ALL)
SELECT doc_id, table_no::VARCHAR AS table_id, total_col, count(*) AS "rows", count(*) FILTER (abs(parts - total) <= greatest(1, n)) AS agreeing, bool_and(abs(parts - total) <= greatest(1, n)) AS reconciled FROM s WHERE total IS NOT NULL AND n > 0 GROUP BY ALL"""
BREAKDOWNS_SQL = f"""WITH {_TO_FACTS}, {SUMS}, f AS (SELECT {_K}, row_id, col_id, value_num FROM fa WHERE value_num IS NOT NULL AND coalesce(unit, '') <> 'percent'), s AS (SELECT f.doc_id, f.table_no, sums_to AS row_id, col_id, sum(sums_sign * value_num) AS "sum", count(*) AS n FROM su JOIN f USING ({_K}, row_id) WHERE sums_to IS NOT NULL GROUP BY ALL)
SELECT s.*, f.value_num FROM s JOIN f USING ({_K}, row_id, col_id) WHERE abs("sum" - value_num) > greatest(n, 1) + 1"""
_PLAIN_TABLES = """u AS (SELECT unit_id, any_value(doc_id) doc_id, any_value(tables) tables FROM parsed GROUP BY 1), t0 AS (SELECT unit_id, doc_id, unnest(tables) t, generate_subscripts(tables, 1) AS pos FROM u),
tb AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY unit_id, pos))::INT AS table_no, t.title AS title, t.columns AS cols, t.rows AS rws FROM t0 WHERE t IS NOT NULL)"""
DATE_BLOCKS_SQL = f"""WITH {_PLAIN_TABLES}, r0 AS (SELECT {_K}, unnest(rws) r, generate_subscripts(rws, 1)::INT AS row_id FROM tb), r1 AS (SELECT {_K}, row_id, r.row_type AS row_type, r.label AS label, coalesce(len(list_filter(r."values", lambda v: coalesce(trim(v.value) <> '', false))) > 0, false) AS valued FROM r0), {Q.period('r1', 'label', 'rp', True)},
h AS (SELECT *, coalesce(row_type IN ('section_header', 'sub_header') AND NOT valued AND {Q.mere_period('rest')}, false) AS head FROM rp), b AS (SELECT *, sum(head::INT) OVER w AS blk, last_value(CASE WHEN head THEN label END IGNORE NULLS) OVER w AS cap FROM h WINDOW w AS (PARTITION BY {_K} ORDER BY row_id)),
n AS (SELECT {_K}, max(blk) AS n, bool_and(has) FILTER (blk > 0) AS each FROM (SELECT {_K}, blk, bool_or(NOT head AND valued) AS has FROM b GROUP BY ALL) GROUP BY ALL)
SELECT b.doc_id, b.table_no, row_id, CASE WHEN n >= 2 AND each THEN blk ELSE 0 END AS block, CASE WHEN n >= 2 AND each THEN cap END AS caption FROM b JOIN n USING ({_K})"""
_BARE = Q.label_key("regexp_replace(title, '\\s*\\(?\\s*(continued|cont''?d\\.?)\\s*\\)?\\s*', ' ', 'gi')")
_HEADS = "list_transform(cols, lambda x: concat_ws('|', " + Q.label_key('x."group"') + ", " + Q.label_key("x.leaf") + "))"
#: Continued tables: a chain's rows one after the other; headings that come twice in a table are not told apart here.
WHOLE_SQL = f"""WITH {_PLAIN_TABLES}, b AS (SELECT *, {_BARE} AS bare, coalesce(regexp_matches(title, '\\(?(continued|cont''?d)', 'i'), false) AS marked, {_HEADS} AS heads FROM tb),
g AS (SELECT *, coalesce(marked AND bare = lag(bare) OVER w AND len(list_filter(heads, lambda x: NOT list_contains(lag(heads) OVER w, x))) = 0, false) AS goes_on FROM b WINDOW w AS (PARTITION BY doc_id ORDER BY table_no)), f AS (SELECT *, last_value(CASE WHEN NOT goes_on THEN table_no END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY table_no) AS first_no FROM g)
SELECT doc_id, first_no AS table_no, first(title ORDER BY table_no) AS title, coalesce(sum(len(rws)), 0)::INT AS "rows", count(*) AS parts FROM f GROUP BY doc_id, first_no"""
