"""Queries of the general data problems: units, copies, hierarchies, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.compare import diff_copies
from ledgerloom.operators.hierarchy import hierarchy, table_links
from ledgerloom.operators.nested import SCHEMA, flatten, stated_values, unit_payloads
from ledgerloom.operators.units import changed_by_unit, judge_units, read_units, standardise_units, stated_part
from ledgerloom.plans.engine_queries import UNITS_SQL
from ledgerloom.runtime import stage, table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # by its definition only stated units count here, so nothing is predicted
    read = read_units(table(spark, sf_dir, "v_cell")).select("doc_id", "table_id", "row_id", "col_id", "value", "unit")
    return changed_by_unit(stated_part(stage(read)))


def p1_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record with its unit, where that comes from, the confidence and the value in the common unit."""
    standard, _ = standardise_units(table(spark, sf_dir, "v_cell"))
    return standard


def p1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the classifier finds units that were stated and are hidden from it."""
    return judge_units(table(spark, sf_dir, "v_cell"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    row_key, cell_key = ["doc_id", "table_id", "row_id"], ["doc_id", "table_id", "row_id", "col_id"]
    rows = diff_copies(table(spark, sf_dir, "row_dim"), table(spark, sf_dir, "row_serving"), row_key, ["canonical_leaf_id", "row_leaf_label"])
    cells = diff_copies(table(spark, sf_dir, "cell_fact"), table(spark, sf_dir, "cell_serving"), cell_key, ["value_num", "cell_state"])
    rows = rows.withColumn("col_id", F.lit(0)).withColumn("rel", F.lit("row_dim"))
    columns = ["rel", *cell_key, "finding"]
    return rows.select(columns).unionByName(cells.withColumn("rel", F.lit("cell_fact")).select(columns))


def _links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all three relations in one frame; the scope carries the relation in front."""
    sections = table(spark, sf_dir, "toc_section").select(F.concat(F.lit("toc_section|"), "doc_id").alias("scope"), F.col("section_id").alias("node"), F.col("parent_section").alias("parent"))
    places = table(spark, sf_dir, "geo_dim").select(F.lit("geo_dim|").alias("scope"), F.col("geo_key").alias("node"), F.col("parent_geo").alias("parent"))
    units = table(spark, sf_dir, "parsed").select("unit_id", "tables").dropDuplicates(["unit_id"])
    rows = table_links(units).withColumn("scope", F.concat(F.lit("parsed|"), "scope"))
    return sections.unionByName(places).unionByName(rows)


def p4_paths(spark: SparkSession, sf_dir: str, paths: bool = True) -> DataFrame:
    """Every node with its root, depth, path, interval of descendants and whether it is on a circle."""
    found = hierarchy(_links(spark, sf_dir), paths=paths)
    split = F.split("scope", r"\|", 2)
    return found.select(split[0].alias("rel"), split[1].alias("scope_id"), F.col("node").alias("node_id"), F.col("parent").alias("parent_id"), F.col("root").alias("root_id"), "depth", "entry", "exit", "descendants", "in_cycle", "path")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_paths(spark, sf_dir, paths=False).where("parent_id is not null").select("rel", "scope_id", "node_id", "root_id")


def p5_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All relations of the flattened units (units, tables, columns, rows, values, unreadable payloads)."""
    return flatten(unit_payloads(table(spark, sf_dir, "parsed"), table(spark, sf_dir, "parsed_raw")))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = unit_payloads(table(spark, sf_dir, "parsed"), table(spark, sf_dir, "parsed_raw"))
    return stated_values(flatten(payloads, ["value"]))


QUERIES = {f.__name__: f for f in (p1_found, p1_units, p1_quality, p2_found, p4_found, p4_paths, p5_found, p5_flat)}

_NO_FIELDS = ", ".join(f"NULL::VARCHAR AS {x.split()[0]}" for x in SCHEMA.split(", ")[5:])
_UNITS_SQL = r"""WITH u AS (SELECT unit_id, to_json({'tables': any_value(tables)})::VARCHAR payload FROM parsed GROUP BY unit_id
 UNION ALL SELECT unit_id, arg_max(payload, received_at) FROM parsed_raw GROUP BY unit_id),
b AS (SELECT unit_id, ltrim(payload, chr(65279)) p FROM u),
d AS (SELECT unit_id, CASE WHEN json_valid(p) THEN CASE WHEN json_type(p) = 'VARCHAR' THEN json_extract_string(p, '$') ELSE p END END p FROM b),
e AS (SELECT unit_id, p::JSON j FROM d WHERE json_valid(p)),
f AS (SELECT unit_id, coalesce(j -> 'extraction' -> 'tables', j -> 'tables') t FROM e),
g AS (SELECT unit_id, CASE WHEN json_type(t) = 'OBJECT' THEN json_array(t) ELSE t END t FROM f WHERE json_type(t) IN ('OBJECT', 'ARRAY')),
ta AS (SELECT unit_id, unnest(json_extract(t, '$[*]')) x, generate_subscripts(json_extract(t, '$[*]'), 1) - 1 a FROM g),
ro AS (SELECT unit_id, a, unnest(json_extract(x, '$.rows[*]')) y, generate_subscripts(json_extract(x, '$.rows[*]'), 1) - 1 b FROM ta),
va AS (SELECT unit_id, a, b, unnest(json_extract(y, '$.values[*]')) z, generate_subscripts(json_extract(y, '$.values[*]'), 1) - 1 c FROM ro)"""
_LINKS_SQL = """WITH RECURSIVE t AS (SELECT unit_id, unnest(tables) t, generate_subscripts(tables, 1) - 1 n FROM (SELECT unit_id, any_value(tables) tables FROM parsed GROUP BY 1)),
r AS (SELECT unit_id || ':' || n scope, unnest(t.rows) r, generate_subscripts(t.rows, 1) - 1 i FROM t),
r1 AS (SELECT scope, i, r.row_type y, r.level l, nullif(lower(trim(r.parent)), '') p, lower(trim(r.row_id)) k, lower(trim(r.label)) b, lead(r.level) OVER (PARTITION BY scope ORDER BY i) nl FROM r),
r2 AS (SELECT *, coalesce(coalesce(y, '') <> 'section_header' AND nl > l, false) h FROM r1),
r3 AS (SELECT *, CASE WHEN h THEN 'h' || sum(h::int) OVER (PARTITION BY scope ORDER BY i) END hn FROM r2),
pr AS (SELECT a.scope, a.i, a.p, coalesce((SELECT min(x.i) FROM r3 x WHERE x.scope = a.scope AND x.hn = a.p), (SELECT min(x.i) FROM r3 x WHERE x.scope = a.scope AND x.k = a.p), (SELECT max(x.i) FROM r3 x WHERE x.scope = a.scope AND x.b = a.p AND x.i < a.i)) q FROM r3 a),
l AS (SELECT 'parsed' rel, scope scope_id, i::VARCHAR node, coalesce(q::VARCHAR, '?' || p) parent FROM pr
 UNION ALL SELECT 'geo_dim', '', geo_key, min(parent_geo) FROM geo_dim GROUP BY geo_key
 UNION ALL SELECT 'toc_section', doc_id, section_id, min(parent_section) FROM toc_section GROUP BY doc_id, section_id)"""

ORACLES = {
    "p1_found": f"WITH {UNITS_SQL} SELECT DISTINCT doc_id, table_id, row_id, col_id FROM units JOIN factors ON code = unit_code WHERE value_num IS NOT NULL AND NOT isnan(value_num) AND value_num <> 0 AND value_num * factor <> value_num",
    "p2_found": """
WITH r1 AS (SELECT DISTINCT doc_id, table_id, row_id, nullif(canonical_leaf_id, '') c, nullif(row_leaf_label, '') l FROM row_dim),
r2 AS (SELECT DISTINCT doc_id, table_id, row_id, nullif(canonical_leaf_id, '') c, nullif(row_leaf_label, '') l FROM row_serving),
r AS (SELECT 'row_dim' rel, coalesce(r1.doc_id, r2.doc_id) doc_id, coalesce(r1.table_id, r2.table_id) table_id, coalesce(r1.row_id, r2.row_id) row_id, 0 col_id,
 CASE WHEN r2.doc_id IS NULL THEN ['only_in_first'] WHEN r1.doc_id IS NULL THEN ['only_in_second'] ELSE
 list_filter([CASE WHEN r1.c IS DISTINCT FROM r2.c THEN 'canonical_leaf_id' END, CASE WHEN r1.l IS DISTINCT FROM r2.l THEN 'row_leaf_label' END], lambda x: x IS NOT NULL) END f
 FROM r1 FULL JOIN r2 USING (doc_id, table_id, row_id)),
c1 AS (SELECT DISTINCT doc_id, table_id, row_id, col_id, CASE WHEN NOT isnan(value_num) THEN value_num END v, nullif(cell_state, '') s FROM cell_fact),
c2 AS (SELECT DISTINCT doc_id, table_id, row_id, col_id, CASE WHEN NOT isnan(value_num) THEN value_num END v, nullif(cell_state, '') s FROM cell_serving),
c AS (SELECT 'cell_fact' rel, coalesce(c1.doc_id, c2.doc_id) doc_id, coalesce(c1.table_id, c2.table_id) table_id, coalesce(c1.row_id, c2.row_id) row_id, coalesce(c1.col_id, c2.col_id) col_id,
 CASE WHEN c2.doc_id IS NULL THEN ['only_in_first'] WHEN c1.doc_id IS NULL THEN ['only_in_second'] ELSE
 list_filter([CASE WHEN c1.v IS DISTINCT FROM c2.v AND coalesce(abs(c1.v - c2.v) > 1e-9 * greatest(abs(c1.v), abs(c2.v)), true) THEN 'value_num' END, CASE WHEN c1.s IS DISTINCT FROM c2.s THEN 'cell_state' END], lambda x: x IS NOT NULL) END f
 FROM c1 FULL JOIN c2 USING (doc_id, table_id, row_id, col_id))
SELECT rel, doc_id, table_id, row_id, col_id, unnest(f) finding FROM (SELECT * FROM r UNION ALL SELECT * FROM c)
""",
    "p4_found": f"""
{_LINKS_SQL},
w AS (SELECT rel, scope_id, node, node at_node, parent, 0 steps FROM l WHERE parent IS NOT NULL
 UNION ALL SELECT w.rel, w.scope_id, w.node, l.node, l.parent, w.steps + 1 FROM w JOIN l ON l.rel = w.rel AND l.scope_id = w.scope_id AND l.node = w.parent WHERE w.steps < 60)
SELECT rel, scope_id, node node_id, CASE WHEN max(steps) >= 60 THEN '' ELSE arg_max(at_node, steps) END root_id FROM w GROUP BY rel, scope_id, node
""",
    "p4_paths": f"""
{_LINKS_SQL},
n AS (SELECT l.*, CASE WHEN u.node IS NOT NULL THEN l.parent END AS up FROM l LEFT JOIN l u ON u.rel = l.rel AND u.scope_id = l.scope_id AND u.node = l.parent WHERE l.node IS NOT NULL),
w AS (SELECT rel, scope_id, node, up AS at_node, 1 AS steps FROM n WHERE up IS NOT NULL UNION ALL SELECT w.rel, w.scope_id, w.node, n.up, w.steps + 1 FROM w JOIN n ON n.rel = w.rel AND n.scope_id = w.scope_id AND n.node = w.at_node WHERE n.up IS NOT NULL AND w.steps < 60),
y AS (SELECT rel, scope_id, node, min(at_node) AS low FROM w GROUP BY 1, 2, 3 HAVING bool_or(at_node = node)),
c AS (SELECT n.*, y.node IS NOT NULL AS in_cycle, CASE WHEN y.low IS DISTINCT FROM n.node THEN up END AS cut FROM n LEFT JOIN y USING (rel, scope_id, node)),
d AS (SELECT rel, scope_id, node, [node] AS way FROM c WHERE cut IS NULL UNION ALL SELECT c.rel, c.scope_id, c.node, list_append(d.way, c.node) FROM d JOIN c ON c.rel = d.rel AND c.scope_id = d.scope_id AND c.cut = d.node),
o AS (SELECT *, row_number() OVER (PARTITION BY rel, scope_id ORDER BY way) - 1 AS pre, len(way) - 1 AS depth FROM d), b AS (SELECT rel, scope_id, above AS node, count(*) AS below FROM (SELECT rel, scope_id, unnest(way[:-2]) AS above FROM d) GROUP BY 1, 2, 3)
SELECT o.rel, o.scope_id, o.node AS node_id, c.parent AS parent_id, CASE WHEN r.in_cycle THEN '' ELSE way[1] END AS root_id, depth::INT AS depth, 2 * pre - depth AS entry, 2 * pre - depth + 2 * coalesce(below, 0) + 1 AS "exit", coalesce(below, 0) AS descendants, c.in_cycle, array_to_string(way, ' > ') AS path
FROM o JOIN c ON c.rel = o.rel AND c.scope_id = o.scope_id AND c.node = o.node JOIN c r ON r.rel = o.rel AND r.scope_id = o.scope_id AND r.node = way[1] LEFT JOIN b ON b.rel = o.rel AND b.scope_id = o.scope_id AND b.node = o.node
""",
    "p5_found": f"""
{_UNITS_SQL}
SELECT unit_id, a::INT table_no, b::INT row_no, c::INT col_no FROM va WHERE nullif(CASE WHEN json_type(z) = 'OBJECT' THEN json_extract_string(z, '$.value') WHEN json_type(z) <> 'NULL' THEN json_extract_string(z, '$') END, '') IS NOT NULL
""",
    "p5_flat": f"""
{_UNITS_SQL},
co AS (SELECT unit_id, a, unnest(json_extract(x, '$.columns[*]')) y, generate_subscripts(json_extract(x, '$.columns[*]'), 1) - 1 b FROM ta)
SELECT 'unit' AS rel, unit_id, NULL::INT AS table_no, NULL::INT AS row_no, NULL::INT AS col_no, {_NO_FIELDS} FROM e WHERE json_type(j) = 'OBJECT'
UNION ALL SELECT 'unreadable', unit_id, NULL, NULL, NULL, {_NO_FIELDS} FROM u WHERE unit_id NOT IN (SELECT unit_id FROM e WHERE json_type(j) = 'OBJECT')
UNION ALL SELECT 'table', unit_id, a, NULL, NULL, x ->> 'title', x ->> 'label_header', x ->> 'continued_from_previous', x ->> 'section_id', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM ta
UNION ALL SELECT 'column', unit_id, a, NULL, b, NULL, NULL, NULL, NULL, y ->> 'group', y ->> 'leaf', NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM co
UNION ALL SELECT 'row', unit_id, a, b, NULL, NULL, NULL, NULL, NULL, NULL, NULL, y ->> 'row_id', y ->> 'row_type', y ->> 'level', y ->> 'parent', y ->> 'label', NULL, NULL FROM ro
UNION ALL SELECT 'value', unit_id, a, b, c, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN json_type(z) = 'OBJECT' THEN z ->> 'value' WHEN json_type(z) <> 'NULL' THEN z ->> '$' END, CASE WHEN json_type(z) = 'OBJECT' THEN z ->> 'cell_state' END FROM va
""",
}
