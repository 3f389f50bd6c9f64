"""The metrics layer over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.labels import caption_key, caption_parts, filing_family
from ledgerloom.operators import metrics as M
from ledgerloom.plans import sql as Q
from ledgerloom.runtime import BROADCAST_ROWS, stage, table

QUERIES, ORACLES = {}, {}
c = F.col
_CELL = "v AS (SELECT DISTINCT * FROM v_cell)"
#: Trust in where a record's identity comes from. Fixed values.
TIERS = {"human_anchor": 0, "masterlist": 1, "alias": 2, "llm": 3}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "v_cell").dropDuplicates(["doc_id", "table_id", "row_id", "col_id"])


def _built(spark: SparkSession, d: str) -> DataFrame:
    tier = F.lit(4)
    for name, rank in TIERS.items():
        tier = F.when(c("identity_source") == name, rank).otherwise(tier)
    defaults = {"segment_key": "SEG_TOTAL", "geo_key": "GLOBAL", "industry_key": "IND_TOTAL", "legal_entity": "CONSOLIDATED"}
    rows = _cells(spark, d).where("concept_key is not null").withColumns({k: F.coalesce(k, F.lit(v)) for k, v in defaults.items()})
    rows = rows.select(*M.GRAIN, "value_num", "unit", tier.alias("tier"), c("row_hierarchy").alias("depth"), (tier == 0).alias("anchored"), F.concat_ws("/", "doc_id", "table_id", F.lpad(c("row_id").cast("string"), 6, "0"), F.lpad(c("col_id").cast("string"), 6, "0")).alias("place"))
    return M.resolve_candidates(rows)


_G = ", ".join(M.GRAIN)
_BUILT = f"""{_CELL}, a0 AS (SELECT institution, concept_key, period, period_span, coalesce(segment_key, 'SEG_TOTAL') segment_key, coalesce(geo_key, 'GLOBAL') geo_key, coalesce(industry_key, 'IND_TOTAL') industry_key, coalesce(legal_entity, 'CONSOLIDATED') legal_entity, value_num, unit,
 CASE identity_source WHEN 'human_anchor' THEN 0 WHEN 'masterlist' THEN 1 WHEN 'alias' THEN 2 WHEN 'llm' THEN 3 ELSE 4 END tier, row_hierarchy depth, doc_id || '/' || table_id || '/' || lpad(row_id::VARCHAR, 6, '0') || '/' || lpad(col_id::VARCHAR, 6, '0') place FROM v WHERE concept_key IS NOT NULL AND value_num IS NOT NULL AND NOT isnan(value_num)),
a1 AS (SELECT *, bool_or(tier = 0) OVER (PARTITION BY {_G}) anchored FROM a0), a2 AS (SELECT * FROM a1 WHERE NOT anchored OR tier = 0),
s AS (SELECT {_G}, abs(value_num) size, count(*) n, min(tier) tier, min(depth) depth, sum(sign(value_num)) signs, first(unit ORDER BY tier, place) unit FROM a2 GROUP BY ALL),
s1 AS (SELECT *, CASE WHEN size - lag(size) OVER (PARTITION BY {_G} ORDER BY size) > 1.0 THEN 1 ELSE 0 END fresh FROM s), s2 AS (SELECT *, sum(fresh) OVER (PARTITION BY {_G} ORDER BY size) cluster FROM s1),
k AS (SELECT {_G}, cluster, first(size ORDER BY n DESC, size) size, first(unit ORDER BY n DESC, size) unit, sum(n)::BIGINT n, min(tier) tier, min(depth) depth, sum(signs) signs FROM s2 GROUP BY ALL),
w AS (SELECT *, row_number() OVER (PARTITION BY {_G} ORDER BY tier, depth NULLS LAST, n DESC, size DESC) place, sum(n) OVER (PARTITION BY {_G}) n_candidates, count(*) OVER (PARTITION BY {_G}) n_clusters, min(tier) OVER (PARTITION BY {_G}) t0, max(tier) OVER (PARTITION BY {_G}) t1 FROM k),
built AS (SELECT {_G}, CASE WHEN signs < 0 THEN -size ELSE size END AS value_num, unit, n_candidates::BIGINT n_candidates, n_clusters, CASE WHEN n_candidates = 1 THEN 'single' WHEN n_clusters = 1 THEN 'cluster' WHEN t0 < t1 THEN 'tier' ELSE 'conflict' END AS resolved_by FROM w WHERE place = 1)"""


@query(f"WITH {_BUILT} SELECT * FROM built")
def conflict_resolution(spark: SparkSession, d: str) -> DataFrame:
    """One value a metric from all records that state it: anchors, clusters, tiers, depth, support, size."""
    return _built(spark, d)


@query(f"""
WITH {_BUILT}, o AS (SELECT institution, concept_key, min(unit) u FROM built WHERE unit IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT unit) = 1), a AS (SELECT concept_key, min(unit) u FROM built WHERE unit IS NOT NULL GROUP BY 1 HAVING count(DISTINCT unit) = 1)
SELECT b.* EXCLUDE (unit), coalesce(b.unit, o.u, a.u) AS unit FROM built b LEFT JOIN o ON o.institution = b.institution AND o.concept_key = b.concept_key LEFT JOIN a ON a.concept_key = b.concept_key
""")
def metric_build(spark: SparkSession, d: str) -> DataFrame:
    """The same with the missing units that only one reading allows."""
    return M.infer_units(stage(_built(spark, d)))


@query(f"""
WITH {_BUILT}, x AS (SELECT {_G}, max(value_num) a, 1 ia FROM built GROUP BY ALL), y AS (SELECT {_G}, max(value_num) FILTER (NOT isnan(value_num)) b, 1 ib FROM fact_metric GROUP BY ALL),
z AS (SELECT {_G}, max(a) a, max(b) b, max(ia) ia, max(ib) ib FROM (SELECT {_G}, a, NULL::DOUBLE b, ia, 0 ib FROM x UNION ALL SELECT {_G}, NULL, b, 0, ib FROM y) GROUP BY {_G})
SELECT CASE WHEN ib = 0 THEN 'only_built' WHEN ia = 0 THEN 'only_stored' WHEN coalesce(abs(a - b) <= 0.5, a IS NULL AND b IS NULL) THEN 'same' ELSE 'differs' END AS status, count(*) AS metrics FROM z GROUP BY 1
""")
def metric_compare(spark: SparkSession, d: str) -> DataFrame:
    """Metrics built anew beside the stored ones of an earlier run."""
    stored = table(spark, d, "fact_metric").withColumn("value_num", F.when(~F.isnan("value_num"), c("value_num")))
    return M.compare_metrics(_built(spark, d), stored).groupBy("status").agg(F.count("*").alias("metrics"))


_STORED = f"stored AS (SELECT {_G}, max(value_num) value_num FROM fact_metric WHERE value_num IS NOT NULL AND NOT isnan(value_num) AND period IS NOT NULL GROUP BY ALL)"


def _stored(spark: SparkSession, d: str) -> DataFrame:
    """Stored metrics, one value each."""
    rows = table(spark, d, "fact_metric").where("value_num is not null and not isnan(value_num) and period is not null")
    return rows.groupBy(*M.GRAIN).agg(F.max("value_num").alias("value_num"))


@query(f"""
WITH {_STORED}, s AS (SELECT *, lag(value_num) OVER (PARTITION BY institution, concept_key, period_span, segment_key, geo_key, industry_key, legal_entity ORDER BY period) AS prev FROM stored)
SELECT {_G}, value_num, coalesce((value_num + prev) / 2, value_num, prev) AS average FROM s
""")
def prev_period_avg_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Every metric with the mean of its value and the one of the period before, which ratios on averages divide by."""
    return M.period_average(_stored(spark, d))


#: Ratios in per cent: name, part, base.
RATIOS = [("cost_income", "pnl.staff_outlay", "pnl.income"), ("loans_to_deposits", "bs.lending.gross", "bs.deposits"), ("equity_to_assets", "bs.equity", "bs.assets"), ("npa_ratio", "npa.gross", "bs.lending.gross")]
_K = ", ".join(k for k in M.GRAIN if k != "concept_key")
_SAME = " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in M.GRAIN if k != "concept_key")


@query(f"""
WITH {_STORED}, f(ratio, num, den) AS (VALUES {", ".join(f"('{a}', '{b}', '{e}')" for a, b, e in RATIOS)}), r AS (SELECT {", ".join(f"a.{k}" for k in M.GRAIN if k != "concept_key")}, ratio AS concept_key, 100 * a.value_num / b.value_num AS value_num FROM f JOIN stored a ON a.concept_key = num JOIN stored b ON b.concept_key = den AND {_SAME} WHERE b.value_num <> 0)
SELECT {_G}, value_num, 'reported' AS origin FROM stored UNION ALL SELECT {_G}, value_num, 'derived' FROM r WHERE NOT EXISTS (SELECT 1 FROM stored b WHERE b.concept_key = r.concept_key AND {_SAME.replace('a.', 'r.')})
""")
def derived_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Stored metrics and declared ratios, filled in where nothing is reported; none where a part is missing or the base is 0."""
    declared = [(name, F.try_divide(100 * c(f"`{part}`"), c(f"`{base}`")), [part, base]) for name, part, base in RATIOS]
    return M.formulas(_stored(spark, d), declared)


@query("""
WITH f AS (SELECT DISTINCT institution, concept_key, period, period_span, segment_key, geo_key, industry_key, legal_entity, unit FROM fact_metric),
o AS (SELECT institution, concept_key, min(unit) u FROM f WHERE unit IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT unit) = 1), a AS (SELECT concept_key, min(unit) u FROM f WHERE unit IS NOT NULL GROUP BY 1 HAVING count(DISTINCT unit) = 1)
SELECT f.institution, f.concept_key, f.period, f.period_span, f.segment_key, f.geo_key, f.industry_key, f.legal_entity, coalesce(f.unit, o.u, a.u) AS unit FROM f LEFT JOIN o ON o.institution = f.institution AND o.concept_key = f.concept_key LEFT JOIN a ON a.concept_key = f.concept_key
""")
def infer_units(spark: SparkSession, d: str) -> DataFrame:
    """Stored metrics with the missing units that only one reading allows."""
    return M.infer_units(table(spark, d, "fact_metric").select(*M.GRAIN, "unit").distinct())


@query(f"""
WITH {_CELL}, m AS (SELECT institution, concept_key, period, 0 ord, 'segment' AS dimension, segment_key AS member FROM v WHERE segment_key <> 'SEG_TOTAL' AND value_num IS NOT NULL AND concept_key IS NOT NULL
 UNION ALL SELECT institution, concept_key, period, 1, 'place', geo_key FROM v WHERE geo_key <> 'GLOBAL' AND value_num IS NOT NULL AND concept_key IS NOT NULL
 UNION ALL SELECT institution, concept_key, period, 2, 'industry', industry_key FROM v WHERE industry_key <> 'IND_TOTAL' AND value_num IS NOT NULL AND concept_key IS NOT NULL),
s AS (SELECT institution, concept_key, period, ord, dimension, count(DISTINCT member) members FROM m GROUP BY 1, 2, 3, 4, 5)
SELECT institution, concept_key, period, dimension, members FROM (SELECT *, row_number() OVER (PARTITION BY institution, concept_key, period ORDER BY members DESC, ord) k FROM s) WHERE k = 1
""")
def breakdown_cuts(spark: SparkSession, d: str) -> DataFrame:
    """The widest breakdown of each concept and period."""
    return M.breakdown_cuts(_cells(spark, d))


@query(f"""
WITH {_CELL}, d AS (SELECT DISTINCT institution, m.concept_key FROM filing, concept_map m WHERE table_type <> '*'),
n AS (SELECT f.institution, r.concept_key, count(*) AS row_count, count(nullif(canonical_leaf_id, '')) stamped FROM (SELECT DISTINCT doc_id, table_id, row_id, concept_key, canonical_leaf_id FROM row_dim) r JOIN filing f USING (doc_id) GROUP BY 1, 2),
x AS (SELECT institution, concept_key, count(value_num) vals, count(CASE WHEN value_num IS NOT NULL THEN unit END) units FROM v GROUP BY 1, 2)
SELECT d.institution, d.concept_key, CASE WHEN coalesce(row_count, 0) = 0 THEN 'absent' WHEN stamped = 0 THEN 'no structure' WHEN coalesce(vals, 0) = 0 THEN 'no value' WHEN coalesce(units, 0) = 0 THEN 'no unit' ELSE 'clean' END AS status
FROM d LEFT JOIN n ON n.institution = d.institution AND n.concept_key = d.concept_key LEFT JOIN x ON x.institution = d.institution AND x.concept_key = d.concept_key
""")
def coverage_matrix(spark: SparkSession, d: str) -> DataFrame:
    """What is missing of each declared concept at each institution."""
    filings = table(spark, d, "filing").select("doc_id", "institution")
    concepts = [r[0] for r in table(spark, d, "concept_map").where("table_type <> '*'").select("concept_key").distinct().limit(BROADCAST_ROWS + 1).collect()]  # the reference list, of fixed size
    if len(concepts) > BROADCAST_ROWS:
        raise ValueError(f"more than {BROADCAST_ROWS} concepts are declared")
    declared = filings.select("institution").distinct().select("institution", F.explode(F.array(*[F.lit(x) for x in concepts])).alias("concept_key"))
    rows = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id", "concept_key", F.nullif("canonical_leaf_id", F.lit("")).alias("canonical_leaf_id")).distinct().join(filings, "doc_id")
    return M.coverage_matrix(declared, rows, _cells(spark, d))


@query(f"""
WITH {_CELL}, t AS (SELECT doc_id, table_id, list_sort(list(coalesce(value_raw, ''))) s, count(*) FILTER (identity_source = 'human_anchor') anchors, max(row_hierarchy) depth FROM v GROUP BY 1, 2), k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, s) copies, first_value(table_id) OVER (PARTITION BY doc_id, s ORDER BY anchors DESC, depth DESC, table_id) canonical_id FROM t)
SELECT doc_id, table_id, canonical_id, table_id <> canonical_id AS quarantined FROM k WHERE copies > 1
""")
def canonical_tables(spark: SparkSession, d: str) -> DataFrame:
    """Of tables of one filing that print the same values the one that is kept."""
    cells = _cells(spark, d)
    tables = cells.groupBy("doc_id", "table_id").agg(F.count(F.when(c("identity_source") == "human_anchor", 1)).alias("anchors"), F.max("row_hierarchy").alias("depth")).withColumn("page", F.lit(1))
    return M.pick_canonical(tables, cells.select("doc_id", "table_id", F.coalesce("value_raw", F.lit("")).alias("value_raw")))


_TITLE = "list_filter(regexp_split_to_array(trim(table_title), '\\s+'), lambda w: w <> '' AND NOT regexp_replace(lower(w), '[^a-z]', '', 'g') IN ('cont', 'contd', 'continued'))"
_PANELS = "list_filter(list_transform(regexp_split_to_array(body, '[—–]| - '), lambda x: trim(x)), lambda x: x <> '')"


@query(f"""
WITH {_CELL}, a AS (SELECT DISTINCT doc_id, table_id, table_title FROM v), b AS (SELECT *, {_TITLE} AS ws FROM a), b2 AS (SELECT * EXCLUDE (ws), array_to_string(CASE WHEN len(ws) > 1 AND regexp_full_match(ws[1], '[0-9]+(\\.[0-9]+)*\\.?') THEN ws[2:] ELSE ws END, ' ') AS body FROM b),
s AS (SELECT *, {_PANELS} AS panels FROM b2), s2 AS (SELECT *, array_to_string(panels, ' ') AS joined FROM s), {Q.segments('s2', 'joined', False)}
SELECT doc_id, table_id, segment AS key, CASE WHEN len(panels) > 1 AND list_contains(regexp_extract_all(lower(panels[-1]), '[\\p{{L}}\\p{{M}}\\p{{Nd}}]+'), 'by') THEN panels[-1] END AS breakdown, nullif(array_to_string(regexp_extract_all(regexp_extract(lower(doc_id), '^.*?_?(?:[1-4]q|[12]h|fy|9m)[0-9]{{2,4}}_(.*)$', 1), '[a-z0-9]+'), '_'), '') AS family FROM g
""")
def caption_keys(spark: SparkSession, d: str) -> DataFrame:
    """Captions of all tables as keys, with their breakdowns, and the kinds of their filings."""
    rows = _cells(spark, d).select("doc_id", "table_id", "table_title").distinct()
    return rows.select("doc_id", "table_id", caption_key(c("table_title")).alias("key"), caption_parts(c("table_title"))["breakdown"].alias("breakdown"), filing_family(c("doc_id")).alias("family"))
