"""Reconciliation checks and the curator's operators over the test tables, each beside the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.labels import segment
from ledgerloom.functions.periods import mere_period, read_period
from ledgerloom.functions.text import plain, squeeze
from ledgerloom.functions.units import unit_code
from ledgerloom.operators import checks as K
from ledgerloom.operators import curate as U
from ledgerloom.plans import sql as Q
from ledgerloom.plans.load_sql import WARNINGS_SQL
from ledgerloom.runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
c = F.col
_CELL = "v AS (SELECT DISTINCT * FROM v_cell)"
CELL_KEY = ["doc_id", "table_id", "row_id", "col_id"]


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL it is held against where there is any."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def cells(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "v_cell").dropDuplicates(CELL_KEY)


# --- checks ------------------------------------------------------------------------------------------------------------

_ONE = "o AS (SELECT institution, period, period_span, concept_key, max(value_num) x FROM fact_metric WHERE segment_key = 'SEG_TOTAL' AND geo_key = 'GLOBAL' AND legal_entity = 'CONSOLIDATED' AND value_num IS NOT NULL AND NOT isnan(value_num) AND period IS NOT NULL GROUP BY 1, 2, 3, 4)"
IDENTITIES = [("pnl.income", "pnl.nii", 1), ("pnl.income", "pnl.fees", 1), ("pnl.income", "pnl.markets", 1), ("pnl.nii", "pnl.interest_earned_on_lending", 1), ("pnl.nii", "pnl.interest_paid_on_funding", -1), ("bs.equity", "bs.assets", 1), ("bs.equity", "bs.liabilities", -1)]
STATED_RATIOS = [("npa.ratio", "npa.gross", "bs.lending.gross"), ("cap.core_ratio", "cap.core", "cap.rwa"), ("cap.total_ratio", "cap.own_funds", "cap.rwa"), ("kpi.cost_income", "pnl.staff_outlay", "pnl.income")]


def _whole(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "fact_metric").where("segment_key = 'SEG_TOTAL' and geo_key = 'GLOBAL' and legal_entity = 'CONSOLIDATED' and value_num is not null and not isnan(value_num) and period is not null")
    return rows.groupBy("institution", "period", "period_span", "concept_key").agg(F.max("value_num").alias("value"))


@query(f"""
WITH {_ONE}, i(total, concept_key, sign) AS (VALUES {", ".join(f"('{a}', '{b}', {s})" for a, b, s in IDENTITIES)}), n AS (SELECT total, count(*) declared FROM i GROUP BY 1),
s AS (SELECT total, institution, period, period_span, sum(x::DECIMAL(28,4))::DOUBLE plain, sum(sign * x::DECIMAL(28,4))::DOUBLE signed, count(*) k FROM o JOIN i USING (concept_key) GROUP BY 1, 2, 3, 4)
SELECT s.institution, s.period, s.period_span, s.total, o.x AS stated, plain, signed FROM s JOIN n ON n.total = s.total AND k = declared JOIN o ON o.concept_key = s.total AND o.institution = s.institution AND o.period = s.period AND o.period_span = s.period_span
WHERE abs(plain - o.x) > greatest(1.0, abs(o.x) / 100) AND abs(signed - o.x) > greatest(1.0, abs(o.x) / 100)
""")
def check_identities(spark: SparkSession, d: str) -> DataFrame:
    """Declared totals that their members do not add up to."""
    declared = spark.createDataFrame(IDENTITIES, "total string, concept_key string, sign int")
    return K.identity_violations(_whole(spark, d), declared, ["institution", "period", "period_span"])


@query(f"""
WITH {_ONE}, q AS (SELECT institution, period, concept_key, max(x) x FROM o GROUP BY 1, 2, 3), r(ratio, part, base) AS (VALUES {", ".join(f"('{a}', '{b}', '{e}')" for a, b, e in STATED_RATIOS)})
SELECT s.institution, s.period, ratio, s.x AS stated, 100 * a.x / b.x AS computed FROM r JOIN q s ON s.concept_key = ratio JOIN q a ON a.concept_key = part AND a.institution = s.institution AND a.period = s.period JOIN q b ON b.concept_key = base AND b.institution = s.institution AND b.period = s.period
WHERE b.x <> 0 AND abs(s.x - 100 * a.x / b.x) > greatest(0.5, abs(100 * a.x / b.x) / 50)
""")
def check_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Stated ratios that their parts do not give."""
    by = ["institution", "period"]
    one = _whole(spark, d).groupBy(*by, "concept_key").agg(F.max("value").alias("value"))
    return K.ratio_violations(one, spark.createDataFrame(STATED_RATIOS, "ratio string, part string, base string"), by)


@query("""
WITH f AS (SELECT DISTINCT doc_id, table_id, row_id, col_id, value_num v FROM v_cell WHERE value_num <> 0 AND NOT isnan(value_num)), p AS (SELECT doc_id, table_id, row_id, min(row_parent) up FROM row_dim GROUP BY 1, 2, 3 HAVING min(row_parent) IS NOT NULL),
q AS (SELECT f.*, up, count(*) OVER (PARTITION BY f.doc_id, f.table_id, up, col_id) parts FROM f JOIN p USING (doc_id, table_id, row_id))
SELECT q.doc_id, q.table_id, q.row_id, q.col_id, q.v AS value_num, parts FROM q JOIN f t ON t.doc_id = q.doc_id AND t.table_id = q.table_id AND t.row_id = q.up AND t.col_id = q.col_id AND t.v = q.v WHERE parts > 1
""")
def check_part_is_whole(spark: SparkSession, d: str) -> DataFrame:
    """Parts that state their whole total."""
    parents = table(spark, d, "row_dim").groupBy("doc_id", "table_id", "row_id").agg(F.min("row_parent").alias("row_parent"))
    return K.part_is_whole(table(spark, d, "v_cell").where("not isnan(value_num)").select(*CELL_KEY, "value_num").distinct(), parents)


@query(f"""
WITH {_CELL}, s AS (SELECT institution, concept_key, period, max(abs(value_num)) FILTER (period_span = 'as_at') a, max(abs(value_num)) FILTER (period_span <> 'as_at') w FROM v WHERE concept_key IS NOT NULL AND value_num IS NOT NULL AND NOT isnan(value_num) GROUP BY 1, 2, 3)
SELECT institution, concept_key, period, a AS at_date, w AS in_window FROM s WHERE greatest(a, w) > 2 * least(a, w) AND a IS NOT NULL AND w IS NOT NULL
""")
def check_stock_against_window(spark: SparkSession, d: str) -> DataFrame:
    """Items stated both at a date and for a window, far apart."""
    return K.stock_against_window(cells(spark, d).where("concept_key is not null"), ["institution", "concept_key", "period"])


_GRAIN = "institution, concept_key, period, period_span, segment_key, geo_key, industry_key, legal_entity"


@query(f"SELECT {_GRAIN}, count(*) AS stated, min(value_num) AS lowest, max(value_num) AS highest, max(value_num) - min(value_num) > 0.5 AS conflict FROM fact_metric WHERE value_num IS NOT NULL AND NOT isnan(value_num) GROUP BY ALL HAVING count(*) > 1")
def metric_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Metrics that the store has more than once, and whether they differ."""
    return K.stated_conflicts(table(spark, d, "fact_metric"), _GRAIN.split(", "))


@query("""
SELECT doc_id, part FROM (SELECT DISTINCT doc_id FROM filing) f CROSS JOIN (VALUES ('sections'), ('rows'), ('cells'), ('units')) p(part)
WHERE NOT CASE part WHEN 'sections' THEN doc_id IN (SELECT doc_id FROM toc_section) WHEN 'rows' THEN doc_id IN (SELECT doc_id FROM row_dim) WHEN 'cells' THEN doc_id IN (SELECT doc_id FROM cell_fact) ELSE doc_id IN (SELECT doc_id FROM parsed WHERE doc_id IS NOT NULL) END
""")
def manifest_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Filings of which the store lacks sections, rows, cells or extraction units."""
    parts = {"sections": "toc_section", "rows": "row_dim", "cells": "cell_fact", "units": "parsed"}
    return K.manifest_gaps(table(spark, d, "filing"), {k: table(spark, d, t) for k, t in parts.items()})


@query(f"""
WITH {_CELL} SELECT doc_id, table_id, max(period) AS latest FROM v JOIN filing USING (doc_id) WHERE period IS NOT NULL AND doc_period IS NOT NULL GROUP BY 1, 2 HAVING NOT bool_or(period = doc_period)
""")
def check_undated_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables without a figure of their filing's period."""
    return K.undated_tables(cells(spark, d), table(spark, d, "filing"))


def _tables(spark: SparkSession, d: str) -> DataFrame:
    units = table(spark, d, "parsed").select("unit_id", "tables").dropDuplicates(["unit_id"])
    return units.select("unit_id", F.posexplode("tables").alias("table_no", "t")).where("t is not null").select("unit_id", "table_no", "t.*")


_TABLES = """u AS (SELECT unit_id, any_value(tables) tables FROM parsed GROUP BY 1), t AS (SELECT unit_id, unnest(tables) t, generate_subscripts(tables, 1) - 1 AS table_no FROM u), tt AS (SELECT * FROM t WHERE t IS NOT NULL),
r AS (SELECT unit_id, table_no, t.columns cols, unnest(t.rows) r, generate_subscripts(t.rows, 1) - 1 AS row_no FROM tt)"""
_FILLED = "coalesce(len(list_filter(r.values, lambda x: coalesce(trim(x.value) <> '', false))) > 0, false)"


@query(f"""
WITH {_TABLES}, b AS (SELECT unit_id, table_no, count(nullif(lower(trim(r.row_id)), '')) - count(DISTINCT nullif(lower(trim(r.row_id)), '')) AS twice, count(*) FILTER (len(r.values) > len(cols) AND len(cols) > 0) AS wide,
 count(*) FILTER (coalesce(trim(r.label), '') = '' AND {_FILLED}) AS bare, max(CASE WHEN coalesce(len(cols), 0) = 0 AND {_FILLED} THEN 1 ELSE 0 END) AS headless FROM r WHERE r IS NOT NULL GROUP BY 1, 2),
l AS (SELECT unit_id, table_no, len(list_filter(t.columns, lambda x: coalesce(regexp_full_match(trim(x.leaf), '[A-Za-z]'), false))) AS letters FROM tt),
x AS (SELECT unit_id, table_no, 'row id twice' AS problem, twice AS n FROM b UNION ALL SELECT unit_id, table_no, 'row too wide', wide FROM b UNION ALL SELECT unit_id, table_no, 'values without a label', bare FROM b UNION ALL SELECT unit_id, table_no, 'no columns', headless FROM b UNION ALL SELECT unit_id, table_no, 'letter for a heading', letters FROM l)
SELECT * FROM x WHERE n > 0
""")
def check_contract(spark: SparkSession, d: str) -> DataFrame:
    """Extracted tables that break their contract."""
    return K.contract_violations(_tables(spark, d))


# --- the curator's side --------------------------------------------------------------------------------------------------


@query("""
SELECT label, CASE WHEN t = '' THEN 'blank' WHEN NOT regexp_matches(t, '\\p{L}') THEN 'number' WHEN regexp_matches(lower(t), '^\\s*(\\(?[0-9a-z]{1,2}\\)|[*†‡]+|notes?\\s*:|n\\.?b\\.?\\s*:)') AND regexp_matches(t, '\\.\\s*$') AND length(t) > 40 THEN 'footnote' END AS reason
FROM (SELECT DISTINCT alias_row_label_norm AS label, trim(coalesce(alias_row_label_norm, '')) t FROM canonical_leaf_alias)
""")
def noise_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels as typed, and why some name no item."""
    return table(spark, d, "canonical_leaf_alias").select(c("alias_row_label_norm").alias("label")).distinct().withColumn("reason", U.noise_reason(c("label")))


def _parsed_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = _tables(spark, d).select("unit_id", "table_no", F.posexplode("rows").alias("row_id", "r")).where("r is not null")
    valued = F.exists(F.coalesce("r.values", F.array().cast("array<struct<value:string,cell_state:string>>")), lambda v: F.coalesce(F.trim(v["value"]) != "", F.lit(False)))
    return rows.select("unit_id", "table_no", "row_id", c("r.row_type").alias("row_type"), F.coalesce("r.level", F.lit(0)).alias("level"), c("r.label").alias("label"), valued.alias("valued"))


_MONTHS = "(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)"
_MERE = rf"^(as|at|of|on|for|the|in|period|year|half|quarter|ended|\s|[(),.:;-])*(([0-9]{{1,2}}\s*)?{_MONTHS}\s*[-/]?\s*([0-9]{{4}}|[0-9]{{2}})|[1-4]\s*q(uarter)?\s*([0-9]{{4}}|[0-9]{{2}})|q\s*[1-4]\s*([0-9]{{4}}|[0-9]{{2}})|[12]\s*h(alf)?\s*([0-9]{{4}}|[0-9]{{2}})|(fy|9m)\s*([0-9]{{4}}|[0-9]{{2}})|[0-9]{{4}})[(),.:;\s-]*$"


@query(f"""
WITH {_TABLES}, s AS (SELECT unit_id, table_no, row_no AS row_id, coalesce(r.row_type, 'data') kind, coalesce(trim(r.label), '') = '' AS blank, {_FILLED} AS valued, coalesce(regexp_matches(lower({Q.plain('r.label')}), '{_MERE}'), false) AS period FROM r WHERE r IS NOT NULL),
l AS (SELECT *, coalesce(bool_or(valued) OVER (PARTITION BY unit_id, table_no ORDER BY row_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), false) AS later FROM s)
SELECT unit_id, table_no, row_id, CASE WHEN blank OR kind = 'note' THEN 'EXCLUDED' WHEN valued AND period THEN 'PERIOD_ROW' WHEN valued THEN 'DATA' WHEN period THEN 'PERIOD_BANNER' WHEN kind = 'section_header' THEN 'SECTION_HEADER' WHEN later THEN 'BANNER' ELSE 'EXCLUDED' END AS row_class FROM l
""")
def row_classes(spark: SparkSession, d: str) -> DataFrame:
    """What each extracted row is."""
    return U.row_classes(_parsed_rows(spark, d), ["unit_id", "table_no"]).select("unit_id", "table_no", "row_id", "row_class")


@query(f"""
WITH {_TABLES}, s AS (SELECT unit_id, table_no, row_no AS row_id, r.row_type kind, coalesce(r.level, 0) lv FROM r WHERE r IS NOT NULL), h AS (SELECT *, coalesce(kind, '') <> 'section_header' AND coalesce(lead(lv) OVER w > lv, false) AS heads FROM s WINDOW w AS (PARTITION BY unit_id, table_no ORDER BY row_id)),
n AS (SELECT *, sum(heads::INT) OVER (PARTITION BY unit_id, table_no ORDER BY row_id) nth FROM h), p AS (SELECT a.unit_id, a.table_no, a.row_id, max(b.row_id) up FROM n a LEFT JOIN n b ON a.unit_id = b.unit_id AND a.table_no = b.table_no AND b.row_id < a.row_id AND b.lv < a.lv GROUP BY 1, 2, 3)
SELECT p.unit_id, p.table_no, p.row_id, CASE WHEN n.heads THEN 'h' || n.nth WHEN n.row_id IS NOT NULL THEN '#' || n.row_id END AS parent FROM p LEFT JOIN n ON n.unit_id = p.unit_id AND n.table_no = p.table_no AND n.row_id = p.up
""")
def filled_parents(spark: SparkSession, d: str) -> DataFrame:
    """Parents of extracted rows from their levels alone."""
    return U.filled_parents(_parsed_rows(spark, d).drop("label", "valued"), ["unit_id", "table_no"])


@query()
def row_ancestry(spark: SparkSession, d: str) -> DataFrame:
    """Labels above each row with figures."""
    from ledgerloom.operators.generic import nearest_shallower

    key = ["unit_id", "table_no"]
    rows = U.row_classes(_parsed_rows(spark, d), key)
    rows = nearest_shallower(rows, key, "row_id", "level", "row_parent")
    return U.ancestry(rows.select(*key, "row_id", "level", "label", "row_class", "row_parent"), key)


def _stored_rows(spark: SparkSession, d: str) -> DataFrame:
    """row_dim, each row once."""
    first = [F.min(x).alias(x) for x in ("row_hierarchy", "row_parent", "row_leaf_label", "table_type_id", "canonical_leaf_id")]
    return table(spark, d, "row_dim").groupBy("doc_id", "table_id", "row_id").agg(*first)


_ROWS = "r AS (SELECT doc_id, table_id, row_id, min(row_hierarchy) lv, min(row_parent) up, min(row_leaf_label) label, min(table_type_id) kind, min(canonical_leaf_id) leaf FROM row_dim GROUP BY 1, 2, 3)"


@query(f"""
WITH {_ROWS}, p AS (SELECT a.*, b.label above FROM r a LEFT JOIN r b ON b.doc_id = a.doc_id AND b.table_id = a.table_id AND b.row_id = a.up), s AS (SELECT doc_id, table_id, lv, count(DISTINCT coalesce(above, '')) > 1 AS several FROM p GROUP BY 1, 2, 3)
SELECT p.doc_id, p.table_id, p.row_id, CASE WHEN several AND above IS NOT NULL THEN CASE WHEN label IS NULL THEN above ELSE above || '::' || label END ELSE label END AS address FROM p JOIN s USING (doc_id, table_id, lv)
""")
def ordered_addresses(spark: SparkSession, d: str) -> DataFrame:
    """Row labels with the parent's in front where it tells rows of a depth apart."""
    key = ["doc_id", "table_id"]
    rows = _stored_rows(spark, d)
    above = rows.select(*key, c("row_id").alias("row_parent"), c("row_leaf_label").alias("parent_label"))
    both = rows.join(above, [*key, "row_parent"], "left").select(*key, "row_id", c("row_hierarchy").alias("depth"), c("row_leaf_label").alias("label"), "parent_label")
    return U.addresses(both, key)


@query(f"""
WITH {_CELL} SELECT institution, concept_key, period, doc_id, table_id, row_id, col_id, value_num FROM v WHERE concept_key IS NOT NULL AND value_num IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY institution, concept_key ORDER BY coalesce(period = DATE '2019-12-31', false) DESC, period DESC NULLS LAST, doc_id, table_id, row_id, col_id) = 1
""")
def benchmark_rows(spark: SparkSession, d: str) -> DataFrame:
    """One figure a concept: at the end of 2019 if stated then, else the latest."""
    rows = cells(spark, d).where("concept_key is not null and value_num is not null").select("institution", "concept_key", "period", *CELL_KEY, "value_num")
    return U.benchmark_rows(rows, ["institution", "concept_key"], "2019-12-31", CELL_KEY)


@query(f"""
WITH {_ROWS}, q AS (SELECT doc_id, table_id, row_id, kind, try_cast(nullif(regexp_extract(leaf, '([0-9]{{1,6}})$', 1), '') AS INT) k FROM r WHERE kind IS NOT NULL),
w AS (SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY doc_id, table_id, kind ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) lo, first_value(k IGNORE NULLS) OVER (PARTITION BY doc_id, table_id, kind ORDER BY row_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) hi FROM q),
e AS (SELECT DISTINCT kind, leaf, try_cast(nullif(regexp_extract(leaf, '([0-9]{{1,6}})$', 1), '') AS INT) k FROM r WHERE kind IS NOT NULL AND leaf <> '')
SELECT w.doc_id, w.table_id, w.row_id, e.leaf AS canonical_leaf_id FROM w JOIN e ON e.kind = w.kind AND e.k > w.lo AND e.k < w.hi WHERE w.k IS NULL
""")
def suggest_unresolved(spark: SparkSession, d: str) -> DataFrame:
    """What unresolved rows may be, by the entries of the rows around them."""
    rows = _stored_rows(spark, d).where("table_type_id is not null").withColumn("ordinal", F.regexp_extract("canonical_leaf_id", r"(\d{1,6})$", 1).try_cast("int"))
    entries = rows.where("canonical_leaf_id <> '' and ordinal is not null").select("table_type_id", "ordinal", "canonical_leaf_id").distinct()
    return U.suggest_between(rows.select("doc_id", "table_id", "row_id", "table_type_id", "ordinal"), entries)


@query(f"""
WITH {_ROWS}, h AS (SELECT doc_id, table_id, up AS head, least(up, min(row_id)) AS place FROM r WHERE up IS NOT NULL GROUP BY 1, 2, 3), g AS (SELECT *, 'G' || dense_rank() OVER (PARTITION BY doc_id, table_id ORDER BY place) AS g FROM h)
SELECT r.doc_id, r.table_id, r.row_id, CASE WHEN a.g IS NOT NULL THEN 'total' WHEN b.g IS NOT NULL THEN 'component' ELSE 'atomic' END AS role, coalesce(a.g, b.g) AS sum_group
FROM r LEFT JOIN g a ON a.doc_id = r.doc_id AND a.table_id = r.table_id AND a.head = r.row_id LEFT JOIN g b ON b.doc_id = r.doc_id AND b.table_id = r.table_id AND b.head = r.up
""")
def sum_roles(spark: SparkSession, d: str) -> DataFrame:
    """Totals, components and atomic rows, by stored parents."""
    return U.sum_roles(_stored_rows(spark, d).select("doc_id", "table_id", "row_id", "row_parent"))


@query(f"""
WITH {_CELL}, k AS (SELECT DISTINCT doc_id, table_id, col_id, CASE WHEN period_span = 'FY' THEN 0 WHEN month(period) = 12 AND period_span = 'as_at' THEN 1 WHEN month(period) = 12 AND period_span = '4Q' THEN 2 END rk FROM v)
SELECT doc_id, table_id, first(CASE WHEN rk IS NOT NULL THEN col_id END ORDER BY rk NULLS LAST, col_id) AS col_id, CASE min(rk) WHEN 0 THEN 'full year' WHEN 1 THEN 'year''s close' WHEN 2 THEN 'last quarter' ELSE 'none' END AS why FROM k GROUP BY 1, 2
""")
def year_columns(spark: SparkSession, d: str) -> DataFrame:
    """The column of each table that stands for the year."""
    return U.year_column(cells(spark, d).select("doc_id", "table_id", "col_id", "period", "period_span"), ["doc_id", "table_id"])


@query(f"""
WITH s AS (SELECT DISTINCT doc_id, table_id, row_id, table_type_id, row_leaf_label AS label, canonical_leaf_id FROM row_dim WHERE table_type_id IS NOT NULL), {Q.segments('s', 'label')}
SELECT table_type_id, segment, count(DISTINCT doc_id) AS filings, count(*) AS seen, min(label) AS sample FROM g WHERE segment <> '' GROUP BY 1, 2 HAVING NOT bool_or(coalesce(trim(canonical_leaf_id) <> '', false))
""")
def propose_rows(spark: SparkSession, d: str) -> DataFrame:
    """Labels that no list entry names yet, with how often and where they are printed."""
    rows = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id", "table_type_id", c("row_leaf_label").alias("label"), "canonical_leaf_id").distinct()
    return U.propose_rows(rows)


@query(f"WITH s AS (SELECT DISTINCT row_leaf_label FROM row_dim), {Q.segments('s', 'row_leaf_label')} SELECT row_leaf_label, CASE WHEN row_leaf_label IS NOT NULL THEN segment END AS segment FROM g")
def label_segments(spark: SparkSession, d: str) -> DataFrame:
    """Row labels as identity segments."""
    return table(spark, d, "row_dim").select("row_leaf_label").distinct().withColumn("segment", segment(c("row_leaf_label")))


_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({x}), '[^a-z0-9]+'), lambda w: w <> ''))"


@query(f"""
WITH a AS (SELECT DISTINCT alias_row_label_norm AS label FROM canonical_leaf_alias), b AS (SELECT DISTINCT label_norm AS needle FROM concept_map), a2 AS (SELECT label, {_WORDS.format(x='label')} w FROM a), b2 AS (SELECT needle, {_WORDS.format(x='needle')} w FROM b),
p AS (SELECT label, needle, len(list_intersect(a2.w, b2.w)) AS shared, len(a2.w) na, len(b2.w) nb FROM a2, b2), q AS (SELECT *, round(shared / (na + nb - shared), 6) AS score, shared / (na + nb - shared) AS raw FROM p WHERE shared > 0)
SELECT label, needle, shared, score FROM q WHERE (shared >= 2 AND shared = least(na, nb)) OR raw >= 0.6 QUALIFY row_number() OVER (PARTITION BY label ORDER BY score DESC, shared DESC, needle) = 1
""")
def fuzzy_labels(spark: SparkSession, d: str) -> DataFrame:
    """The closest entry of the reference list by shared words alone."""
    labels = table(spark, d, "canonical_leaf_alias").select(c("alias_row_label_norm").alias("label"))
    return U.fuzzy_lookup(labels, table(spark, d, "concept_map").select(c("label_norm").alias("needle")))


@query(f"""
WITH {_TABLES} SELECT unit_id, table_no, substr(sha1(concat_ws(chr(30), coalesce({Q.plain('t.title')}, ''), coalesce(array_to_string(list_transform(t.columns, lambda x: coalesce({Q.plain('x.leaf')}, '')), chr(31)), ''), coalesce(array_to_string(list_transform(t.rows[1:3], lambda x: coalesce({Q.plain('x.label')}, '')), chr(31)), ''))), 1, 12) AS fingerprint FROM tt
""")
def table_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """What tells each extracted table."""
    leaves, labels = F.transform("columns", lambda x: x["leaf"]), F.transform("rows", lambda x: x["label"])
    return _tables(spark, d).select("unit_id", "table_no", U.fingerprint(c("title"), leaves, labels).alias("fingerprint"))


@query("""
WITH s AS (SELECT doc_id, section_id, min(seq) q FROM toc_section GROUP BY 1, 2), l AS (SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM toc_section p WHERE p.doc_id = s.doc_id AND p.parent_section = s.section_id)), e AS (SELECT doc_id, max(seq) fin FROM toc_section GROUP BY 1)
SELECT doc_id, section_id, q AS first_seq, greatest(q, coalesce(lead(q) OVER (PARTITION BY doc_id ORDER BY q, section_id) - 1, fin)) AS last_seq FROM l JOIN e USING (doc_id)
""")
def section_units(spark: SparkSession, d: str) -> DataFrame:
    """Units of work: sections without sections below, each up to the next."""
    return U.section_units(table(spark, d, "toc_section").select("doc_id", "section_id", "parent_section", "seq").distinct())


# --- small rules over stored tables ------------------------------------------------------------------------------------------


@query("""
WITH n AS (SELECT concept_key, unit, count(*) n FROM fact_metric WHERE unit IS NOT NULL AND concept_key IS NOT NULL GROUP BY 1, 2) SELECT concept_key, unit, n AS votes FROM n QUALIFY row_number() OVER (PARTITION BY concept_key ORDER BY n DESC, unit) = 1
""")
def common_units(spark: SparkSession, d: str) -> DataFrame:
    """The unit most often reported for each concept, the smaller name of equals."""
    votes = table(spark, d, "fact_metric").where("unit is not null and concept_key is not null").groupBy("concept_key", "unit").agg(F.count("*").alias("votes"))
    return votes.groupBy("concept_key").agg(F.min_by(F.struct("unit", "votes"), F.struct(-c("votes"), "unit")).alias("b")).select("concept_key", "b.*")


@query(f"""
WITH {_CELL}, n AS (SELECT doc_id, table_id, count(DISTINCT CASE WHEN segment_key <> 'SEG_TOTAL' THEN segment_key END) segments, count(DISTINCT CASE WHEN geo_key <> 'GLOBAL' THEN geo_key END) places, count(DISTINCT CASE WHEN industry_key <> 'IND_TOTAL' THEN industry_key END) industries FROM v GROUP BY 1, 2)
SELECT *, CASE WHEN segments >= 2 AND segments >= places AND segments >= industries THEN 'segment' WHEN places >= 2 AND places >= industries THEN 'place' WHEN industries >= 2 THEN 'industry' ELSE 'whole' END AS breakdown FROM n
""")
def dimension_scope(spark: SparkSession, d: str) -> DataFrame:
    """Which dimension each table breaks its figures down by: the one with the most members, two at least."""
    members = lambda k, whole: F.count_distinct(F.when(c(k) != whole, c(k)))
    out = cells(spark, d).groupBy("doc_id", "table_id").agg(members("segment_key", "SEG_TOTAL").alias("segments"), members("geo_key", "GLOBAL").alias("places"), members("industry_key", "IND_TOTAL").alias("industries"))
    s, p, i = c("segments"), c("places"), c("industries")
    return out.withColumn("breakdown", F.when((s >= 2) & (s >= p) & (s >= i), "segment").when((p >= 2) & (p >= i), "place").when(i >= 2, "industry").otherwise("whole"))


@query("""
SELECT doc_id, CASE WHEN lower(coalesce(doc_family, '') || ' ' || coalesce(source_file, '')) LIKE '%pillar3%' OR regexp_matches(lower(coalesce(source_file, '')), '(^|_)p3([._]|$)') THEN 'pillar3' WHEN regexp_matches(lower(coalesce(source_file, '')), 'transcript') THEN 'transcript' WHEN regexp_matches(lower(coalesce(source_file, '')), 'slides|presentation') THEN 'slides'
 WHEN lower(coalesce(doc_family, '')) LIKE 'financial%' OR regexp_matches(lower(coalesce(source_file, '')), '(^|_)fs([._]|$)') THEN 'statements' ELSE 'other' END AS family,
 quarter(doc_period) || 'Q' || strftime(doc_period, '%y') AS quarter, CASE WHEN regexp_matches(doc_id, '_[1-4]q[0-9]{2}(_|$)') THEN '20' || regexp_extract(doc_id, '_([1-4])q([0-9]{2})(_|$)', 2) || '-Q' || regexp_extract(doc_id, '_([1-4])q([0-9]{2})(_|$)', 1) END AS stem_period FROM filing
""")
def filing_families(spark: SparkSession, d: str) -> DataFrame:
    """The kind of each filing from its family and file name, its quarter, and the period its id names."""
    file, kind = F.lower(F.coalesce("source_file", F.lit(""))), F.lower(F.coalesce("doc_family", F.lit("")))
    family = (
        F.when(kind.contains("pillar3") | file.contains("pillar3") | file.rlike(r"(^|_)p3([._]|$)"), "pillar3").when(file.contains("transcript"), "transcript").when(file.rlike("slides|presentation"), "slides")
        .when(kind.startswith("financial") | file.rlike(r"(^|_)fs([._]|$)"), "statements").otherwise("other")
    )
    stem = lambda i: F.regexp_extract("doc_id", r"_([1-4])q([0-9]{2})(?:_|$)", i)
    named = F.when(stem(1) != "", F.concat(F.lit("20"), stem(2), F.lit("-Q"), stem(1)))
    return table(spark, d, "filing").select("doc_id", family.alias("family"), F.concat(F.quarter("doc_period").cast("string"), F.lit("Q"), F.date_format("doc_period", "yy")).alias("quarter"), named.alias("stem_period"))


@query("""
SELECT DISTINCT value_raw, value_num, CASE WHEN value_num IS NULL OR isnan(value_num) THEN value_raw ELSE regexp_replace(regexp_replace(format('{:,.2f}', value_num), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') END AS shown FROM cell_fact
""")
def shown_values(spark: SparkSession, d: str) -> DataFrame:
    """Figures as they are shown: two places at most, thousands apart; the printed token where there is no number."""
    value = F.when(F.isnan("value_num"), None).otherwise(c("value_num"))
    shown = F.regexp_replace(F.regexp_replace(F.format_number(value, 2), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    rows = table(spark, d, "cell_fact").select("value_raw", "value_num").distinct()
    return rows.withColumn("shown", F.coalesce(shown, "value_raw"))


@query(f"""
SELECT regexp_replace(split_part(warning, ':', 1), '[0-9]+', 'N', 'g') AS category, count(*) AS warnings, count(DISTINCT doc_id) AS filings FROM ({WARNINGS_SQL}) GROUP BY 1
""")
def warning_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many warnings of each kind the loader gives, and in how many filings."""
    from ledgerloom.plans.load_queries import star

    kind = F.regexp_replace(F.substring_index("warning", ":", 1), "[0-9]+", "N")
    return star(spark, d, "load_warning")["load_warning"].groupBy(kind.alias("category")).agg(F.count("*").alias("warnings"), F.count_distinct("doc_id").alias("filings"))


@query(f"""
WITH h AS (SELECT DISTINCT col_leaf_label AS label FROM v_cell UNION SELECT DISTINCT row_leaf_label FROM v_cell), {Q.period('h', 'label', 'p', True)} SELECT label, {Q.mere_period('rest')} AS is_period FROM p
""")
def period_labels(spark: SparkSession, d: str) -> DataFrame:
    """Which headings and row labels are nothing but a period."""
    cells_ = table(spark, d, "v_cell")
    labels = cells_.select(c("col_leaf_label").alias("label")).distinct().unionByName(cells_.select(c("row_leaf_label").alias("label")).distinct()).distinct()
    return labels.withColumn("is_period", F.coalesce(mere_period(read_period(c("label"), True)["rest"]), F.lit(False)))


@query(f"""
WITH h AS (SELECT DISTINCT value_raw, {Q.plain("coalesce(value_raw, '')")} AS token FROM cell_fact), {Q.period('h', 'token', 'p', False)}
SELECT value_raw, CASE WHEN token = '' THEN 'empty' WHEN {Q.number('token')} IS NOT NULL THEN 'number' WHEN {Q.mere_period('rest')} THEN 'period' ELSE 'text' END AS kind FROM p
""")
def typed_cells(spark: SparkSession, d: str) -> DataFrame:
    """What each printed token is when it is typed in."""
    return table(spark, d, "cell_fact").select("value_raw").distinct().withColumn("kind", U.typed_text(c("value_raw")))


_SHOWN = Q.squeeze(Q.plain("table_title"))


@query(f"""
WITH t AS (SELECT DISTINCT doc_id, table_id, table_title, {_SHOWN} AS s FROM v_cell), n AS (SELECT doc_id, table_id, CASE WHEN s = upper(s) AND regexp_matches(s, '[\\p{{L}}]{{4}}') THEN upper(left(s, 1)) || lower(substr(s, 2)) ELSE s END AS name FROM t), k AS (SELECT doc_id, table_id, min(name) AS name FROM n GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, name ORDER BY table_id) AS i FROM k) SELECT doc_id, table_id, CASE WHEN i > 1 THEN name || ' (' || i || ')' ELSE name END AS name FROM r
""")
def display_names(spark: SparkSession, d: str) -> DataFrame:
    """Tables by the names they are shown under; equal names of a filing are numbered."""
    names = table(spark, d, "v_cell").select("doc_id", "table_id", "table_title").distinct().groupBy("doc_id", "table_id").agg(F.min(U.display_name(c("table_title"))).alias("name"))
    nth = F.row_number().over(W.partitionBy("doc_id", "name").orderBy("table_id"))
    return names.withColumn("i", nth).select("doc_id", "table_id", F.when(c("i") > 1, F.concat("name", F.lit(" ("), c("i").cast("string"), F.lit(")"))).otherwise(c("name")).alias("name"))


@query(f"""
WITH {Q.SPELT}, {_TABLES}, x AS (SELECT unit_id, table_no, unnest(t.columns) col, generate_subscripts(t.columns, 1) - 1 AS col_no FROM tt)
SELECT unit_id, table_no, col_no, concat_ws(' › ', CASE WHEN NOT coalesce({Q.squeeze('lower(col."group")')} = {Q.squeeze('lower(col.leaf)')}, false) THEN {Q.squeeze(Q.plain('col."group"'))} END, {Q.squeeze(Q.plain('col.leaf'))}) AS chain, {Q.unit_code('col.leaf')} IS NOT NULL AS unit_only FROM x
""")
def column_chains(spark: SparkSession, d: str) -> DataFrame:
    """Column headings with what stands above them, and whether they are nothing but a unit."""
    cols = _tables(spark, d).select("unit_id", "table_no", F.posexplode("columns").alias("col_no", "col"))
    echo = F.coalesce(squeeze(F.lower("col.group")) == squeeze(F.lower("col.leaf")), F.lit(False))
    chain = F.concat_ws(" › ", F.when(~echo, squeeze(plain(c("col.group")))), squeeze(plain(c("col.leaf"))))
    return cols.select("unit_id", "table_no", "col_no", chain.alias("chain"), unit_code(c("col.leaf")).isNotNull().alias("unit_only"))


@query(f"""
WITH k AS (SELECT table_type_id, row_leaf_label AS label, canonical_leaf_id AS leaf, {Q.label_key('row_leaf_label')} AS k FROM row_dim WHERE table_type_id IS NOT NULL), r AS (SELECT table_type_id, k, min(leaf) AS leaf FROM k WHERE leaf <> '' AND k <> '' GROUP BY 1, 2 HAVING min(leaf) = max(leaf)),
l AS (SELECT table_type_id, k, label FROM k WHERE k <> '' GROUP BY 1, 2, 3 HAVING NOT bool_or(coalesce(leaf <> '', false))) SELECT l.table_type_id, label AS alias, r.leaf AS canonical_leaf_id FROM l JOIN r USING (table_type_id, k)
""")
def footnote_aliases(spark: SparkSession, d: str) -> DataFrame:
    """Labels that are another spelling of a resolved one."""
    return U.known_by_key(table(spark, d, "row_dim").select("table_type_id", c("row_leaf_label").alias("label"), "canonical_leaf_id").distinct())


STAGES = ["view", "click", "purchase"]


@query(f"""
WITH s(stage, place) AS (VALUES {", ".join(f"('{x}', {i})" for i, x in enumerate(STAGES, 1))}), u AS (SELECT user_id, max(place) AS far FROM events LEFT JOIN s ON stage = event_type GROUP BY 1), e AS (SELECT DISTINCT user_id, event_type FROM events)
SELECT u.user_id, stage, CASE WHEN e.user_id IS NOT NULL THEN 'done' WHEN place < far THEN 'skipped' WHEN place = far + 1 THEN 'next' ELSE 'pending' END AS state FROM u CROSS JOIN s LEFT JOIN e ON e.user_id = u.user_id AND e.event_type = stage
""")
def stage_states(spark: SparkSession, d: str) -> DataFrame:
    """How far each user's events have come."""
    return U.stage_states(table(spark, d, "events").select("user_id", "event_type"), "user_id", STAGES)
