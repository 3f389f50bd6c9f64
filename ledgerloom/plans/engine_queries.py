"""The disclosure engine's own operators over the test tables, each beside the SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.periods import is_flow, period_label, read_period, span_rank, span_start
from ledgerloom.functions.text import label_key, slug
from ledgerloom.functions.units import with_stated_unit
from ledgerloom.functions.values import cell_number, cell_state, expand_pages
from ledgerloom.operators import axes as A
from ledgerloom.operators import generic as G
from ledgerloom.plans import sql as Q
from ledgerloom.runtime import small_side, stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
c = F.col


def query(sql: str | None = None):
    """Registers a query under its function's name, with the SQL it is held against."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def exact(x: Column | str) -> Column:
    """A number as a decimal, so that sums do not depend on the order of rows."""
    return (c(x) if isinstance(x, str) else x).cast("decimal(28,4)")


def cells(spark: SparkSession, d: str) -> DataFrame:
    """v_cell, each record once."""
    return table(spark, d, "v_cell").dropDuplicates(["doc_id", "table_id", "row_id", "col_id"])


_CELL = "v AS (SELECT DISTINCT * FROM v_cell)"
_LABEL = "CASE WHEN {s} IN ('1Q','2Q','3Q','4Q','1H','2H','9M','FY') THEN {s} || strftime({p}, '%y') ELSE strftime({p}, '%d-%b-%y') END"
_SLICE = ("segment_key", "SEG_TOTAL"), ("geo_key", "GLOBAL"), ("industry_key", "IND_TOTAL"), ("legal_entity", "CONSOLIDATED")


def whole_book(df: DataFrame) -> DataFrame:
    """Null and blank axes as the whole-book member they mean."""
    return df.withColumns({k: F.when(F.trim(F.coalesce(k, F.lit(""))) == "", F.lit(v)).otherwise(c(k)) for k, v in _SLICE})


_WHOLE = ", ".join(f"CASE WHEN trim(coalesce({k}, '')) = '' THEN '{v}' ELSE {k} END AS {k}" for k, v in _SLICE)


# --- views -----------------------------------------------------------------------------------------------------


@query("""
WITH r AS (SELECT DISTINCT ON (doc_id, table_id, row_id) * FROM row_dim), f AS (SELECT DISTINCT ON (doc_id, table_id, row_id, col_id) * FROM cell_fact)
SELECT f.doc_id, f.table_id, f.row_id, f.col_id, d.institution, d.doc_family, d.doc_period, r.row_hierarchy, r.row_leaf_label, r.canonical_leaf_id, f.value_raw, f.value_num, f.cell_state, f.period, f.period_span,
 coalesce(f.concept_key, r.concept_key) concept_key, coalesce(f.unit, r.unit) unit
FROM f JOIN r USING (doc_id, table_id, row_id) JOIN filing d USING (doc_id)
""")
def view_cell_flat(spark: SparkSession, d: str) -> DataFrame:
    """Fact, row and filing in one row; the row's concept and unit where the fact has none."""
    rows = table(spark, d, "row_dim").dropDuplicates(["doc_id", "table_id", "row_id"]).select("doc_id", "table_id", "row_id", "row_hierarchy", "row_leaf_label", "canonical_leaf_id", c("concept_key").alias("row_concept"), c("unit").alias("row_unit"))
    facts = table(spark, d, "cell_fact").dropDuplicates(["doc_id", "table_id", "row_id", "col_id"])
    filings = small_side(table(spark, d, "filing").select("doc_id", "institution", "doc_family", "doc_period"))
    out = facts.join(rows, ["doc_id", "table_id", "row_id"]).join(filings, "doc_id")
    return out.select("doc_id", "table_id", "row_id", "col_id", "institution", "doc_family", "doc_period", "row_hierarchy", "row_leaf_label", "canonical_leaf_id", "value_raw", "value_num", "cell_state", "period", "period_span", F.coalesce("concept_key", "row_concept").alias("concept_key"), F.coalesce("unit", "row_unit").alias("unit"))


@query(f"""
WITH {_CELL} SELECT doc_id, table_id, col_id, count(*)::BIGINT leaves, count(*) FILTER (cell_state = 'reported' AND value_num IS NOT NULL)::BIGINT safe,
 sum(value_num::DECIMAL(28,4)) FILTER (cell_state = 'reported')::DOUBLE total, count(*) FILTER (cell_state = 'reported' AND value_num IS NOT NULL) < count(*) lower_bound
FROM v WHERE row_hierarchy >= 1 GROUP BY 1, 2, 3
""")
def sumsafe_lower_bound(spark: SparkSession, d: str) -> DataFrame:
    """Sums of the leaves that can be summed, and whether some cannot, so that the sum is a lower bound."""
    safe = (c("cell_state") == "reported") & c("value_num").isNotNull()
    out = cells(spark, d).where("row_hierarchy >= 1").groupBy("doc_id", "table_id", "col_id").agg(F.count("*").alias("leaves"), F.count(F.when(safe, 1)).alias("safe"), F.sum(F.when(safe, exact("value_num"))).cast("double").alias("total"))
    return out.withColumn("lower_bound", c("safe") < c("leaves"))


@query("SELECT (SELECT count(*) FROM filing) documents, (SELECT count(*) FROM (SELECT DISTINCT doc_id, table_id FROM row_dim)) tables, (SELECT count(*) FROM (SELECT DISTINCT doc_id, table_id, row_id FROM row_dim)) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT doc_id, table_id, row_id, col_id FROM cell_fact)) AS cell_count")
def corpus_counters(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id").distinct()
    parts = {
        "documents": table(spark, d, "filing").select(F.lit(1).alias("x")),
        "tables": rows.select("doc_id", "table_id").distinct(),
        "row_count": rows,
        "cell_count": table(spark, d, "cell_fact").select("doc_id", "table_id", "row_id", "col_id").distinct(),
    }
    counted = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, counted).agg(*[F.max(F.when(c("what") == name, c("n"))).alias(name) for name in parts])


# --- vintages, precedence, slices ---------------------------------------------------------------------------------


@query(f"""
WITH {_CELL}, r AS (SELECT v.*, row_number() OVER (PARTITION BY v.institution, table_type, concept_key, period, period_span, segment_key, geo_key, industry_key, legal_entity
 ORDER BY doc_period DESC NULLS LAST, v.doc_id, table_id, row_id, col_id) k FROM v LEFT JOIN (SELECT doc_id, doc_period FROM filing) f USING (doc_id) WHERE concept_key IS NOT NULL)
SELECT institution, table_type, concept_key, period, period_span, segment_key, geo_key, industry_key, legal_entity, doc_id, table_id, row_id, col_id, value_num FROM r WHERE k = 1
""")
def latest_vintage_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """One figure for each metric, period and slice: from the latest filing that states it."""
    keys = ["institution", "table_type", "concept_key", "period", "period_span", "segment_key", "geo_key", "industry_key", "legal_entity"]
    place = ["doc_id", "table_id", "row_id", "col_id"]
    rows = cells(spark, d).where("concept_key is not null").select(*keys, *place, "value_num").join(small_side(table(spark, d, "filing").select("doc_id", "doc_period")), "doc_id", "left")
    return G.latest_by(rows, keys, ["doc_period"], place).select(*keys, *place, "value_num")


@query(f"""
WITH {_CELL} SELECT doc_id, table_id, row_id, col_id, coalesce(col_unit, row_unit, table_unit, unit) unit,
 CASE WHEN col_unit IS NOT NULL THEN 'col' WHEN row_unit IS NOT NULL THEN 'row' WHEN table_unit IS NOT NULL THEN 'table' WHEN unit IS NOT NULL THEN 'stamp' END unit_source FROM v
""")
def precedence_coalesce(spark: SparkSession, d: str) -> DataFrame:
    """The first unit field that is filled, and which one it was."""
    value, source = G.precedence([("col", c("col_unit")), ("row", c("row_unit")), ("table", c("table_unit")), ("stamp", c("unit"))])
    return cells(spark, d).select("doc_id", "table_id", "row_id", "col_id", value.alias("unit"), source.alias("unit_source"))


@query(f"""
WITH {_CELL}, w AS (SELECT institution, concept_key, {_WHOLE}, value_num FROM v)
SELECT institution, concept_key, count(*) cells, sum(value_num::DECIMAL(28,4))::DOUBLE total FROM w
WHERE segment_key = 'SEG_TOTAL' AND geo_key = 'GLOBAL' AND industry_key = 'IND_TOTAL' AND legal_entity = 'CONSOLIDATED' GROUP BY 1, 2
""")
def default_member_slice(spark: SparkSession, d: str) -> DataFrame:
    """The whole-book slice: null axes mean the whole book."""
    base = whole_book(cells(spark, d).select("institution", "concept_key", *[k for k, _ in _SLICE], "value_num"))
    for k, v in _SLICE:
        base = base.where(c(k) == v)
    return base.groupBy("institution", "concept_key").agg(F.count("*").alias("cells"), F.sum(exact("value_num")).cast("double").alias("total"))


@query(f"""
WITH {_CELL}, n AS (SELECT doc_id, table_unit, count(*) n FROM (SELECT DISTINCT doc_id, table_id, table_unit FROM v) WHERE table_unit IS NOT NULL GROUP BY 1, 2),
m AS (SELECT doc_id, max(n) votes, sum(n)::BIGINT total FROM n GROUP BY 1)
SELECT doc_id, CASE WHEN count(*) = 1 THEN min(table_unit) END AS mode, votes, total AS "of" FROM n JOIN m USING (doc_id) WHERE n = votes GROUP BY doc_id, votes, total
""")
def modal_value_strict(spark: SparkSession, d: str) -> DataFrame:
    """The unit most tables of a filing state; none if two are equally frequent."""
    return G.strict_mode(cells(spark, d).select("doc_id", "table_id", "table_unit").distinct(), ["doc_id"], "table_unit")


# --- periods -------------------------------------------------------------------------------------------------------


@query(f"""
SELECT DISTINCT period, period_span, {_LABEL.format(s='period_span', p='period')} AS label,
 CASE period_span WHEN '2H' THEN make_date(year(period), 7, 1) WHEN '2Q' THEN make_date(year(period), 4, 1) WHEN '3Q' THEN make_date(year(period), 7, 1) WHEN '4Q' THEN make_date(year(period), 10, 1)
 WHEN '1Q' THEN make_date(year(period), 1, 1) WHEN '1H' THEN make_date(year(period), 1, 1) WHEN '9M' THEN make_date(year(period), 1, 1) WHEN 'FY' THEN make_date(year(period), 1, 1) END AS starts,
 CASE WHEN period_span IN ('1Q','2Q','3Q','4Q','1H','2H') THEN 0 WHEN period_span = '9M' THEN 1 WHEN period_span = 'FY' THEN 2 ELSE 3 END AS span_rank FROM cell_fact WHERE period IS NOT NULL
""")
def fiscal_period_label(spark: SparkSession, d: str) -> DataFrame:
    """Label, first day and rank of every period and span of the facts."""
    base = table(spark, d, "cell_fact").where("period is not null").select("period", "period_span").distinct()
    return base.select("period", "period_span", period_label(c("period"), c("period_span")).alias("label"), span_start(c("period_span"), c("period")).alias("starts"), span_rank(c("period_span")).alias("span_rank"))


@query(f"""
WITH {_CELL}, h AS (SELECT col_leaf_label, count(*) AS cells FROM v GROUP BY 1), {Q.period('h', 'col_leaf_label', 'p', True)}
SELECT col_leaf_label, cells, fin AS "end", span, {Q.starts('span', 'fin')} AS start, rest FROM p
""")
def period_parse(spark: SparkSession, d: str) -> DataFrame:
    """Periods read from the column headings, beside the stored ones."""
    heads = cells(spark, d).groupBy("col_leaf_label").agg(F.count("*").alias("cells"))
    return heads.withColumn("p", read_period(c("col_leaf_label"), column=True)).select("col_leaf_label", "cells", "p.end", "p.span", "p.start", "p.rest")


@query(f"""
WITH {_CELL}, f AS (SELECT doc_id, table_id, row_id, col_id, institution, period, value_num, table_type = 'balance' AS by_date, {_LABEL.format(s='period_span', p='period')} AS label FROM v WHERE value_num IS NOT NULL AND period IS NOT NULL),
a AS (SELECT DISTINCT {_LABEL.format(s='period_span', p='period')} AS label, period FROM v WHERE period_span IN ('1Q','2Q','3Q','4Q','1H','2H','9M','FY') AND period IS NOT NULL)
SELECT f.doc_id, f.table_id, f.row_id, f.col_id, a.label AS "column" FROM f JOIN a ON CASE WHEN f.by_date THEN f.period = a.period ELSE f.label = a.label END
""")
def stock_flow_placement(spark: SparkSession, d: str) -> DataFrame:
    """Facts on the columns of the fiscal axis: flows by label, balances on every column that closes on their date."""
    base = cells(spark, d).where("period is not null").select("doc_id", "table_id", "row_id", "col_id", "table_type", "period", "period_span", "value_num")
    axis = base.where(is_flow(c("period_span"))).select(period_label(c("period"), c("period_span")).alias("label"), c("period").alias("end")).distinct()
    facts = base.where("value_num is not null").select("doc_id", "table_id", "row_id", "col_id", c("period").alias("end"), period_label(c("period"), c("period_span")).alias("label"), F.coalesce(c("table_type") == "balance", F.lit(False)).alias("by_date"))
    return G.place_on_axis(facts, small_side(axis)).select("doc_id", "table_id", "row_id", "col_id", "column")


@query(f"""
WITH {_CELL}, p AS (SELECT institution, {_LABEL.format(s='period_span', p='period')} AS label, period, concept_key FROM v WHERE value_num IS NOT NULL AND concept_key IS NOT NULL AND period IS NOT NULL),
t AS (SELECT institution, count(DISTINCT concept_key) total FROM p GROUP BY 1)
SELECT institution, label, count(DISTINCT concept_key) items, total, round(count(DISTINCT concept_key) / total, 6) AS density FROM p JOIN t USING (institution) GROUP BY institution, label, total HAVING count(DISTINCT concept_key) / total >= 0.2
""")
def density_prune(spark: SparkSession, d: str) -> DataFrame:
    """Period columns that hold at least a fifth of an institution's items; thinner ones are fragments."""
    base = cells(spark, d).where("value_num is not null and concept_key is not null and period is not null").select("institution", period_label(c("period"), c("period_span")).alias("label"), "concept_key").distinct()
    total = base.select("institution", "concept_key").distinct().groupBy("institution").agg(F.count("*").alias("total"))
    out = base.groupBy("institution", "label").agg(F.count("*").alias("items")).join(small_side(total), "institution")
    return out.withColumn("density", F.round(c("items") / c("total"), 6)).where(c("items") / c("total") >= 0.2)


@query(f"""
WITH {_CELL}, b(basis, ord, span) AS (VALUES ('fy',0,'FY'),('half',1,'1H'),('half',1,'2H'),('quarter_cum',2,'1Q'),('quarter_cum',2,'2Q'),('quarter_cum',2,'3Q'),('quarter_cum',2,'9M'),('quarter',3,'1Q'),('quarter',3,'2Q'),('quarter',3,'3Q'),('quarter',3,'4Q'),('as_at',4,'as_at')),
n AS (SELECT institution, basis, ord, count(DISTINCT (period, span)) periods FROM v JOIN b ON period_span = span WHERE period IS NOT NULL GROUP BY 1, 2, 3)
SELECT institution, basis, periods FROM (SELECT *, row_number() OVER (PARTITION BY institution ORDER BY periods DESC, ord) k FROM n) WHERE k = 1
""")
def default_basis(spark: SparkSession, d: str) -> DataFrame:
    """The basis with the most periods of an institution; equal ones in declared order."""
    from ledgerloom.functions.periods import BASES

    base = cells(spark, d).where("period is not null").select("institution", "period", "period_span").distinct()
    pairs = F.array(*[F.struct(F.lit(b).alias("basis"), F.lit(i).alias("ord"), F.lit(s).alias("span")) for i, (b, spans) in enumerate(BASES.items()) for s in spans])
    rows = base.withColumn("b", F.explode(pairs)).where("b.span = period_span").groupBy("institution", "b.basis", "b.ord").agg(F.count("*").alias("periods"))
    return rows.groupBy("institution").agg(F.min_by(F.struct("basis", "periods"), F.struct(-c("periods"), "ord")).alias("x")).select("institution", "x.*")


# --- order and hierarchy ----------------------------------------------------------------------------------------------


@query("""
WITH s AS (SELECT DISTINCT doc_id, section_id, seq, section_level, section_title FROM toc_section)
SELECT doc_id, section_id, CASE WHEN section_level <> 1 THEN last_value(CASE WHEN section_level = 1 THEN section_title END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY seq, section_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS banner FROM s
""")
def banner_fill_down(spark: SparkSession, d: str) -> DataFrame:
    """The heading of level 1 above each section."""
    base = table(spark, d, "toc_section").select("doc_id", "section_id", "seq", "section_level", "section_title").distinct()
    return G.fill_down(base, ["doc_id"], ["seq", "section_id"], F.when(c("section_level") == 1, c("section_title")), "banner").select("doc_id", "section_id", "banner")


@query("""
WITH r AS (SELECT DISTINCT doc_id, table_id, row_id, row_hierarchy FROM row_dim)
SELECT a.doc_id, a.table_id, a.row_id, max(b.row_id) AS parent FROM r a LEFT JOIN r b ON a.doc_id = b.doc_id AND a.table_id = b.table_id AND b.row_id < a.row_id AND b.row_hierarchy < a.row_hierarchy GROUP BY 1, 2, 3
""")
def nearest_shallower_parent(spark: SparkSession, d: str) -> DataFrame:
    """Each row's nearest earlier row that is strictly less deep."""
    base = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id", "row_hierarchy").distinct()
    return G.nearest_shallower(base, ["doc_id", "table_id"], "row_id", "row_hierarchy", "parent").drop("row_hierarchy")


@query("""
WITH r AS (SELECT DISTINCT doc_id, table_id, row_id, row_hierarchy FROM row_dim)
SELECT a.doc_id, a.table_id, a.row_id, max(b.row_id) AS parent FROM r a LEFT JOIN r b ON a.doc_id = b.doc_id AND a.table_id = b.table_id AND b.row_id < a.row_id AND b.row_hierarchy = a.row_hierarchy - 1 GROUP BY 1, 2, 3
""")
def level_parent(spark: SparkSession, d: str) -> DataFrame:
    """Each row's nearest earlier row of the level just above, whatever lies between."""
    base = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id", "row_hierarchy").distinct()
    return G.level_parent(base, ["doc_id", "table_id"], "row_id", "row_hierarchy", "parent").drop("row_hierarchy")


@query("""
WITH RECURSIVE r AS (SELECT doc_id, table_id, row_id, min(row_parent) p, min(row_leaf_label) l FROM row_dim GROUP BY 1, 2, 3),
w AS (SELECT doc_id, table_id, row_id, p, l AS path, 1 AS depth FROM r UNION ALL SELECT w.doc_id, w.table_id, w.row_id, r.p, r.l || ' > ' || w.path, depth + 1 FROM w JOIN r ON r.doc_id = w.doc_id AND r.table_id = w.table_id AND r.row_id = w.p WHERE depth < 12)
SELECT doc_id, table_id, row_id, arg_max(path, depth) AS lineage, max(depth) AS depth FROM w GROUP BY 1, 2, 3
""")
def lineage_path(spark: SparkSession, d: str) -> DataFrame:
    """Labels from the root row down to each row: the whole chain of parents, by doubling joins. A chain that never ends is an error."""
    rows = table(spark, d, "row_dim").groupBy("doc_id", "table_id", "row_id").agg(F.min("row_parent").alias("ptr"), F.min("row_leaf_label").alias("path")).withColumn("depth", F.lit(1))
    known = rows.select("doc_id", "table_id", c("row_id").alias("ptr"), F.lit(True).alias("known"))
    rows = rows.join(known, ["doc_id", "table_id", "ptr"], "left").select("doc_id", "table_id", "row_id", F.when(c("known"), c("ptr")).alias("ptr"), "path", "depth")
    most = rows.groupBy("doc_id", "table_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(most.bit_length() + 1):
        rows = stage(rows)
        if rows.where("ptr is not null").isEmpty():
            break
        ahead = rows.select("doc_id", "table_id", c("row_id").alias("ptr"), c("ptr").alias("next"), c("path").alias("above"), c("depth").alias("more"))
        rows = rows.join(ahead, ["doc_id", "table_id", "ptr"], "left").select("doc_id", "table_id", "row_id", c("next").alias("ptr"), F.when(c("more").isNull(), c("path")).otherwise(F.concat(c("above"), F.lit(" > "), c("path"))).alias("path"), (c("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
    else:
        raise ValueError("rows of row_dim name each other as parents in a circle")
    return rows.select("doc_id", "table_id", "row_id", c("path").alias("lineage"), "depth")


@query(f"""
WITH {_CELL}, r AS (SELECT DISTINCT ON (doc_id, table_id, row_id) doc_id, table_id, row_id, row_parent FROM row_dim), k AS (SELECT v.*, row_parent FROM v JOIN r USING (doc_id, table_id, row_id)),
s AS (SELECT doc_id, table_id, row_parent AS row_id, col_id, count(*) parts, sum(value_num::DECIMAL(28,4)) total FROM k WHERE value_num IS NOT NULL AND row_parent IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT doc_id, table_id, row_id, col_id, parts, total::DOUBLE AS parts_total, (value_num::DECIMAL(28,4))::DOUBLE AS stated, abs(total - value_num::DECIMAL(28,4)) <= greatest(1, parts) AS adds_up FROM s JOIN v USING (doc_id, table_id, row_id, col_id) WHERE value_num IS NOT NULL
""")
def sum_to_total(spark: SparkSession, d: str) -> DataFrame:
    """Whether the parts below a row add up to the figure it states, to within one unit a part."""
    parents = table(spark, d, "row_dim").dropDuplicates(["doc_id", "table_id", "row_id"]).select("doc_id", "table_id", "row_id", "row_parent")
    base = cells(spark, d).where("value_num is not null").select("doc_id", "table_id", "row_id", "col_id", exact("value_num").alias("v"))
    parts = base.join(parents.where("row_parent is not null"), ["doc_id", "table_id", "row_id"]).groupBy("doc_id", "table_id", c("row_parent").alias("row_id"), "col_id").agg(F.count("*").alias("parts"), F.sum("v").alias("total"))
    out = parts.join(base, ["doc_id", "table_id", "row_id", "col_id"])
    return out.select("doc_id", "table_id", "row_id", "col_id", "parts", c("total").cast("double").alias("parts_total"), c("v").cast("double").alias("stated"), (F.abs(c("total") - c("v")) <= F.greatest(F.lit(1), "parts")).alias("adds_up"))


# --- metrics -----------------------------------------------------------------------------------------------------------

_MEMBERS = [("net_interest", "pnl.interest_earned_on_lending", 1), ("net_interest", "pnl.interest_paid_on_funding", -1), ("fees_and_markets", "pnl.fees", 1), ("fees_and_markets", "pnl.markets", 1), ("net_assets", "bs.assets", 1), ("net_assets", "bs.liabilities", -1)]
_MEMBER_SQL = "m(item, concept_key, sign) AS (VALUES " + ", ".join(f"('{a}', '{b}', {s})" for a, b, s in _MEMBERS) + ")"


@query(f"""
WITH {_MEMBER_SQL}, n AS (SELECT item, count(*) declared FROM m GROUP BY 1),
f AS (SELECT DISTINCT institution, concept_key, period, period_span, segment_key, geo_key, industry_key, legal_entity, value_num FROM fact_metric WHERE value_num IS NOT NULL AND NOT isnan(value_num) AND period IS NOT NULL),
g AS (SELECT institution, concept_key, period, period_span, max(value_num) value_num FROM f WHERE segment_key = 'SEG_TOTAL' AND geo_key = 'GLOBAL' AND legal_entity = 'CONSOLIDATED' GROUP BY 1, 2, 3, 4)
SELECT item, institution, period, period_span, sum(sign * value_num::DECIMAL(28,4))::DOUBLE AS value, count(DISTINCT concept_key) AS members, declared, count(DISTINCT concept_key) = declared AS complete
FROM g JOIN m USING (concept_key) JOIN n USING (item) GROUP BY item, institution, period, period_span, declared
""")
def signed_composition(spark: SparkSession, d: str) -> DataFrame:
    """Declared items as signed sums of metrics, with how many of their members are there."""
    members = spark.createDataFrame(_MEMBERS, "item string, concept_key string, sign int")
    facts = table(spark, d, "fact_metric").where("value_num is not null and not isnan(value_num) and period is not null and segment_key = 'SEG_TOTAL' and geo_key = 'GLOBAL' and legal_entity = 'CONSOLIDATED'")
    facts = facts.groupBy("institution", "concept_key", "period", "period_span").agg(exact(F.max("value_num")).alias("value_num"))
    return G.signed_composition(facts, members, ["concept_key"], ["institution", "period", "period_span"]).withColumn("value", c("value").cast("double"))


@query(f"""
WITH {_CELL}, a AS (SELECT institution, concept_key, period, doc_id, table_id, row_id, col_id, abs(value_num) v FROM v WHERE value_num IS NOT NULL AND concept_key IS NOT NULL),
b AS (SELECT *, CASE WHEN v - lag(v) OVER w > 1.0 THEN 1 ELSE 0 END nw FROM a WINDOW w AS (PARTITION BY institution, concept_key, period ORDER BY v, doc_id, table_id, row_id, col_id))
SELECT institution, concept_key, period, doc_id, table_id, row_id, col_id, 1 + sum(nw) OVER (PARTITION BY institution, concept_key, period ORDER BY v, doc_id, table_id, row_id, col_id)::BIGINT AS cluster FROM b
""")
def cluster_gap(spark: SparkSession, d: str) -> DataFrame:
    """Figures stated for one metric, in clusters a step of more than 1 apart."""
    base = cells(spark, d).where("value_num is not null and concept_key is not null").select("institution", "concept_key", "period", "doc_id", "table_id", "row_id", "col_id", "value_num")
    return G.gap_clusters(base, ["institution", "concept_key", "period"], F.abs("value_num"), ["doc_id", "table_id", "row_id", "col_id"], 1.0).drop("value_num")


@query("""
WITH s AS (SELECT institution, concept_key, period, period_span, segment_key, max(value_num) x FROM fact_metric WHERE value_num IS NOT NULL AND NOT isnan(value_num) AND segment_key <> 'SEG_TOTAL' AND geo_key = 'GLOBAL' AND legal_entity = 'CONSOLIDATED' GROUP BY 1, 2, 3, 4, 5),
m AS (SELECT count(DISTINCT segment_key) n FROM fact_metric WHERE segment_key <> 'SEG_TOTAL'),
g AS (SELECT institution, concept_key, period, period_span, sum(x::DECIMAL(28,4))::DOUBLE x, count(*) n FROM s GROUP BY 1, 2, 3, 4),
t AS (SELECT institution, concept_key, period, period_span, max(value_num) x FROM fact_metric WHERE value_num IS NOT NULL AND NOT isnan(value_num) AND segment_key = 'SEG_TOTAL' AND geo_key = 'GLOBAL' AND legal_entity = 'CONSOLIDATED' GROUP BY 1, 2, 3, 4)
SELECT institution, concept_key, period, period_span, round(x, 4) AS value, 'reported' AS origin FROM t
UNION ALL SELECT g.institution, g.concept_key, g.period, g.period_span, round(g.x, 4), 'derived' FROM g, m WHERE g.n = m.n AND NOT EXISTS (SELECT 1 FROM t WHERE t.institution = g.institution AND t.concept_key = g.concept_key AND t.period IS NOT DISTINCT FROM g.period AND t.period_span IS NOT DISTINCT FROM g.period_span)
""")
def partition_rollup_fill_only(spark: SparkSession, d: str) -> DataFrame:
    """Whole-book metrics, filled from complete segment breakdowns where none is reported."""
    keys = ["institution", "concept_key", "period", "period_span"]
    rows = table(spark, d, "fact_metric").where("value_num is not null and not isnan(value_num) and geo_key = 'GLOBAL' and legal_entity = 'CONSOLIDATED'")
    whole = rows.where("segment_key = 'SEG_TOTAL'").groupBy(*keys).agg(F.round(F.max("value_num"), 4).alias("value")).withColumn("origin", F.lit("reported"))
    need = table(spark, d, "fact_metric").where("segment_key <> 'SEG_TOTAL'").agg(F.count_distinct("segment_key")).first()[0]
    parts = rows.where("segment_key <> 'SEG_TOTAL'").groupBy(*keys, "segment_key").agg(F.max("value_num").alias("x")).groupBy(*keys).agg(F.round(F.sum(exact("x")).cast("double"), 4).alias("value"), F.count("*").alias("n"))
    parts = parts.where(c("n") == need).select(*keys, "value", F.lit("derived").alias("origin"))
    return G.fill_only(whole, parts, keys)


# --- identity and lookups ---------------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT DISTINCT doc_id || '/' || table_id AS id, regexp_replace(canonical_leaf_id, '\\..*', '') k2, canonical_leaf_id AS key FROM row_dim WHERE canonical_leaf_id IS NOT NULL AND canonical_leaf_id <> ''),
m AS (SELECT DISTINCT table_type_id AS id, canonical_leaf_id AS key FROM row_dim WHERE canonical_leaf_id IS NOT NULL AND canonical_leaf_id <> '' AND table_type_id IS NOT NULL), s AS (SELECT id, count(*) declared FROM m GROUP BY 1)
SELECT t.id AS left_id, m.id AS right_id, count(*) AS shared, declared FROM t JOIN m USING (key) JOIN s ON s.id = m.id GROUP BY t.id, m.id, declared HAVING count(*) >= 2 AND count(*) >= 0.5 * declared
""")
def set_overlap_locate(spark: SparkSession, d: str) -> DataFrame:
    """Tables located in a list of table types: at least two leaves and half of the type's in common."""
    rows = table(spark, d, "row_dim").where("canonical_leaf_id is not null and canonical_leaf_id <> ''")
    tables = rows.select(F.concat_ws("/", "doc_id", "table_id").alias("id"), c("canonical_leaf_id").alias("key"))
    types = rows.where("table_type_id is not null").select(c("table_type_id").alias("id"), c("canonical_leaf_id").alias("key"))
    return G.overlap_match(tables, types)


_KEYED = "lower(trim(regexp_replace(regexp_replace({x}, '(\\s*(\\((note\\s*[0-9]{{1,3}}|[0-9]{{1,2}}|[a-c]|restated|unaudited|continued)\\)|/[a-z0-9]|[¹²³*])|\\s+[–—-]\\s+restated)+$', '', 'g'), '\\s+', ' ', 'g')))"


@query(f"""
WITH r AS (SELECT DISTINCT doc_id, table_id, row_id, table_type_id, row_leaf_label FROM row_dim),
k AS (SELECT *, trim(regexp_replace(replace(lower({_KEYED.format(x='row_leaf_label')}), '-', ' '), '[:,.]', '', 'g')) AS label_norm FROM r)
SELECT k.doc_id, k.table_id, k.row_id, coalesce(a.concept_key, b.concept_key) AS concept_key FROM k
LEFT JOIN (SELECT table_type, label_norm, min(concept_key) concept_key FROM concept_map WHERE table_type <> '*' GROUP BY 1, 2) a ON a.table_type = k.table_type_id AND a.label_norm = k.label_norm
LEFT JOIN (SELECT label_norm, min(concept_key) concept_key FROM concept_map WHERE table_type = '*' GROUP BY 1) b ON b.label_norm = k.label_norm
""")
def ranked_alias_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Concepts of row labels: the entry of the row's table type, else the one that holds for all types."""
    rows = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id", c("table_type_id").alias("table_type"), "row_leaf_label").distinct()
    norm = F.trim(F.regexp_replace(F.translate(label_key(c("row_leaf_label")), "-", " "), "[:,.]", ""))
    entries = small_side(table(spark, d, "concept_map").select("table_type", "label_norm", "concept_key"))
    return G.scoped_lookup(rows.withColumn("label_norm", norm), entries, "table_type", "label_norm", "concept_key").select("doc_id", "table_id", "row_id", "concept_key")


@query("""
WITH k AS (SELECT DISTINCT table_type, concept_key FROM concept_map WHERE table_type <> '*'), h AS (SELECT table_type, concept_key, count(*) hits, count(DISTINCT doc_id) docs, max(period) latest FROM (SELECT DISTINCT * FROM v_cell) GROUP BY 1, 2)
SELECT k.table_type, k.concept_key, coalesce(hits, 0) AS hits, coalesce(docs, 0) AS docs, latest FROM k LEFT JOIN h USING (table_type, concept_key)
""")
def coverage_left(spark: SparkSession, d: str) -> DataFrame:
    """Declared concepts with how often, in how many filings and how late they were captured; none is 0."""
    declared = table(spark, d, "concept_map").where("table_type <> '*'").select("table_type", "concept_key").distinct()
    seen = cells(spark, d).groupBy("table_type", "concept_key").agg(F.count("*").alias("hits"), F.count_distinct("doc_id").alias("docs"), F.max("period").alias("latest"))
    return declared.join(seen, ["table_type", "concept_key"], "left").select("table_type", "concept_key", F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("docs", F.lit(0)).alias("docs"), "latest")


@query("""
SELECT table_type, row_leaf_label, count(*) AS cells, count(DISTINCT doc_id) AS docs FROM (SELECT DISTINCT * FROM v_cell) v WHERE NOT EXISTS (SELECT 1 FROM concept_map m WHERE m.table_type = v.table_type AND m.concept_key = v.concept_key) GROUP BY 1, 2
""")
def unanchored_anti(spark: SparkSession, d: str) -> DataFrame:
    """Captured labels that no declared concept covers."""
    declared = table(spark, d, "concept_map").select("table_type", "concept_key").distinct()
    rest = cells(spark, d).select("doc_id", "table_type", "concept_key", "row_leaf_label").join(small_side(declared), ["table_type", "concept_key"], "left_anti")
    return rest.groupBy("table_type", "row_leaf_label").agg(F.count("*").alias("cells"), F.count_distinct("doc_id").alias("docs"))


@query(f"""
WITH {_CELL}, t AS (SELECT doc_id, table_id, count(*) n, list_sort(list(coalesce(value_raw, ''))) s FROM v GROUP BY 1, 2), k AS (SELECT s, count(*) copies FROM t GROUP BY 1 HAVING count(*) > 1)
SELECT doc_id, table_id, n, copies FROM t JOIN k USING (s)
""")
def duplicate_signature(spark: SparkSession, d: str) -> DataFrame:
    """Tables that print exactly the same values as another one, in whatever order."""
    rows = cells(spark, d).select("doc_id", "table_id", F.coalesce("value_raw", F.lit("")).alias("value"))
    signed = G.multiset_signature(rows, ["doc_id", "table_id"], "value")
    twice = signed.groupBy("signature").agg(F.count("*").alias("copies")).where("copies > 1")
    return signed.join(twice, "signature").select("doc_id", "table_id", "n", "copies")


@query("""
WITH w AS (SELECT doc_id, table_id, value_num AS value, count(*) wanted FROM (SELECT DISTINCT doc_id, table_id, row_id, col_id, value_num FROM cell_fact) WHERE value_num IS NOT NULL GROUP BY 1, 2, 3),
t AS (SELECT doc_id, table_id, value_num AS value, count(*) there FROM (SELECT DISTINCT doc_id, table_id, row_id, col_id, value_num FROM cell_serving) WHERE value_num IS NOT NULL GROUP BY 1, 2, 3)
SELECT doc_id, table_id, round(value, 6) AS value, wanted - least(wanted, coalesce(there, 0)) AS missing FROM w LEFT JOIN t USING (doc_id, table_id, value) WHERE wanted > coalesce(there, 0)
""")
def multiset_containment(spark: SparkSession, d: str) -> DataFrame:
    """Figures of the fact store that the serving copy holds less often in the same table."""
    key = ["doc_id", "table_id", "row_id", "col_id", "value_num"]
    one = lambda name: table(spark, d, name).select(*key).distinct().where("value_num is not null").select("doc_id", "table_id", c("value_num").alias("value"))
    return G.not_contained(one("cell_fact"), one("cell_serving"), ["doc_id", "table_id"], "value").withColumn("value", F.round("value", 6))


# --- scalar suites ---------------------------------------------------------------------------------------------------------


@query("""
SELECT DISTINCT value_raw, CASE WHEN trim(coalesce(value_raw, '')) = '' THEN 'empty' WHEN trim(value_raw) IN ('-', '–', '—') THEN 'null' WHEN trim(value_raw) = '#' THEN 'suppressed' WHEN trim(value_raw) = '0' THEN 'zero' ELSE 'reported' END AS state,
 CASE WHEN regexp_full_match(trim(value_raw), '\\(*\\s*(S\\$)?\\s*[-+]?(S\\$)?([0-9][0-9,]*\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?\\s*%?\\s*\\)*') THEN (CASE WHEN trim(value_raw) LIKE '(%)' THEN -1 ELSE 1 END) * try_cast(regexp_replace(replace(value_raw, 'S$', ''), '[(),%\\s]', '', 'g') AS DOUBLE) END AS number FROM cell_fact
""")
def parse_value(spark: SparkSession, d: str) -> DataFrame:
    """State and number of every printed token."""
    return table(spark, d, "cell_fact").select("value_raw").distinct().select("value_raw", cell_state(c("value_raw")).alias("state"), cell_number(c("value_raw")).alias("number"))


_UNIT_PLACES = f"""{Q.unit_of_cell('value_raw')} AS u_cell, CASE WHEN row_unit IS NOT NULL THEN {Q.unit_code('row_unit')} ELSE {Q.unit_of_label('row_leaf_label')} END AS u_row,
 CASE WHEN col_unit IS NOT NULL THEN {Q.unit_code('col_unit')} ELSE {Q.unit_of_heading('col_leaf_label')} END AS u_col, CASE WHEN table_unit IS NOT NULL THEN {Q.unit_code('table_unit')} ELSE {Q.unit_of_label('table_title')} END AS u_table"""
#: Records with the unit that counts.
UNITS_SQL = f"{Q.SPELT}, {_CELL}, n AS (SELECT *, {_UNIT_PLACES} FROM v), units AS (SELECT *, coalesce(u_cell, CASE WHEN u_row = 'percent' THEN u_row END, u_col, u_row, u_table) AS unit_code FROM n)"


@query(f"WITH {UNITS_SQL} SELECT doc_id, table_id, row_id, col_id, unit_code FROM units")
def parse_unit(spark: SparkSession, d: str) -> DataFrame:
    """The unit that counts for every cell."""
    return with_stated_unit(cells(spark, d)).select("doc_id", "table_id", "row_id", "col_id", "unit_code")


@query("SELECT DISTINCT row_leaf_label, trim(regexp_replace(lower(row_leaf_label), '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM row_dim")
def label_normalise(spark: SparkSession, d: str) -> DataFrame:
    """Slugs of all row labels."""
    return table(spark, d, "row_dim").select("row_leaf_label").distinct().withColumn("slug", slug(c("row_leaf_label")))


@query("""
WITH p(ranges) AS (VALUES ('3,5-7'), ('9-8, x,3'), ('12'), (''), ('1-3,2-5')), x AS (SELECT ranges, trim(unnest(string_split(ranges, ','))) part FROM p),
y AS (SELECT ranges, try_cast(split_part(part, '-', 1) AS INT) a, coalesce(try_cast(split_part(part, '-', 2) AS INT), try_cast(split_part(part, '-', 1) AS INT)) b FROM x WHERE regexp_full_match(part, '[0-9]+(\\s*-\\s*[0-9]+)?'))
SELECT DISTINCT ranges, unnest(generate_series(least(a, b), greatest(a, b)))::INT AS page FROM y
""")
def page_range_expand(spark: SparkSession, d: str) -> DataFrame:
    """Page ranges as rows."""
    ranges = spark.createDataFrame([("3,5-7",), ("9-8, x,3",), ("12",), ("",), ("1-3,2-5",)], "ranges string")
    return ranges.select("ranges", F.explode(expand_pages(c("ranges"))).alias("page"))


@query("""
WITH l(t, label, seg, ind) AS (VALUES (1,'Retail','S1',NULL),(1,'Corporate','S2',NULL),(1,'Others','S9','I9'),(1,'Total','SEG_TOTAL','IND_TOTAL'),(2,'Others','S9','I9'),(2,'Trade',NULL,'I1'),(3,'Trade',NULL,'I1'),(3,'Farms',NULL,'I2'),(3,'Others','S9','I9'),(3,NULL,NULL,NULL)),
n AS (SELECT t, count(*) FILTER (seg IS NOT NULL AND ind IS NULL AND seg <> 'SEG_TOTAL') ns, count(*) FILTER (ind IS NOT NULL AND seg IS NULL AND ind <> 'IND_TOTAL') ni FROM l GROUP BY 1)
SELECT t, label, CASE WHEN NOT coalesce(seg <> 'SEG_TOTAL' AND ind <> 'IND_TOTAL', false) OR (ns >= 2 AND ni < 2) THEN seg END AS segment_key, CASE WHEN NOT coalesce(seg <> 'SEG_TOTAL' AND ind <> 'IND_TOTAL', false) OR (ni >= 2 AND ns < 2) THEN ind END AS industry_key FROM l JOIN n USING (t)
""")
def axis_exclusivity(spark: SparkSession, d: str) -> DataFrame:
    """A label that is a member of two axes counts for the one that two other labels of its table name alone."""
    rows = [(1, "Retail", "S1", None), (1, "Corporate", "S2", None), (1, "Others", "S9", "I9"), (1, "Total", "SEG_TOTAL", "IND_TOTAL"), (2, "Others", "S9", "I9"), (2, "Trade", None, "I1"), (3, "Trade", None, "I1"), (3, "Farms", None, "I2"), (3, "Others", "S9", "I9"), (3, None, None, None)]
    base = spark.createDataFrame(rows, "t int, label string, seg string, ind string")
    base = base.withColumnsRenamed({"seg": "segment_key", "ind": "industry_key"})
    return A.exclusive(base, ["t"], {x: A.AXES[x] for x in ("segment_key", "industry_key")}).drop("ambiguous")


@query(f"""
WITH r AS (SELECT doc_id, table_id, row_id, min(row_leaf_label) AS label FROM row_dim GROUP BY 1, 2, 3),
x AS (SELECT {Q.label_key('row_leaf_label')} AS k, segment_key AS s, industry_key AS i, geo_key AS g FROM row_dim UNION ALL SELECT {Q.label_key('label')}, NULL, NULL, geo_key FROM geo_dim),
m AS (SELECT k, CASE WHEN min(s) = max(s) THEN min(s) END AS s, CASE WHEN min(i) = max(i) THEN min(i) END AS i, CASE WHEN min(g) = max(g) THEN min(g) END AS g FROM x WHERE k <> '' GROUP BY k),
l AS (SELECT r.*, s, i, g, coalesce(s <> 'SEG_TOTAL', false)::INT AS ms, coalesce(i <> 'IND_TOTAL', false)::INT AS mi, coalesce(g <> 'GLOBAL', false)::INT AS mg, (s IS NOT NULL)::INT + (i IS NOT NULL)::INT + (g IS NOT NULL)::INT AS n FROM r LEFT JOIN m ON k = {Q.label_key('label')}),
c AS (SELECT doc_id, table_id, count(*) FILTER (n = 1 AND ms = 1) AS ns, count(*) FILTER (n = 1 AND mi = 1) AS ni, count(*) FILTER (n = 1 AND mg = 1) AS ng FROM l GROUP BY 1, 2),
h AS (SELECT l.*, ms + mi + mg > 1 AS several, (ms = 1 AND ns >= 2)::INT AS hs, (mi = 1 AND ni >= 2)::INT AS hi, (mg = 1 AND ng >= 2)::INT AS hg FROM l JOIN c USING (doc_id, table_id))
SELECT doc_id, table_id, row_id, CASE WHEN NOT several OR (hs = 1 AND hi + hg = 0) THEN s END AS segment_key, CASE WHEN NOT several OR (hi = 1 AND hs + hg = 0) THEN i END AS industry_key, CASE WHEN NOT several OR (hg = 1 AND hs + hi = 0) THEN g END AS geo_key, several AND hs + hi + hg <> 1 AS ambiguous FROM h
""")
def axis_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Axis members that the row labels of all stored tables name, by the loader's operator."""
    stored = table(spark, d, "row_dim").withColumnRenamed("row_leaf_label", "label")
    rows = stored.groupBy("doc_id", "table_id", "row_id").agg(F.min("label").alias("label"))
    return A.resolve(rows, ["doc_id", "table_id"], A.member_map(stored, table(spark, d, "geo_dim"))).drop("label")


# --- reshaping -----------------------------------------------------------------------------------------------------------


@query(f"""
WITH {_CELL} SELECT doc_id, table_id, row_id, arg_min(value_num, (doc_id, col_id)) FILTER (col_id = 1 AND value_num IS NOT NULL) AS c1, arg_min(value_num, (doc_id, col_id)) FILTER (col_id = 2 AND value_num IS NOT NULL) AS c2, arg_min(value_num, (doc_id, col_id)) FILTER (col_id = 3 AND value_num IS NOT NULL) AS c3, arg_min(value_num, (doc_id, col_id)) FILTER (col_id = 4 AND value_num IS NOT NULL) AS c4 FROM v GROUP BY 1, 2, 3
""")
def pivot_first(spark: SparkSession, d: str) -> DataFrame:
    """Printed tables: one row a printed row, all its columns side by side, at least four."""
    base = cells(spark, d)
    columns = sorted({1, 2, 3, 4} | {r[0] for r in base.where("col_id is not null").select("col_id").distinct().collect()})
    wide = base.groupBy("doc_id", "table_id", "row_id").pivot("col_id", columns).agg(F.min_by("value_num", F.when(c("value_num").isNotNull(), c("col_id"))))
    return wide.select("doc_id", "table_id", "row_id", *[c(str(i)).alias(f"c{i}") for i in columns])


@query("""
SELECT doc_id, field, value FROM (UNPIVOT (SELECT doc_id, institution, doc_family, doc_period::VARCHAR AS doc_period FROM filing) ON institution, doc_family, doc_period INTO NAME field VALUE value)
""")
def unpivot_filing(spark: SparkSession, d: str) -> DataFrame:
    """Fields of the filings as rows; null fields give none."""
    base = table(spark, d, "filing").select("doc_id", "institution", "doc_family", c("doc_period").cast("string").alias("doc_period"))
    return base.unpivot("doc_id", ["institution", "doc_family", "doc_period"], "field", "value").where("value is not null")


@query(f"""
WITH {_CELL}, n AS (SELECT *, coalesce(regexp_matches(col_leaf_label, '^\\s*(\\+\\s*/\\s*\\(?-\\)?|change|movement|variance|% chg)', 'i'), false) AS derived FROM v) SELECT doc_id, table_id, col_id, CASE WHEN bool_or(derived) THEN 'derived' WHEN bool_or(regexp_matches(col_leaf_label, '^\\s*notes?\\s*$', 'i')) THEN 'reference' END AS col_role FROM n GROUP BY 1, 2, 3
""")
def column_roles(spark: SparkSession, d: str) -> DataFrame:
    """Columns that hold changes or references instead of figures; the others have no role."""
    label = c("col_leaf_label")
    role = F.when(label.rlike(r"(?i)^\s*(\+\s*/\s*\(?-\)?|change|movement|variance|% chg)"), 0).when(label.rlike(r"(?i)^\s*notes?\s*$"), 1)
    out = cells(spark, d).groupBy("doc_id", "table_id", "col_id").agg(F.min(role).alias("r"))
    return out.select("doc_id", "table_id", "col_id", F.when(c("r") == 0, "derived").when(c("r") == 1, "reference").alias("col_role"))


# --- checks: each returns what breaks it -----------------------------------------------------------------------------------


@query(f"WITH {_CELL} SELECT institution, concept_key, count(DISTINCT coalesce(unit, '<null>')) AS units FROM v WHERE concept_key IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT coalesce(unit, '<null>')) > 1")
def check_single_unit(spark: SparkSession, d: str) -> DataFrame:
    """Concepts that an institution states in more than one unit; none counts as one."""
    return cells(spark, d).where("concept_key is not null").groupBy("institution", "concept_key").agg(F.count_distinct(F.coalesce("unit", F.lit("<null>"))).alias("units")).where("units > 1")


@query(f"WITH {_CELL} SELECT doc_id, table_id, col_id, concept_key, count(DISTINCT row_id) AS used, string_agg(DISTINCT row_leaf_label, ' | ' ORDER BY row_leaf_label) AS labels FROM v WHERE concept_key IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT row_id) > 1")
def check_duplicate_concept(spark: SparkSession, d: str) -> DataFrame:
    """Concepts that stand on more than one row of a table's column."""
    rows = cells(spark, d).where("concept_key is not null")
    out = rows.groupBy("doc_id", "table_id", "col_id", "concept_key").agg(F.count_distinct("row_id").alias("used"), F.array_join(F.array_sort(F.collect_set("row_leaf_label")), " | ").alias("labels"))
    return out.where("used > 1")


@query(f"WITH {_CELL} SELECT doc_id, table_id, row_id, col_id FROM v WHERE table_type = 'results' AND period_span = 'as_at' AND concept_key LIKE 'pnl.%'")
def check_flow_as_at(spark: SparkSession, d: str) -> DataFrame:
    """Flows stamped as points in time."""
    return cells(spark, d).where("table_type = 'results' and period_span = 'as_at' and concept_key like 'pnl.%'").select("doc_id", "table_id", "row_id", "col_id")


@query("SELECT c.doc_id, c.table_id, c.row_id, c.col_id FROM (SELECT DISTINCT doc_id, table_id, row_id, col_id FROM cell_fact) c WHERE NOT EXISTS (SELECT 1 FROM row_dim r WHERE r.doc_id = c.doc_id AND r.table_id = c.table_id AND r.row_id = c.row_id)")
def check_orphan_cells(spark: SparkSession, d: str) -> DataFrame:
    """Facts without their row: the foreign key that parquet does not keep."""
    rows = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id").distinct()
    return table(spark, d, "cell_fact").select("doc_id", "table_id", "row_id", "col_id").distinct().join(rows, ["doc_id", "table_id", "row_id"], "left_anti")


@query("SELECT r.doc_id, r.table_id, r.row_id, r.canonical_leaf_id FROM (SELECT DISTINCT doc_id, table_id, row_id, canonical_leaf_id FROM row_serving) r WHERE nullif(r.canonical_leaf_id, '') IS NOT NULL AND r.canonical_leaf_id NOT IN (SELECT canonical_leaf_id FROM row_dim WHERE canonical_leaf_id IS NOT NULL)")
def check_unknown_identity(spark: SparkSession, d: str) -> DataFrame:
    """Identities served that the fact store does not know."""
    known = table(spark, d, "row_dim").select("canonical_leaf_id").where("canonical_leaf_id is not null").distinct()
    served = table(spark, d, "row_serving").select("doc_id", "table_id", "row_id", "canonical_leaf_id").distinct().where("canonical_leaf_id <> ''")
    return served.join(known, "canonical_leaf_id", "left_anti").select("doc_id", "table_id", "row_id", "canonical_leaf_id")


@query(f"""
WITH {_CELL}, w AS (SELECT DISTINCT institution, concept_key, period, legal_entity FROM v WHERE legal_entity IS NOT NULL AND concept_key IS NOT NULL) SELECT institution, concept_key, period, count(*) AS entities FROM w GROUP BY 1, 2, 3 HAVING count(*) > 1
""")
def check_one_legal_entity(spark: SparkSession, d: str) -> DataFrame:
    """Metrics stated for more than one legal entity, which must not be mixed."""
    rows = cells(spark, d).where("legal_entity is not null and concept_key is not null").select("institution", "concept_key", "period", "legal_entity").distinct()
    return rows.groupBy("institution", "concept_key", "period").agg(F.count("*").alias("entities")).where("entities > 1")


# --- process state --------------------------------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT user_id, event_id, ts, event_type, lag(event_type) OVER w p, count(*) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS attempt FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, event_id, event_type, attempt, coalesce(p = event_type, false) AS escalated FROM e
""")
def status_escalation(spark: SparkSession, d: str) -> DataFrame:
    """Attempts counted and immediate repeats escalated, from an append-only log of events."""
    order = W.partitionBy("user_id").orderBy("ts", "event_id")
    same = W.partitionBy("user_id", "event_type").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, 0)
    out = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    return out.select("user_id", "event_id", "event_type", F.count("*").over(same).alias("attempt"), F.coalesce(F.lag("event_type").over(order) == c("event_type"), F.lit(False)).alias("escalated"))
