"""The loader and the serving layer over the test tables: star schema of the parsed units, identities, grids, structure."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import axes as A
from ledgerloom.operators import identity as I
from ledgerloom.operators import serving as S
from ledgerloom.operators import structure as X
from ledgerloom.operators.load import breakdown_violations, build_star
from ledgerloom.plans import load_sql as L
from ledgerloom.plans import sql as Q
from ledgerloom.runtime import stage, table

QUERIES, ORACLES = {}, {}
c = F.col


def query(f=None, sql: str | None = None):
    """Registers a query under its function's name, with the SQL it is held against where there is any."""

    def register(g):
        QUERIES[g.__name__] = g
        if sql:
            ORACLES[g.__name__] = sql
        return g

    return register(f) if f else register


def units(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "parsed").select("unit_id", "doc_id", "tables").dropDuplicates(["unit_id"])


def axis_members(spark: SparkSession, d: str) -> DataFrame:
    """What labels name on each axis: the stored stamps of row_dim, and the places of geo_dim."""
    return A.member_map(table(spark, d, "row_dim").withColumnRenamed("row_leaf_label", "label"), table(spark, d, "geo_dim"))


def star(spark: SparkSession, d: str, *only: str) -> dict[str, DataFrame]:
    return build_star(units(spark, d), table(spark, d, "filing"), set(only), axis_members(spark, d))


@query(sql=L.CELLS_SQL)
def load_cells(spark: SparkSession, d: str) -> DataFrame:
    """Facts of the parsed units: value, state, unit, period and its source, axis members of the row, else the column, else the whole book."""
    return star(spark, d, "cell_fact")["cell_fact"]


@query(sql=L.ROWS_SQL)
def load_rows(spark: SparkSession, d: str) -> DataFrame:
    """Row axis: parents, verified totals, periods of rows and banners."""
    return star(spark, d, "row_dim")["row_dim"]


@query(sql=L.COLUMNS_SQL)
def load_columns(spark: SparkSession, d: str) -> DataFrame:
    """Column axis: banners, periods, legal entities, roles."""
    return star(spark, d, "col_dim")["col_dim"]


@query(sql=L.TABLES_SQL)
def load_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables with their ids."""
    return star(spark, d, "table_t")["table_t"]


@query(sql=L.WARNINGS_SQL)
def load_warnings(spark: SparkSession, d: str) -> DataFrame:
    """What the loader left out or could not verify."""
    return star(spark, d, "load_warning")["load_warning"]


@query(sql=L.SUMS_SQL)
def verified_totals(spark: SparkSession, d: str) -> DataFrame:
    """Members of totals with their signs, and totals that could not be verified."""
    return star(spark, d, "sums")["sums"]


@query(sql=L.COLUMN_SUMS_SQL)
def column_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """Total columns against the columns they add up."""
    return star(spark, d, "column_sums")["column_sums"]


@query(sql=L.BREAKDOWNS_SQL)
def check_breakdowns(spark: SparkSession, d: str) -> DataFrame:
    """Breakdowns that miss their own total: none."""
    return breakdown_violations(star(spark, d, "cell_fact", "sums"))


def _tables(spark: SparkSession, d: str) -> DataFrame:
    rows = units(spark, d).select("doc_id", "unit_id", F.posexplode("tables").alias("at", "t")).where("t is not null")
    from pyspark.sql import Window as W

    return rows.select("doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("unit_id", "at")).alias("table_no"), c("t.title").alias("title"), c("t.columns").alias("columns"), c("t.rows").alias("rows"))


@query(sql=L.WHOLE_SQL)
def merge_continuations(spark: SparkSession, d: str) -> DataFrame:
    """Tables joined with the parts that continue them."""
    return X.merge_continuations(_tables(spark, d)).select("doc_id", "table_no", "title", F.size("rows").alias("rows"), "parts")


@query(sql=L.DATE_BLOCKS_SQL)
def split_date_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Rows with the period block they stand in, where a table stacks several."""
    rows = _tables(spark, d).select("doc_id", "table_no", F.posexplode("rows").alias("at", "r"))
    rows = rows.select("doc_id", "table_no", (c("at") + 1).alias("row_id"), c("r.row_type").alias("row_type"), c("r.level").alias("level"), c("r.label").alias("label"), c("r.values").alias("values"))
    return X.split_blocks(rows, ["doc_id", "table_no"]).select("doc_id", "table_no", "row_id", "block", "caption")


@query(sql="""
WITH v AS (SELECT DISTINCT * FROM v_cell), r AS (SELECT DISTINCT doc_id || '/' || table_id AS id, doc_id, row_id, concat_ws('|', min(row_leaf_label), string_agg(coalesce(value_raw, ''), '|' ORDER BY col_id)) x FROM v GROUP BY doc_id, table_id, row_id), c AS (SELECT DISTINCT id, doc_id || '|' || x AS x FROM r),
n AS (SELECT id, count(*) n FROM c GROUP BY 1), p AS (SELECT a.id a, b.id b, count(*) shared FROM c a JOIN c b ON a.x = b.x AND a.id < b.id GROUP BY 1, 2)
SELECT p.a, p.b, shared, greatest(x.n, y.n) AS larger FROM p JOIN n x ON x.id = p.a JOIN n y ON y.id = p.b WHERE shared >= 0.9 * greatest(x.n, y.n)
""")
def duplicate_tables(spark: SparkSession, d: str) -> DataFrame:
    """Tables of one filing that print at least nine tenths of the same rows."""
    cells = table(spark, d, "v_cell")
    # one exchange: the rows of a table and its cells stay together; what else a record says only tells whether it is repeated
    nulls = reduce(add, [F.when(c(x).isNull(), F.lit(1 << i)).otherwise(0) for i, x in enumerate(cells.columns)])
    cell = F.struct(F.coalesce("col_id", F.lit(2**31 - 1)).alias("at"), F.coalesce("value_raw", F.lit("")).alias("x"), F.xxhash64(nulls, *cells.columns).alias("record"))
    cells = cells.select(F.concat("doc_id", F.lit("/"), "table_id").alias("id"), "doc_id", "row_id", "row_leaf_label", cell.alias("cell")).where("id is not null").repartition("id")
    rows = cells.groupBy("id", "doc_id", "row_id").agg(F.min("row_leaf_label").alias("label"), F.array_sort(F.collect_set("cell")).alias("cells"))
    return X.duplicate_tables(rows.select("id", F.concat_ws("|", "doc_id", "label", F.array_join(F.transform("cells", lambda y: y["x"]), "|")).alias("content")), copies=True)


def _master(spark: SparkSession, d: str) -> DataFrame:
    """A list of row identities made from the stored ones: the first label of each leaf of a table type."""
    rows = table(spark, d, "row_dim").where("canonical_leaf_id is not null and canonical_leaf_id <> '' and table_type_id is not null")
    first = rows.groupBy("table_type_id", "canonical_leaf_id").agg(F.min("row_leaf_label").alias("label"))
    return first.select(F.lit("*").alias("bank"), "table_type_id", F.regexp_extract("canonical_leaf_id", r"(\d+)$", 1).cast("int").alias("line_ordinal"), "canonical_leaf_id", "label", c("label").alias("full_path"), F.lit(None).cast("string").alias("source_family"))


@query(sql=r"""
WITH p AS (SELECT DISTINCT doc_id, table_id, row_id, row_leaf_label path FROM row_dim), m0 AS (SELECT table_type_id kind, canonical_leaf_id leaf, min(row_leaf_label) label FROM row_dim WHERE canonical_leaf_id <> '' AND table_type_id IS NOT NULL GROUP BY 1, 2),
m1 AS (SELECT kind, leaf, lower(trim(regexp_replace(label, '\s+', ' ', 'g'))) path, try_cast(nullif(regexp_extract(leaf, '([0-9]+)$', 1), '') AS INT) o FROM m0 WHERE label IS NOT NULL), m AS (SELECT * FROM m1 QUALIFY row_number() OVER (PARTITION BY kind, path ORDER BY o NULLS LAST, leaf) = 1),
n AS (SELECT kind, count(*) declared FROM m GROUP BY 1), q AS (SELECT DISTINCT doc_id, table_id, row_id, lower(trim(regexp_replace(path, '\s+', ' ', 'g'))) path FROM p WHERE path IS NOT NULL),
h AS (SELECT doc_id, table_id, kind, count(DISTINCT path) matched FROM q JOIN m USING (path) GROUP BY 1, 2, 3), l AS (SELECT h.*, declared, matched / declared AS share FROM h JOIN n USING (kind) WHERE matched >= 2 AND matched >= 0.5 * declared),
k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, table_id) claims, row_number() OVER (PARTITION BY doc_id, table_id ORDER BY share DESC, matched DESC, kind) rk, row_number() OVER (PARTITION BY kind ORDER BY share DESC, matched DESC, doc_id, table_id) best FROM l),
k2 AS (SELECT *, rk = 1 OR claims > 2 AS kept FROM k), k3 AS (SELECT *, bool_or(kept) OVER (PARTITION BY kind) anyone FROM k2), f AS (SELECT doc_id, table_id, kind FROM k3 WHERE kept OR (NOT anyone AND best = 1))
SELECT doc_id, table_id, row_id, kind AS table_type_id, leaf AS canonical_leaf_id, 'path' AS how FROM q JOIN f USING (doc_id, table_id) JOIN m USING (kind, path) QUALIFY row_number() OVER (PARTITION BY doc_id, table_id, row_id ORDER BY kind, leaf) = 1
""")
def identity_stamps(spark: SparkSession, d: str) -> DataFrame:
    """Row identities found again from the labels alone: tables located, contests decided, leaves copied from the list."""
    rows = table(spark, d, "row_dim").select("doc_id", "table_id", "row_id", c("row_leaf_label").alias("path")).distinct()
    tables = rows.select("doc_id", "table_id").distinct().select("doc_id", "table_id", F.lit("*").alias("bank"), F.lit(None).cast("string").alias("family"))
    master = _master(spark, d)
    return I.stamp_rows(rows, I.one_type(I.locate(tables, rows, master)), master)


def _served(spark: SparkSession, d: str) -> DataFrame:
    """v_cell in the form the serving layer reads: concept and table type as the address."""
    cells = table(spark, d, "v_cell").dropDuplicates(["doc_id", "table_id", "row_id", "col_id"]).join(table(spark, d, "filing").select("doc_id", "doc_period"), "doc_id", "left")
    role = F.when(c("col_leaf_label").rlike(r"(?i)^\s*(\+\s*/|change|movement)"), "derived")
    facts = cells.select(
        "institution", c("institution").alias("bank"), F.upper(F.when(c("table_type") == "balance", "fs_balance").otherwise(c("table_type"))).alias("table_type_id"), c("concept_key").alias("canonical_leaf_id"), F.lit(None).cast("string").alias("canonical_col_id"),
        "period", "period_span", "geo_key", "segment_key", "industry_key", "legal_entity", role.alias("col_role"), "value_num", "unit", "doc_period", "doc_id", "table_id", "row_id", "col_id",
    )
    return stage(S.latest_facts(S.servable(facts)))  # read for the anchors, the axis and the items


ANCHORS = [("Net interest", "RESULTS", "pnl.interest_earned_on_lending", 1, 1), ("Net interest", "RESULTS", "pnl.interest_paid_on_funding", -1, 2), ("Assets", "FS_BALANCE", "bs.assets", 1, 1), ("Fees", "RESULTS", "pnl.fees", 1, 1)]


def _anchors(facts: DataFrame) -> DataFrame:
    names = ["concept", "table_type_id", "canonical_leaf_id", "sign", "member_ordinal"]
    declared = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(names, row)]) for row in ANCHORS])
    banks = facts.select("bank").distinct()
    return banks.select("bank", F.explode(declared).alias("a")).select("bank", "a.*", F.lit(None).cast("string").alias("filter_by"))


_SPANS = "('1Q', '2Q', '3Q', '4Q', '1H', '2H', '9M', 'FY')"
_SERVED_SQL = rf"""
s AS (SELECT v.institution bank, upper(CASE WHEN table_type = 'balance' THEN 'fs_balance' ELSE table_type END) kind, concept_key leaf, period, period_span, coalesce(nullif(trim(geo_key), ''), 'GLOBAL') geo, coalesce(nullif(trim(segment_key), ''), 'SEG_TOTAL') seg,
 coalesce(nullif(trim(industry_key), ''), 'IND_TOTAL') ind, value_num, unit, doc_period, v.doc_id, table_id, row_id, col_id
 FROM (SELECT DISTINCT * FROM v_cell) v LEFT JOIN (SELECT doc_id, doc_period FROM filing) USING (doc_id)
 WHERE concept_key IS NOT NULL AND table_type IS NOT NULL AND period IS NOT NULL AND value_num IS NOT NULL AND coalesce(legal_entity, 'CONSOLIDATED') = 'CONSOLIDATED' AND NOT coalesce(regexp_matches(col_leaf_label, '(?i)^\s*(\+\s*/|change|movement)'), false)),
l AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY bank, kind, leaf, period, period_span, geo, seg, ind ORDER BY doc_period DESC NULLS LAST, doc_id, table_id, row_id, col_id) = 1),
x0 AS (SELECT DISTINCT period, period_span, coalesce(period_span IN {_SPANS}, false) flow FROM l),
x1 AS (SELECT period, period_span, CASE WHEN flow THEN period_span || strftime(period, '%y') ELSE strftime(period, '%d-%b-%y') END lab, CASE WHEN period_span IN ('1Q', '2Q', '3Q', '4Q', '1H', '2H') THEN 0 WHEN period_span = '9M' THEN 1 WHEN period_span = 'FY' THEN 2 ELSE 3 END rk FROM x0 WHERE flow OR NOT (SELECT max(flow) FROM x0)),
x AS (SELECT lab, period fin, period_span, row_number() OVER (ORDER BY period, rk, lab) place FROM (SELECT * FROM x1 QUALIFY row_number() OVER (PARTITION BY lab ORDER BY period, rk, period_span) = 1))"""
_ANCHOR_SQL = "a(concept, kind, leaf, sign, ord) AS (VALUES " + ", ".join(f"('{n}', '{t}', '{f}', {s}, {o})" for n, t, f, s, o in ANCHORS) + ")"


@query(sql=f"""
WITH {_SERVED_SQL}, {_ANCHOR_SQL}, f AS (SELECT l.*, concept, sign, ord, CASE WHEN a.kind LIKE 'FS_BALANCE%' THEN 1 ELSE 0 END dated FROM l JOIN a USING (kind, leaf) WHERE geo = 'GLOBAL' AND seg = 'SEG_TOTAL' AND ind = 'IND_TOTAL'),
p AS (SELECT f.*, x.lab, CASE WHEN f.period_span IN ('1Q', '2Q', '3Q', '4Q', '1H', '2H') THEN 0 WHEN f.period_span = '9M' THEN 1 WHEN f.period_span = 'FY' THEN 2 ELSE 3 END rk FROM f JOIN x ON CASE WHEN dated = 1 THEN f.period = x.fin ELSE x.lab = CASE WHEN f.period_span IN {_SPANS} THEN f.period_span || strftime(f.period, '%y') ELSE strftime(f.period, '%d-%b-%y') END END),
o AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY bank, concept, ord, lab ORDER BY doc_period DESC NULLS LAST, rk, period_span, doc_id, table_id, row_id, col_id) = 1),
n AS (SELECT concept, count(*) declared FROM a GROUP BY 1)
SELECT bank, concept, lab AS label, sum(sign * value_num::DECIMAL(28,4))::DOUBLE AS value, count(*) AS members, (array_agg(unit ORDER BY ord))[1] AS unit, string_agg(DISTINCT CASE WHEN sign < 0 THEN '-' ELSE '+' END || leaf, ' ' ORDER BY CASE WHEN sign < 0 THEN '-' ELSE '+' END || leaf) AS parts, declared, count(*) = declared AS complete
FROM o JOIN n USING (concept) GROUP BY bank, concept, lab, declared
""")
def serve_items(spark: SparkSession, d: str) -> DataFrame:
    """Anchored items of every institution on the fiscal axis, with the share of members that are there."""
    facts = _served(spark, d)
    return S.compose_items(facts, _anchors(facts), S.fiscal_axis(facts))


@query(sql=f"WITH {_SERVED_SQL} SELECT lab AS label, fin AS \"end\", period_span AS span, place FROM x")
def serve_axis(spark: SparkSession, d: str) -> DataFrame:
    """The fiscal axis."""
    return S.fiscal_axis(_served(spark, d))


@query(sql=f"""
WITH {_SERVED_SQL}, {_ANCHOR_SQL}, b AS (SELECT DISTINCT bank FROM l)
SELECT b.bank, a.kind AS table_type_id, a.leaf AS canonical_leaf_id, count(l.doc_id) AS hits, count(DISTINCT l.doc_id) AS docs, max(l.period) AS latest FROM b CROSS JOIN a LEFT JOIN l ON l.bank = b.bank AND l.kind = a.kind AND l.leaf = a.leaf GROUP BY 1, 2, 3
""")
def serve_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Anchors with hits, filings and latest period."""
    facts = _served(spark, d)
    return S.anchor_coverage(_anchors(facts), facts)
