"""Queries of the text and training-data problems, and the SQL they are held against."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.confusables import disguised, groups
from ledgerloom.llm.mapping import map_labels
from ledgerloom.llm.mixing import mix
from ledgerloom.llm.survivors import discover_truth, survivors
from ledgerloom.llm.tokens import count_tokens, encode_corpus
from ledgerloom.llm.truncation import find_truncated, truncation_rates
from ledgerloom.runtime import small_side, table

METRIC = ["institution", "concept_key", "period_text", "period_span", "segment_key", "geo_key", "industry_key", "legal_entity"]
RECORD = ["doc_id", "table_id", "row_id", "col_id"]
#: The whole-book member that a null axis means, and the trust in a record's identity. Fixed values.
DEFAULTS = {"segment_key": "SEG_TOTAL", "geo_key": "GLOBAL", "industry_key": "IND_TOTAL", "legal_entity": "CONSOLIDATED"}
TRUST = ["human_anchor", "masterlist", "alias", "llm"]


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Printed cell texts and row labels with their places."""
    cells = table(spark, sf_dir, "cell_fact").select(F.lit("cell_fact").alias("rel"), "doc_id", F.col("table_id").alias("table_key"), F.col("row_id").alias("row_no"), F.col("col_id").alias("col_no"), F.col("value_raw").alias("text"))
    tables = table(spark, sf_dir, "parsed").select("unit_id", F.posexplode("tables").alias("t", "one"))
    rows = tables.select("unit_id", "t", F.posexplode("one.rows").alias("r", "row"))
    labels = rows.select(F.lit("parsed").alias("rel"), F.col("unit_id").alias("doc_id"), F.col("t").cast("string").alias("table_key"), F.col("r").alias("row_no"), F.lit(-1).alias("col_no"), F.col("row.label").alias("text"))
    return cells.unionByName(labels)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disguised(_texts(spark, sf_dir), ["rel", "doc_id", "table_key", "row_no", "col_no"])


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts by equal skeleton: the one consistent form, and how many texts, records and disguises it stands for."""
    return groups(_texts(spark, sf_dir).select("text")).drop("foreign")


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """v_cell records that state a metric, each once, with the metric's eight columns."""
    cells = table(spark, sf_dir, "v_cell").where("concept_key is not null").withColumn("period_text", F.date_format("period", "yyyy-MM-dd"))
    cells = cells.withColumns({k: F.coalesce(k, F.lit(v)) for k, v in DEFAULTS.items()})
    return cells.select(*METRIC, *RECORD, "value_num", "unit", "line_no", "identity_source").dropDuplicates(RECORD)


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings = small_side(table(spark, sf_dir, "filing").groupBy("doc_id").agg(F.max("doc_period").alias("doc_period")))
    rows = _metrics(spark, sf_dir).join(filings, "doc_id", "left")
    trust = F.lit(len(TRUST))
    for i, name in enumerate(TRUST):
        trust = F.when(F.col("identity_source") == name, i).otherwise(trust)
    found = survivors(rows, METRIC, ["value_num", "unit", "line_no"], [trust, -F.unix_date("doc_period")], RECORD)
    return found.select(*METRIC, "field_name", *RECORD)


def _claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), v.alias("value")) for f, v in (("value_num", F.when(~F.isnan("value_num"), F.format_string("%.8e", "value_num"))), ("unit", F.col("unit")), ("line_no", F.col("line_no")))])
    rows = _metrics(spark, sf_dir).select(*METRIC, F.explode(fields).alias("f"), F.coalesce("identity_source", F.lit("none")).alias("source"))
    return rows.select(*METRIC, "f.field_name", "f.value", "source")


#: Trust in a source before any votes are counted.
PRIOR = {"human_anchor": 0.95, "masterlist": 0.9, "alias": 0.8, "llm": 0.7, "none": 0.6}


def p6_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of each field of each metric that iterative truth discovery supports most."""
    truths, _ = discover_truth(_claims(spark, sf_dir), METRIC, PRIOR)
    return truths


def p6_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How reliable truth discovery finds each identity source."""
    _, reliability = discover_truth(_claims(spark, sf_dir), METRIC, PRIOR)
    return reliability


def p6_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each field how many survivors by precedence truth discovery also finds, and how many it does not."""
    truths = p6_truth(spark, sf_dir).select(*[F.col(k).alias(f"t_{k}") for k in METRIC], F.col("field_name").alias("t_field"), F.col("value").alias("truth"))
    fields = F.create_map(F.lit("value_num"), F.format_string("%.8e", "value_num"), F.lit("unit"), F.col("unit"), F.lit("line_no"), F.col("line_no"))
    records = _metrics(spark, sf_dir).select(*[F.col(x).alias(f"r_{x}") for x in RECORD], fields.alias("fields"))
    found = p6_found(spark, sf_dir)
    same = [F.col(x).eqNullSafe(F.col(f"r_{x}")) for x in RECORD]
    stated = found.join(records, reduce(and_, same)).select(*METRIC, "field_name", F.col("fields")[F.col("field_name")].alias("stated"))
    both = stated.join(truths, reduce(and_, [F.col(k).eqNullSafe(F.col(f"t_{k}")) for k in METRIC] + [F.col("field_name") == F.col("t_field")]))
    agreed = (F.col("stated") == F.col("truth")).cast("long")
    return both.groupBy("field_name").agg(F.count("*").alias("survivors"), F.sum(agreed).alias("same"), F.sum(1 - agreed).alias("other"))


def _mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = table(spark, sf_dir, "canonical_leaf_alias").select("alias_id", F.col("table_type_id").alias("scope"), F.col("alias_row_label_norm").alias("label"))
    entries = table(spark, sf_dir, "concept_map").select(F.col("table_type").alias("scope"), F.col("label_norm").alias("label"), F.col("concept_key").alias("concept"))
    return map_labels(aliases, entries)


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    # an alias stated twice has one answer: the best
    best = F.min(F.struct((-F.col("score")).alias("s"), F.col("concept").alias("concept"))).alias("b")
    return _mapped(spark, sf_dir).groupBy("alias_id").agg(best).select("alias_id", F.col("b.concept").alias("concept_key"))


def p7_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alias with the answer, its score and how it was found."""
    return _mapped(spark, sf_dir)


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is used in the mix."""
    sized = count_tokens(table(spark, sf_dir, "documents"), ["doc_id", "source"])
    return mix(sized, table(spark, sf_dir, "mix_target"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source."""
    sized = count_tokens(table(spark, sf_dir, "documents"), ["doc_id", "source"])
    return mix(sized, table(spark, sf_dir, "mix_target"))[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_truncated(table(spark, sf_dir, "documents")).select("doc_id").distinct()


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates."""
    documents = table(spark, sf_dir, "documents")
    return truncation_rates(documents, find_truncated(documents))


QUERIES = {f.__name__: f for f in (p3_found, p3_groups, p6_found, p6_truth, p6_sources, p6_agreement, p7_found, p7_scores, p8_ids, p9_mix, p9_shares, p10_found, p10_rates)}

ORACLES = {
    "p6_found": """
WITH v AS (SELECT DISTINCT institution, concept_key, strftime(period, '%Y-%m-%d') period_text, period_span, coalesce(segment_key, 'SEG_TOTAL') segment_key, coalesce(geo_key, 'GLOBAL') geo_key,
 coalesce(industry_key, 'IND_TOTAL') industry_key, coalesce(legal_entity, 'CONSOLIDATED') legal_entity, doc_id, table_id, row_id, col_id, value_num, unit, line_no, identity_source FROM v_cell WHERE concept_key IS NOT NULL),
n AS (SELECT *, count(*) OVER (PARTITION BY institution, concept_key, period_text, period_span, segment_key, geo_key, industry_key, legal_entity) n FROM v),
f AS (SELECT * FROM (SELECT *, 'value_num' field_name, value_num IS NOT NULL AND NOT isnan(value_num) has FROM n UNION ALL SELECT *, 'unit', unit IS NOT NULL FROM n UNION ALL SELECT *, 'line_no', line_no IS NOT NULL FROM n) WHERE has AND n > 1),
r AS (SELECT f.*, row_number() OVER (PARTITION BY institution, concept_key, period_text, period_span, segment_key, geo_key, industry_key, legal_entity, field_name
 ORDER BY CASE identity_source WHEN 'human_anchor' THEN 0 WHEN 'masterlist' THEN 1 WHEN 'alias' THEN 2 WHEN 'llm' THEN 3 ELSE 4 END, doc_period DESC NULLS LAST, f.doc_id, table_id, row_id, col_id) k
 FROM f LEFT JOIN (SELECT doc_id, max(doc_period) doc_period FROM filing GROUP BY 1) g USING (doc_id))
SELECT institution, concept_key, period_text, period_span, segment_key, geo_key, industry_key, legal_entity, field_name, doc_id, table_id, row_id, col_id FROM r WHERE k = 1
""",
}
