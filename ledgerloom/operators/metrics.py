"""The metrics layer: candidates to one value a metric, units filled in, ratios, breakdowns, duplicates, coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.generic import fill_only, gap_clusters, multiset_signature
from ledgerloom.runtime import small_side

c = F.col
GRAIN = ["institution", "concept_key", "period", "period_span", "segment_key", "geo_key", "industry_key", "legal_entity"]


def resolve_candidates(candidates: DataFrame, gap: float = 1.0) -> DataFrame:
    """One row a metric (GRAIN): value, n_candidates, n_clusters, resolved_by; input GRAIN, value_num, unit, tier, depth, anchored, place.

    Anchored candidates, where there are any, are the only ones. Values within ``gap`` of each other are one cluster;
    the cluster with the best tier wins, then the least deep, the most supported, the largest. Within it the most
    frequent value counts, equal ones by the smaller magnitude; the sign is that of most candidates.
    """
    rows = candidates.where("value_num is not null and not isnan(value_num)").withColumn("anchored", F.coalesce("anchored", F.lit(False)))
    # equal values are one row before any window, so a window is as long as a metric has different values
    sized = rows.groupBy(*GRAIN, "anchored", F.abs("value_num").alias("size")).agg(F.count("*").alias("n"), F.min("tier").alias("tier"), F.min("depth").alias("depth"), F.sum(F.signum("value_num")).alias("signs"), F.min_by("unit", F.struct("tier", "place")).alias("unit"))
    values = sized.withColumn("any", F.max("anchored").over(W.partitionBy(*GRAIN))).where("not any or anchored")
    values = gap_clusters(values, GRAIN, c("size"), ["size"], gap)
    best = F.min_by(F.struct("size", "unit"), F.struct((-c("n")), "size")).alias("b")
    clusters = values.groupBy(*GRAIN, "cluster").agg(best, F.sum("n").alias("n"), F.min("tier").alias("tier"), F.min("depth").alias("depth"), F.sum("signs").alias("signs"))
    rank = F.struct("tier", c("depth").isNull(), "depth", -c("n"), -c("b.size"))
    out = clusters.groupBy(*GRAIN).agg(F.min_by(F.struct("b", "signs", "n", "tier"), rank).alias("w"), F.sum("n").alias("n_candidates"), F.count("*").alias("n_clusters"), F.count_distinct("tier").alias("tiers"))
    how = F.when(c("n_candidates") == 1, "single").when(c("n_clusters") == 1, "cluster").when(c("tiers") > 1, "tier").otherwise("conflict")
    value = F.when(c("w.signs") < 0, -c("w.b.size")).otherwise(c("w.b.size"))
    return out.select(*GRAIN, value.alias("value_num"), c("w.b.unit").alias("unit"), "n_candidates", "n_clusters", how.alias("resolved_by"))


def infer_units(metrics: DataFrame) -> DataFrame:
    """Missing units filled: the only one the institution states for the concept, else the only one anybody does; else left null."""
    one = lambda by: metrics.where("unit is not null").groupBy(*by).agg(F.min("unit").alias("u"), F.count_distinct("unit").alias("n")).where("n = 1").drop("n")
    own, all_ = one(["institution", "concept_key"]).withColumnRenamed("u", "own"), one(["concept_key"]).withColumnRenamed("u", "all")
    out = metrics.join(own, ["institution", "concept_key"], "left").join(small_side(all_), "concept_key", "left")
    return out.withColumn("unit", F.coalesce("unit", "own", "all")).select(*metrics.columns)


def formulas(metrics: DataFrame, declared: Sequence[tuple[str, Column, Sequence[str]]]) -> DataFrame:
    """Metrics with declared formulas filled in where nothing is reported; (name, expression over concepts, concepts).

    Concepts become columns of one pivot with the names given; a formula with a missing part, or a base of 0, has no value.
    """
    keys = [k for k in GRAIN if k != "concept_key"]
    names = sorted({x for _, _, parts in declared for x in parts})
    wide = metrics.where(c("concept_key").isin(names)).groupBy(*keys).pivot("concept_key", names).agg(F.max("value_num"))
    made = F.array(*[F.struct(F.lit(n).alias("concept_key"), e.cast("double").alias("value_num")) for n, e, _ in declared])
    derived = wide.select(*keys, F.explode(made).alias("f")).select(*keys, "f.*").where("value_num is not null and not isnan(value_num)")
    base = metrics.select(*GRAIN, "value_num").withColumn("origin", F.lit("reported"))
    return fill_only(base, derived.withColumn("origin", F.lit("derived")).select(*base.columns), GRAIN)


def period_average(metrics: DataFrame) -> DataFrame:
    """Metrics with ``average``: the mean of a value and the one of the period before in its series; the first has only itself.

    A missing value takes that of the period before.
    """
    series = W.partitionBy(*[k for k in GRAIN if k != "period"]).orderBy("period")
    before = F.lag("value_num").over(series)
    return metrics.withColumn("average", F.coalesce((c("value_num") + before) / 2, c("value_num"), before))


def breakdown_cuts(cells: DataFrame) -> DataFrame:
    """Which dimension breaks each concept down, and how far: the widest cut of each (institution, concept, period), with its members.

    Members are distinct segments, places or industries other than the whole book; equal widths in that order.
    """
    cuts = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(n).alias("dimension"), F.when(c(k) != w, c(k)).alias("member")) for i, (n, k, w) in enumerate([("segment", "segment_key", "SEG_TOTAL"), ("place", "geo_key", "GLOBAL"), ("industry", "industry_key", "IND_TOTAL")])])
    rows = cells.where("concept_key is not null and value_num is not null").select("institution", "concept_key", "period", F.explode(cuts).alias("x")).select("institution", "concept_key", "period", "x.*").where("member is not null")
    sizes = rows.groupBy("institution", "concept_key", "period", "ord", "dimension").agg(F.count_distinct("member").alias("members"))
    best = F.max_by(F.struct("dimension", "members"), F.struct("members", -c("ord"))).alias("b")
    return sizes.groupBy("institution", "concept_key", "period").agg(best).select("institution", "concept_key", "period", "b.*")


def pick_canonical(tables: DataFrame, values: DataFrame) -> DataFrame:
    """(doc_id, table_id, canonical_id, quarantined): of tables of one filing and page that print the same values the one kept.

    ``tables``: doc_id, table_id, page, anchors, depth; ``values``: doc_id, table_id, value_raw. Most anchors, then the
    deeper hierarchy, then the smaller id.
    """
    signed = multiset_signature(values, ["doc_id", "table_id"], "value_raw").join(tables, ["doc_id", "table_id"])
    best = F.min_by("table_id", F.struct(-c("anchors"), -c("depth"), "table_id")).alias("canonical_id")
    keep = signed.groupBy("doc_id", "page", "signature").agg(best, F.count("*").alias("copies")).where("copies > 1")
    return signed.join(keep, ["doc_id", "page", "signature"]).select("doc_id", "table_id", "canonical_id", (c("table_id") != c("canonical_id")).alias("quarantined"))


def coverage_matrix(declared: DataFrame, rows: DataFrame, cells: DataFrame) -> DataFrame:
    """(institution, concept_key, status): absent (no such row), no structure, no value, no unit, or clean.

    ``declared``: institution, concept_key; ``rows``: institution, concept_key, canonical_leaf_id; ``cells``: institution, concept_key, value_num, unit.
    """
    keys = ["institution", "concept_key"]
    named = rows.groupBy(*keys).agg(F.count("*").alias("rows"), F.count("canonical_leaf_id").alias("stamped"))
    filled = cells.groupBy(*keys).agg(F.count("value_num").alias("values"), F.count(F.when(c("value_num").isNotNull(), c("unit"))).alias("units"))
    out = declared.distinct().join(named, keys, "left").join(filled, keys, "left")
    zero = lambda x: F.coalesce(c(x), F.lit(0)) == 0
    status = F.when(zero("rows"), "absent").when(zero("stamped"), "no structure").when(zero("values"), "no value").when(zero("units"), "no unit").otherwise("clean")
    return out.select(*keys, status.alias("status"))


def compare_metrics(built: DataFrame, stored: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """(GRAIN, status): metrics built anew beside stored ones: same, differs, only_built or only_stored; null keys match null keys."""
    a = built.groupBy(*GRAIN).agg(F.max("value_num").alias("a"), F.lit(1).alias("in_a"))
    b = stored.groupBy(*GRAIN).agg(F.max("value_num").alias("b"), F.lit(1).alias("in_b"))
    both = a.select(*GRAIN, "a", F.lit(None).cast("double").alias("b"), "in_a", F.lit(0).alias("in_b")).unionByName(b.select(*GRAIN, F.lit(None).cast("double").alias("a"), "b", F.lit(0).alias("in_a"), "in_b"))
    out = both.groupBy(*GRAIN).agg(F.max("a").alias("a"), F.max("b").alias("b"), F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    status = F.when(c("in_b") == 0, "only_built").when(c("in_a") == 0, "only_stored").when(F.coalesce(F.abs(c("a") - c("b")) <= tolerance, c("a").isNull() & c("b").isNull()), "same").otherwise("differs")
    return out.select(*GRAIN, status.alias("status"))
