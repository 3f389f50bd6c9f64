"""Reconciliation: what contradicts itself in metrics, cells and extracted tables. Each check returns its violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import small_side

c = F.col


def identity_violations(metrics: DataFrame, identities: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, total, stated, plain, signed): declared totals that neither the plain nor the signed sum of their members gives.

    ``metrics`` (by, concept_key, value), one row each; ``identities`` (total, concept_key, sign). A total is checked where
    it and all its members are stated, to within 1 or a hundredth of it, whichever is more.
    """
    of = identities.groupBy("total").agg(F.count("*").alias("declared"))
    value = c("value").cast("decimal(28,4)")
    sums = metrics.join(small_side(identities), "concept_key").groupBy("total", *by).agg(F.sum(value).cast("double").alias("plain"), F.sum(c("sign") * value).cast("double").alias("signed"), F.count("value").alias("n"))
    whole = sums.join(small_side(of), "total").where("n = declared")
    stated = metrics.select(*by, c("concept_key").alias("total"), c("value").alias("stated")).where("stated is not null")
    within = F.greatest(F.lit(1.0), F.abs("stated") / 100)
    off = lambda x: F.abs(c(x) - c("stated")) > within
    return whole.join(stated, ["total", *by]).where(off("plain") & off("signed")).select(*by, "total", "stated", "plain", "signed")


def ratio_violations(metrics: DataFrame, ratios: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, ratio, stated, computed): stated ratios in per cent that their parts do not give, to within 0.5 or a fiftieth.

    ``metrics`` (by, concept_key, value), one row each; ``ratios`` (ratio, part, base). A base of 0 gives no ratio.
    """
    side = lambda name, value: metrics.select(*by, c("concept_key").alias(name), c("value").alias(value))
    rows = side("ratio", "stated").join(small_side(ratios), "ratio").join(side("part", "over"), ["part", *by]).join(side("base", "under"), ["base", *by])
    computed = F.try_divide(100 * c("over"), c("under"))
    return rows.withColumn("computed", computed).where(F.abs(c("stated") - c("computed")) > F.greatest(F.lit(0.5), F.abs("computed") / 50)).select(*by, "ratio", "stated", "computed")


def part_is_whole(cells: DataFrame, parents: DataFrame) -> DataFrame:
    """(doc_id, table_id, row_id, col_id, value_num, parts): a part that states all of its total's figure although the total has other parts that are not 0.

    ``cells``: doc_id, table_id, row_id, col_id, value_num; ``parents``: doc_id, table_id, row_id, row_parent.
    """
    key = ["doc_id", "table_id"]
    parts = cells.where("value_num <> 0").join(parents.where("row_parent is not null"), [*key, "row_id"])
    totals = cells.select(*key, c("row_id").alias("row_parent"), "col_id", c("value_num").alias("total"))
    counts = parts.groupBy(*key, "row_parent", "col_id").agg(F.count("*").alias("parts")).where("parts > 1")
    return parts.join(totals, [*key, "row_parent", "col_id"]).where("value_num = total").join(counts, [*key, "row_parent", "col_id"]).select(*key, "row_id", "col_id", "value_num", "parts")


def stock_against_window(cells: DataFrame, by: Sequence[str], times: float = 2.0) -> DataFrame:
    """(by, at_date, in_window): items whose figure at a date and figure for a window that ends there are more than ``times`` apart in size."""
    size = F.abs("value_num")
    at_date = c("period_span") == "as_at"
    sums = cells.where("value_num is not null and not isnan(value_num) and period_span is not null").groupBy(*by).agg(F.max(F.when(at_date, size)).alias("at_date"), F.max(F.when(~at_date, size)).alias("in_window"))
    return sums.where((F.greatest("at_date", "in_window") > times * F.least("at_date", "in_window")) & c("at_date").isNotNull() & c("in_window").isNotNull())


def stated_conflicts(metrics: DataFrame, grain: Sequence[str], within: float = 0.5) -> DataFrame:
    """(grain, stated, lowest, highest, conflict): metrics stated more than once, and whether their values differ."""
    sums = metrics.where("value_num is not null and not isnan(value_num)").groupBy(*grain).agg(F.count("*").alias("stated"), F.min("value_num").alias("lowest"), F.max("value_num").alias("highest"))
    return sums.where("stated > 1").withColumn("conflict", c("highest") - c("lowest") > within)


def manifest_gaps(filings: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, part): declared filings and the parts of which the store has nothing for them."""
    out = None
    for name, part in parts.items():
        gap = filings.select("doc_id").distinct().join(part.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", F.lit(name).alias("part"))
        out = gap if out is None else out.unionByName(gap)
    return out


def undated_tables(cells: DataFrame, filings: DataFrame) -> DataFrame:
    """(doc_id, table_id, latest): tables none of whose figures is of the filing's own period, with the latest period they have."""
    rows = cells.join(small_side(filings.select("doc_id", "doc_period")), "doc_id").where("period is not null and doc_period is not null")
    return rows.groupBy("doc_id", "table_id").agg(F.max(c("period") == c("doc_period")).alias("has"), F.max("period").alias("latest")).where("not has").drop("has")


def contract_violations(tables: DataFrame) -> DataFrame:
    """(unit_id, table_no, problem, n): what breaks the contract of extracted tables; input unit_id, table_no, columns, rows.

    ``row id twice``; ``row too wide`` (more values than columns); ``values without a label``; ``letter for a heading``
    (columns headed by a single letter, as a reader names what it cannot read); ``no columns`` under rows with values.
    """
    filled = lambda r: F.exists(r["values"], lambda v: F.coalesce(F.trim(v["value"]) != "", F.lit(False)))
    rows = F.filter("rows", lambda r: r.isNotNull())
    blank = lambda x: F.coalesce(F.trim(x), F.lit("")) == ""
    ids = F.filter(F.transform(rows, lambda r: F.lower(F.trim(r["row_id"]))), lambda x: F.coalesce(x != "", F.lit(False)))
    width = F.greatest(F.coalesce(F.size("columns"), F.lit(0)), F.lit(0))
    counts: dict[str, Column] = {
        "row id twice": F.size(ids) - F.size(F.array_distinct(ids)),
        "row too wide": F.when(width > 0, F.size(F.filter(rows, lambda r: F.size(r["values"]) > width))),
        "values without a label": F.size(F.filter(rows, lambda r: blank(r["label"]) & F.coalesce(filled(r), F.lit(False)))),
        "letter for a heading": F.size(F.filter("columns", lambda x: F.coalesce(F.trim(x["leaf"]).rlike("^[A-Za-z]$"), F.lit(False)))),
        "no columns": F.when((width == 0) & F.coalesce(F.exists(rows, lambda r: F.coalesce(filled(r), F.lit(False))), F.lit(False)), 1),
    }
    found = F.array(*[F.struct(F.lit(k).alias("problem"), v.cast("int").alias("n")) for k, v in counts.items()])
    return tables.select("unit_id", "table_no", F.explode(found).alias("f")).select("unit_id", "table_no", "f.*").where("n > 0")


def number_parity(cells: DataFrame, words: DataFrame) -> DataFrame:
    """(doc_id, page, n, extracted, printed): numbers that a page's extraction has more or less often than the page prints; both sides doc_id, page, n."""
    key = ["doc_id", "page", "n"]
    both = cells.select(*key, F.lit(1).alias("e"), F.lit(0).alias("p")).unionByName(words.select(*key, F.lit(0).alias("e"), F.lit(1).alias("p")))
    return both.where("n is not null").groupBy(*key).agg(F.sum("e").alias("extracted"), F.sum("p").alias("printed")).where("extracted <> printed")
