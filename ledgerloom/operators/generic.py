"""Relational operators the disclosure layer is configured from: vintages, precedence, fill-down, placement, totals."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ledgerloom.runtime import small_side


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], ties: Sequence[str]) -> DataFrame:
    """One row a key: the one with the greatest ``order`` (nulls least), then the smallest ``ties``.

    A minimum over structs, combined before the shuffle, so a hot key sends one row a task; null keys are keys.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    newest = [_down(F.col(o), df.schema[o].dataType.typeName()) for o in order]
    first = F.struct(*newest, *[F.struct(F.col(t).isNull(), F.col(t)) for t in ties])
    return df.groupBy(*keys).agg(F.min_by(row, first).alias("r")).select("r.*")


def _down(c: Column, kind: str) -> Column:
    """A key that sorts ascending as ``c`` sorts descending, nulls last."""
    if kind in ("date",):
        c = F.unix_date(c)
    elif kind in ("timestamp", "timestamp_ntz"):
        c = F.unix_micros(c.cast("timestamp"))
    elif kind == "string":
        raise TypeError("latest_by orders by numbers, dates and times")
    return F.struct(c.isNull(), -c)


def precedence(choices: Sequence[tuple[str, Column]]) -> tuple[Column, Column]:
    """(value, name of its source): the first choice that is not null."""
    value = F.coalesce(*[c for _, c in choices])
    source = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in choices])
    return value, source


def fill_down(df: DataFrame, scope: Sequence[str], order: Sequence[str], value: Column, out: str) -> DataFrame:
    """The last non-null ``value`` of the rows before each row in its scope; a row that has one itself reads none."""
    before = W.partitionBy(*scope).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(out, F.when(value.isNull(), F.last(value, True).over(before)))


def nearest_shallower(df: DataFrame, scope: Sequence[str], order: str, level: str, out: str, levels: int = 12) -> DataFrame:
    """The ``order`` of the nearest earlier row of a strictly smaller level.

    If all levels are from 0 to ``levels``, the last place of every level is one window value and the greatest of those
    above the row's own level is its parent. If the data has others, a scope (one printed table) is one stack pass.
    """
    low, high = df.agg(F.min(level), F.max(level)).first()
    if low is not None and (low < 0 or high > levels):

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order)
            stack, parents = [], []
            for at, lv in zip(pdf[order], pdf[level]):
                if pd.isna(lv):
                    parents.append(None)
                    continue
                while stack and stack[-1][0] >= lv:
                    stack.pop()
                parents.append(stack[-1][1] if stack else None)
                stack.append((lv, at))
            return pdf.assign(**{out: pd.array(parents, dtype="Int64")})

        return df.groupBy(*scope).applyInPandas(run, StructType([*df.schema.fields, StructField(out, df.schema[order].dataType)]))
    before = W.partitionBy(*scope).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    seen = [F.when(F.col(level) > n, F.last(F.when(F.col(level) == n, F.col(order)), True).over(before)) for n in range(max(levels, 2))]
    return df.withColumn(out, F.greatest(*seen))


def level_parent(df: DataFrame, scope: Sequence[str], order: str, level: str, out: str, eligible: Column | None = None) -> DataFrame:
    """The ``order`` of the nearest earlier ``eligible`` row of the level just above the row's own, whatever lies between.

    Rows answer for their own level and ask for the one above: one window keyed by the level, for levels of any depth.
    """
    may = F.lit(True) if eligible is None else eligible
    answers = df.where(may & F.col(level).isNotNull()).select(*scope, F.col(level).alias("__level"), F.col(order).alias("__at"), F.lit(True).alias("__answers"))
    asks = df.withColumns({"__level": F.col(level) - 1, "__at": F.col(order), "__answers": F.lit(False)})
    before = W.partitionBy(*scope, "__level").orderBy("__at", "__answers").rowsBetween(W.unboundedPreceding, -1)
    both = asks.unionByName(answers, allowMissingColumns=True)
    return both.withColumn(out, F.last(F.when(F.col("__answers"), F.col("__at")), True).over(before)).where(~F.col("__answers")).drop("__level", "__at", "__answers")


def strict_mode(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, mode, votes, of): each key's most frequent non-null value, null if two are equally frequent."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.max("n").alias("votes"), F.sum("n").alias("of"))
    tops = counts.join(best.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("votes").alias("__votes")), _same(keys, "__") & (F.col("n") == F.col("__votes")), "left_semi")
    ties = tops.groupBy(*keys).agg(F.count("*").alias("ties"), F.min(value).alias("mode"))
    out = ties.join(best.select(*[F.col(k).alias(f"__{k}") for k in keys], "votes", "of"), _same(keys, "__"))
    return out.select(*keys, F.when(F.col("ties") == 1, F.col("mode")).alias("mode"), "votes", "of")


def _same(keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return condition


def gap_clusters(df: DataFrame, keys: Sequence[str], value: Column, ties: Sequence[str], gap: float, out: str = "cluster") -> DataFrame:
    """Rows with a cluster number from 1: sorted by ``value`` a new cluster starts where the step is more than ``gap``."""
    order = W.partitionBy(*keys).orderBy("__v", *ties)
    rows = df.withColumn("__v", value).withColumn("__new", (F.col("__v") - F.lag("__v").over(order) > gap).cast("int"))
    return rows.withColumn(out, 1 + F.sum(F.coalesce("__new", F.lit(0))).over(order)).drop("__v", "__new")


def signed_composition(facts: DataFrame, members: DataFrame, on: Sequence[str], by: Sequence[str], value: str = "value_num") -> DataFrame:
    """(item, by, value, members, declared, complete): each item as the signed sum of its members' facts.

    ``members`` is (item, *on, sign). A missing member is not read as 0 in silence: ``complete`` says whether all
    declared members have a value.
    """
    declared = members.groupBy("item").agg(F.count("*").alias("declared"))
    joined = facts.join(small_side(members), list(on)).where(F.col(value).isNotNull())
    sums = joined.groupBy("item", *by).agg(F.sum(F.col("sign") * F.col(value)).alias("value"), F.count_distinct(*on).alias("members"))
    return sums.join(small_side(declared), "item").withColumn("complete", F.col("members") == F.col("declared"))


def place_on_axis(facts: DataFrame, axis: DataFrame) -> DataFrame:
    """Facts placed on the columns (label, end) of a period axis: flows by their own label, stocks on every column that closes on their date.

    Two equi joins united, never a join on "or". ``facts`` has label, end and by_date.
    """
    flows = facts.where(~F.col("by_date")).join(axis.select(F.col("label").alias("column")), F.col("label") == F.col("column"))
    stocks = facts.where("by_date").join(axis.select(F.col("label").alias("column"), F.col("end").alias("closes")), F.col("end") == F.col("closes")).drop("closes")
    return flows.unionByName(stocks)


def overlap_match(left: DataFrame, right: DataFrame, least: int = 2, share: float = 0.5) -> DataFrame:
    """(left_id, right_id, shared, declared): pairs that share at least ``least`` keys and ``share`` of the right side's.

    Both sides are (id, key). An inverted index by key finds the pairs, so only those with a key in common meet.
    """
    a = left.select(F.col("id").alias("left_id"), "key").where("key is not null").distinct()
    b = right.select(F.col("id").alias("right_id"), "key").where("key is not null").distinct()
    size = b.groupBy("right_id").agg(F.count("*").alias("declared"))
    pairs = a.join(b, "key").groupBy("left_id", "right_id").agg(F.count("*").alias("shared"))
    return pairs.join(size, "right_id").where((F.col("shared") >= least) & (F.col("shared") >= share * F.col("declared"))).select("left_id", "right_id", "shared", "declared")


def multiset_signature(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, n, signature): order-free signature of each key's values, equal just for equal multisets but for chance.

    Sums and mixes of hashes of (value, how often), so no group is collected anywhere.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    h = F.xxhash64(value, F.col("n"))
    g = F.xxhash64(F.lit("second"), F.col("n"), value)
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.concat_ws("-", F.sum(h.cast("decimal(38,0)")).cast("string"), F.sum(g.cast("decimal(38,0)")).cast("string"), F.count("*").cast("string")).alias("signature"))


def not_contained(wanted: DataFrame, there: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, missing): wanted values that are not there as often as wanted; each one there serves once."""
    a = wanted.groupBy(*keys, value).agg(F.count("*").alias("wanted"))
    b = there.groupBy(*keys, value).agg(F.count("*").alias("there"))
    out = a.join(b, [*keys, value], "left").withColumn("missing", F.col("wanted") - F.least(F.col("wanted"), F.coalesce("there", F.lit(0))))
    return out.where("missing > 0").select(*keys, value, "missing")


def fill_only(reported: DataFrame, derived: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All reported rows, and the derived ones whose key is not reported; null keys match null keys."""
    there = reported.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    return reported.unionByName(derived.join(there, _same(keys, "__"), "left_anti"))


def scoped_lookup(rows: DataFrame, entries: DataFrame, scope: str, key: str, answer: str, wildcard: str = "*") -> DataFrame:
    """Rows with the ``answer`` of the entry of their scope and key, else of the wildcard's entry of that key."""
    own = entries.where(F.col(scope) != wildcard).groupBy(scope, key).agg(F.min(answer).alias("__own"))
    any_ = entries.where(F.col(scope) == wildcard).groupBy(key).agg(F.min(answer).alias("__any"))
    out = rows.join(own, [scope, key], "left").join(any_, key, "left")
    return out.withColumn(answer, F.coalesce("__own", "__any")).drop("__own", "__any")
