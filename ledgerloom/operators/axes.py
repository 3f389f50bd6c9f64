"""Axis members that labels name: a map made from lists, and the axis that counts where a label names members of several."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.text import label_key
from ledgerloom.runtime import small_side

#: The axes a label can name a member of, and the member that means the whole book. Fixed values.
AXES = {"segment_key": "SEG_TOTAL", "industry_key": "IND_TOTAL", "geo_key": "GLOBAL"}
c = F.col


def member_map(*lists: DataFrame) -> DataFrame:
    """(key, one column an axis): the member that each label key names, by lists of (label, some of the axis columns).

    A label that the lists give several members of one axis names none of it.
    """
    wide = [x.select(label_key(c("label")).alias("key"), *[(c(a) if a in x.columns else F.lit(None)).cast("string").alias(a) for a in AXES]) for x in lists]
    named = reduce(DataFrame.unionByName, wide).where("key <> ''").groupBy("key")
    out = named.agg(*[F.when(F.min(a) == F.max(a), F.min(a)).alias(a) for a in AXES])
    return out.where(reduce(lambda x, y: x | y, [c(a).isNotNull() for a in AXES]))


def exclusive(labels: DataFrame, pool: Sequence[str], axes: Mapping[str, str] = AXES) -> DataFrame:
    """Labels with their matches on each axis decided, and ``ambiguous`` where no axis wins.

    A label that names members of several axes counts for the only one of them that at least two other labels of its
    pool (the rows, or the columns, of a table) name alone; if there is no such axis it counts for none. The whole
    book is no member: a "Total" is the total of every axis.
    """
    member = {a: F.coalesce(c(a) != total, F.lit(False)) for a, total in axes.items()}
    matched = reduce(add, [c(a).isNotNull().cast("int") for a in axes])
    counted = labels.withColumns({f"_{a}": F.count(F.when(member[a] & (matched == 1), 1)).over(W.partitionBy(*pool)) for a in axes})
    strong = {a: member[a] & (c(f"_{a}") >= 2) for a in axes}
    several = reduce(add, [m.cast("int") for m in member.values()]) > 1
    one = reduce(add, [s.cast("int") for s in strong.values()]) == 1
    decided = counted.select(*[x for x in labels.columns if x not in axes], *[F.when(~several | (one & strong[a]), c(a)).alias(a) for a in axes], (several & ~one).alias("ambiguous"))
    return decided


def resolve(labels: DataFrame, pool: Sequence[str], members: DataFrame | None) -> DataFrame:
    """Frame with a ``label`` and the members it names on each axis; without a map, none."""
    if members is None:
        return labels.withColumns({**{a: F.lit(None).cast("string") for a in AXES}, "ambiguous": F.lit(False)})
    matches = labels.withColumn("key", label_key(c("label"))).join(small_side(members), "key", "left").drop("key")
    return exclusive(matches, pool)


def column_members(cols: DataFrame, key: Sequence[str], members: DataFrame | None) -> DataFrame:
    """Columns with the members of their leaf, else of their banner; leaves and banners (each once) are one pool."""
    leaves = cols.select(*key, "col_id", c("leaf").alias("label"))
    banners = cols.where("banner_id is not null").select(*key, c("banner_id").alias("col_id"), c("banner").alias("label")).distinct()
    both = resolve(leaves.unionByName(banners), key, members)
    above = both.select(*key, c("col_id").alias("banner_id"), *[c(a).alias(f"_{a}") for a in AXES], c("ambiguous").alias("_ambiguous"))
    out = cols.join(both.drop("label"), [*key, "col_id"], "left").join(above, [*key, "banner_id"], "left")
    stamps = [F.coalesce(a, f"_{a}").alias(a) for a in AXES]
    return out.select(*cols.columns, *stamps, "ambiguous", F.coalesce("_ambiguous", F.lit(False)).alias("banner_ambiguous"))
