"""Differences between two copies of a dataset, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBERS = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)


def _cells(df: DataFrame, keys: list[str], fields: list[str], sign: int) -> DataFrame:
    """Key, field, value as text or number, sign. Each key also has the field '' that says it is there."""
    nothing, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def cell(name: str) -> Column:
        if isinstance(df.schema[name].dataType, NUMBERS):
            number = F.col(name).cast("double")
            return F.struct(F.lit(name).alias("__field"), nothing.alias("__text"), F.when(~F.isnan(number), number).alias("__number"))
        text = F.col(name).cast("string")
        return F.struct(F.lit(name).alias("__field"), F.when(text != "", text).alias("__text"), no_number.alias("__number"))

    there = F.struct(F.lit("").alias("__field"), nothing.alias("__text"), no_number.alias("__number"))
    rows = df.select(*keys, F.explode(F.array(there, *[cell(f) for f in fields])).alias("__cell"))
    return rows.select(*keys, "__cell.*", F.lit(sign).alias("__sign"))


def diff_copies(first: DataFrame, second: DataFrame, keys: list[str], fields: list[str], tolerance: float = 1e-9) -> DataFrame:
    """Rows (keys, finding): keys and fields in which two copies do not cancel.

    Both sides are unpivoted to key-field-value rows, united with signed counts and grouped; what does not sum
    to zero is a finding: ``only_in_first``, ``only_in_second``, or the name of a differing field. Null, NaN and
    empty text are one "no value"; numbers within ``tolerance`` of the larger are equal; repeated rows of a side
    count once; a key that states several values for a field on one side differs unless all of them cancel.
    Null keys match null keys; two empty copies give no rows; columns other than keys and fields are ignored.
    """
    both = _cells(first, keys, fields, 1).unionByName(_cells(second, keys, fields, -1))
    # one vote a side however often a row repeats; partial aggregation runs before the only large shuffle
    c = F.col
    plus, minus = F.max(F.when(c("__sign") > 0, 1).otherwise(0)), F.max(F.when(c("__sign") < 0, 1).otherwise(0))
    left = both.groupBy(*keys, "__field", "__text", "__number").agg((plus - minus).alias("__signed")).where("__signed <> 0")
    one, two = c("__signed") > 0, c("__signed") < 0
    fielded = left.groupBy(*keys, "__field").agg(
        F.sum("__signed").alias("__balance"), F.count("*").alias("__rows"), F.max(F.when(one, c("__number"))).alias("__a"), F.max(F.when(two, c("__number"))).alias("__b"),
        F.max(c("__text").isNotNull()).alias("__texts"),
    )
    near = ~c("__texts") & (c("__rows") == 2) & (c("__balance") == 0) & (F.abs(c("__a") - c("__b")) <= tolerance * F.greatest(F.abs("__a"), F.abs("__b")))
    fielded = fielded.where(~F.coalesce(near, F.lit(False)))
    found = fielded.groupBy(*keys).agg(
        F.max(F.when(c("__field") == "", c("__balance"))).alias("__presence"),
        F.collect_set(F.when(c("__field") != "", c("__field"))).alias("__differing"),
    )
    findings = F.when(c("__presence") > 0, F.array(F.lit("only_in_first"))).when(c("__presence") < 0, F.array(F.lit("only_in_second"))).otherwise(c("__differing"))
    return found.select(*keys, F.explode(findings).alias("finding"))
