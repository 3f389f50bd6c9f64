"""One surviving record for each group of duplicates, field by field: by truth discovery or by a stated precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import cut, small_side, stage


def survivors(records: DataFrame, keys: list[str], fields: list[str], precedence: list[Column], identity: list[str], least: int = 2) -> DataFrame:
    """Rows (keys, field_name, identity): for each group and field the record the field is taken from.

    Among the records that have the field, the first by ``precedence`` and then by ``identity``, both ascending,
    nulls last. One aggregation does it all, combined before the shuffle, so a hot group costs one row a task.
    Groups of fewer than ``least`` records and fields no record has give no row; NaN and empty text are no value;
    null keys are keys like any other; other columns are ignored. Repeated records must be dropped before.
    """
    kinds = dict(records.dtypes)

    def has(name: str) -> Column:
        c = F.col(name)
        return c.isNotNull() & (~F.isnan(name) if kinds[name] in ("double", "float") else F.lit(True)) & (c != "" if kinds[name] == "string" else F.lit(True))

    order = []
    for i, c in enumerate([*precedence, *[F.col(x) for x in identity]]):
        order += [c.isNull().alias(f"n{i}"), c.alias(f"v{i}")]
    picks = [F.min(F.when(has(f), F.struct(*order, *[F.col(x).alias(f"id_{x}") for x in identity]))).alias(f"pick_{i}") for i, f in enumerate(fields)]
    best = records.groupBy(*keys).agg(F.count("*").alias("__n"), *picks).where(F.col("__n") >= least)
    chosen = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f"pick_{i}").alias("pick")) for i, f in enumerate(fields)])
    rows = best.select(*keys, F.explode(chosen).alias("c")).where("c.pick is not null")
    return rows.select(*keys, "c.field_name", *[F.col(f"c.pick.id_{x}").alias(x) for x in identity])


def discover_truth(claims: DataFrame, keys: list[str], prior: dict[str, float] | None = None, rounds: int = 100, within: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """Iterative truth discovery: (truths, reliability of sources), from claims (keys, field_name, value, source).

    Values are voted for with the reliability of their sources, and a source's reliability is its share of votes
    cast for the current truths (smoothed); the two are estimated in turn until no reliability moves more than
    ``within``; if some still does after ``rounds`` rounds, that is an error. Equal votes go to the smaller value. Claims are first counted by key,
    field, value and source, so a hot key or source is combined before it is shuffled. Null values make no
    claim; a null source is the source ''; no claims give empty results.
    """
    c, metric = F.col, [*keys, "field_name"]
    counted = stage(claims.where("value is not null").groupBy(*metric, "value", F.coalesce("source", F.lit("")).alias("source")).agg(F.count("*").alias("votes")))
    # only fields with several values are voted on; the others are right whatever the reliabilities, and count for their sources once
    spread = counted.groupBy(*metric).agg(F.min("value").alias("least"), F.max("value").alias("most"))
    marked = stage(_null_safe(counted, spread, metric))
    contested, agreed = marked.where("least <> most").drop("least", "most"), marked.where("least = most").drop("least", "most")
    sure = stage(agreed.groupBy("source").agg(F.sum("votes").alias("sure")))
    known = F.create_map(*[F.lit(x) for item in (prior or {"": 0.8}).items() for x in item])
    weights = cut(counted.select("source").distinct().withColumn("weight", F.coalesce(known[c("source")], F.lit(0.8))))

    def vote(rows: DataFrame) -> DataFrame:
        # log odds: a source that is right more often than not adds to its value, two weak ones can outvote a strong one
        odds = F.greatest(F.lit(0.01), F.log(c("weight") / (1 - c("weight"))))
        support = rows.join(small_side(weights), "source").groupBy(*metric, "value").agg(F.round(F.sum(odds * c("votes")), 9).alias("support"))
        # the best value and the sum of all, in one aggregation that combines before the shuffle
        best = F.min(F.struct((-c("support")).alias("s"), "value")).alias("b")
        return support.groupBy(*metric).agg(best, F.sum("support").alias("total")).select(*metric, "b.value", (-c("b.s")).alias("support"), "total")

    for _ in range(rounds):
        truths = stage(vote(contested))
        right = _null_safe(contested, truths.select(*metric, c("value").alias("truth")), metric)
        seen = right.groupBy("source").agg(F.sum(F.when(c("value") == c("truth"), c("votes")).otherwise(0)).alias("right"), F.sum("votes").alias("votes"))
        both = weights.join(seen, "source", "left").join(sure, "source", "left").fillna(0, ["right", "votes", "sure"])
        both = both.withColumn("now", (c("right") + c("sure") + 4) / (c("votes") + c("sure") + 5))
        moved = both.agg(F.max(F.abs(c("now") - c("weight")))).first()[0]
        weights = cut(both.select("source", F.least(F.lit(0.999), c("now")).alias("weight")))
        if moved is None or moved <= within:
            break
    else:
        raise RuntimeError(f"reliabilities still move by {moved} after {rounds} rounds")
    truths = truths.unionByName(vote(agreed))
    return truths.select(*metric, "value", "support", F.when(c("total") > 0, c("support") / c("total")).alias("confidence")), weights.withColumnRenamed("weight", "reliability")


def _null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner equi join in which null keys match; each key column comes out once."""
    names = {c: f"__r_{c}" for c in on}
    right = right.withColumnsRenamed(names)
    same = [F.col(c).eqNullSafe(F.col(names[c])) for c in on]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return left.join(right, condition).drop(*names.values())
