"""One mix of several sources with target shares of the tokens: certain whole copies, then Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.runtime import small_side, stage

#: Steps into which the Pareto ranks of a source are counted before the step that holds the threshold is sorted.
STEPS = 4_096
#: Most sources with a target; their figures are kept on the driver.
MOST_SOURCES = 10_000
#: Rounds in which the rates must settle. A rate only rises, when documents that it gives more than their repeats are found.
ROUNDS = 1_000


def plan_sizes(targets: list[tuple[str, float, int]], tokens: dict[str, int], total: float | None = None) -> tuple[float, dict[str, float]]:
    """The mix's size and each source's tokens: the largest mix, up to ``total``, in which no source is repeated too often.

    Shares of sources without tokens cannot be met; the others keep their proportions.
    """
    real = [(s, share, most) for s, share, most in targets if tokens.get(s, 0) > 0 and share > 0 and most > 0]
    whole = sum(share for _, share, _ in real)
    if not whole:
        return 0.0, {}
    size = min(most * tokens[s] * whole / share for s, share, most in real)
    size = size if total is None else min(size, total)
    return size, {s: size * share / whole for s, share, _ in real}


def mix(sized: DataFrame, target: DataFrame, seed: int = 11, total: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(copies, shares): how often each document is used, and the shares of the mix's tokens reached by each source.

    ``sized`` is (doc_id, source, tokens), with ``weight`` if documents of a source are to differ in their odds;
    ``target`` is (source, target_share, max_repeats). A source's expected copies of a document are its tokens in the
    mix over its tokens there are, times the document's weight (mean 1, by tokens), at most max_repeats. The whole part are
    certain copies; the rest is the odds of one more, drawn in Pareto order: documents are ranked by the odds of a
    uniform number over their own odds and taken from the smallest until the source's size is reached, to within half
    a document. The same seed gives the same mix. Documents without tokens, of no source or of sources without a
    target are not used; a target without documents reaches 0; rows of one target source are added up, its smallest
    max_repeats holds; null shares are 0. Sources are never gathered: ranks are counted in steps, and only the step in
    which a source's size is reached is put in order.
    """
    c, spark = F.col, sized.sparkSession
    wanted = target.where("source is not null").groupBy("source").agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.min("max_repeats").alias("most"))
    goals = [(r["source"], r["share"], r["most"] or 0) for r in wanted.limit(MOST_SOURCES + 1).collect()]
    if len(goals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources have a target")
    weight = F.greatest(F.coalesce(c("weight").cast("double"), F.lit(1.0)), F.lit(0.0)) if "weight" in sized.columns else F.lit(1.0)
    docs = sized.select("doc_id", "source", "tokens", weight.alias("weight")).where("tokens > 0").join(small_side(wanted.select("source")), "source", "left_semi")
    docs = stage(docs)
    sums = {r["source"]: (r["n"], r["w"]) for r in docs.groupBy("source").agg(F.sum("tokens").alias("n"), F.sum(c("tokens") * c("weight")).alias("w")).collect()}
    size, budget = plan_sizes(goals, {s: n for s, (n, w) in sums.items() if w > 0}, total)
    rate = _rates(docs, {s: (budget[s], sums[s][1], m) for s, _, m in goals if s in budget})
    plan = spark.createDataFrame([(s, float(rate[s]), int(m), float(budget[s])) for s, _, m in goals if s in budget], "source string, rate double, most int, budget double")
    docs = docs.join(small_side(plan), "source")
    expected = F.least(c("rate") * c("weight"), c("most").cast("double"))
    docs = docs.withColumn("expected", F.when(F.abs(expected - F.round(expected)) < 1e-9, F.round(expected)).otherwise(expected))
    docs = docs.withColumn("whole", F.floor("expected").cast("int")).withColumn("chance", c("expected") - F.floor("expected"))
    # 53 bits of a hash, never 0 or 1
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "source"), 11).cast("double") + 0.5) / F.lit(float(2**53))
    odds = (u / (1 - u)) / (c("chance") / (1 - c("chance")))
    docs = docs.withColumn("rank", F.when(c("chance") > 0, odds / (1 + odds)))  # Pareto rank, brought into 0..1 without changing the order
    docs = docs.withColumn("step", F.least(F.floor(c("rank") * STEPS), F.lit(STEPS - 1)).cast("int"))
    sums_by = docs.groupBy("source").agg((F.max("budget") - F.sum(c("whole") * c("tokens"))).alias("open"))
    steps = docs.where("step is not null").groupBy("source", "step").agg(F.sum("tokens").alias("in_step"))
    steps = steps.join(sums_by, "source").withColumn("upto", F.sum("in_step").over(W.partitionBy("source").orderBy("step")))
    steps = steps.select("source", "step", (c("upto") - c("in_step")).alias("before_step"), (c("upto") <= c("open")).alias("all_in"), (c("upto") - c("in_step") < c("open")).alias("some_in"), "open")
    placed = docs.join(small_side(steps), ["source", "step"], "left")
    sure = placed.where("step is null or all_in or not some_in").withColumn("extra", F.coalesce(c("all_in").cast("int"), F.lit(0)))
    edge = placed.where("step is not null and not all_in and some_in")
    upto = F.sum("tokens").over(W.partitionBy("source").orderBy("rank", "doc_id").rowsBetween(W.unboundedPreceding, 0))
    edge = edge.withColumn("extra", (c("before_step") + upto - c("tokens") / 2 <= c("open")).cast("int"))
    used = sure.unionByName(edge).select("doc_id", "source", "tokens", (c("whole") + c("extra")).alias("copies")).where("copies > 0")
    used = stage(used)
    reached = used.groupBy("source").agg(F.count("*").alias("documents"), F.sum(c("tokens") * c("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    everything = used.agg(F.sum(c("tokens") * c("copies"))).first()[0] or 0
    shares = wanted.join(reached, "source", "left").select(
        "source", c("share").alias("target_share"), c("most").alias("max_repeats"), F.coalesce("documents", F.lit(0)).alias("documents"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
        (F.coalesce("tokens", F.lit(0)) / F.lit(float(max(1, everything)))).alias("reached_share"),
    )
    return used, shares


def _rates(docs: DataFrame, goals: dict[str, tuple[float, float, int]]) -> dict[str, float]:
    """For each source the factor on the weights with which the expected tokens meet the goal, although no document exceeds its repeats."""
    rate = {s: b / w for s, (b, w, _) in goals.items()}
    for _ in range(ROUNDS):
        if not rate:
            break
        now = F.create_map(*[F.lit(x) for s, (_, _, m) in goals.items() for x in (s, m / rate[s])])[F.col("source")]
        capped = F.col("weight") > now * (1 + 1e-12)
        got = docs.where(F.col("source").isin(list(rate))).groupBy("source").agg(F.sum(F.when(capped, F.col("tokens")).otherwise(0)).alias("full"), F.sum(F.when(~capped, F.col("tokens") * F.col("weight")).otherwise(0.0)).alias("rest")).collect()
        new = {r["source"]: max(rate[r["source"]], (goals[r["source"]][0] - goals[r["source"]][2] * r["full"]) / r["rest"]) if r["rest"] else rate[r["source"]] for r in got}
        if all(abs(new[s] - rate[s]) <= 1e-9 * rate[s] for s in new):
            break
        rate = new
    else:
        raise RuntimeError(f"rates still move after {ROUNDS} rounds")
    return rate
