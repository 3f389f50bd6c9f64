from pyspark.sql import functions as F

from ledgerloom.llm.survivors import discover_truth, survivors

R = "k string, k2 string, v double, unit string, trust int, day int, doc string, n int"


def test_precedence(spark):
    rows = [("a", None, 1.0, None, 1, 5, "d2", 1), ("a", None, 2.0, "m", 0, 1, "d3", 1), ("a", None, float("nan"), "", 0, 9, "d1", 1), ("b", "x", 1.0, "m", 0, 1, "d", 1), ("c", "x", None, "m", None, None, "d", 2), ("c", "x", None, "m", 3, None, "d", 1), ("e", "x", 1.0, "m", 0, 7, "d", 2), ("e", "x", 1.0, "m", 0, 7, "d", 1)]
    df = spark.createDataFrame(rows, R)
    got = sorted((r["k"], r["field_name"], r["doc"], r["n"]) for r in survivors(df, ["k", "k2"], ["v", "unit"], [F.col("trust"), -F.col("day")], ["doc", "n"]).collect())
    assert got == [("a", "unit", "d3", 1), ("a", "v", "d3", 1), ("c", "unit", "d", 1), ("e", "unit", "d", 1), ("e", "v", "d", 1)]
    assert survivors(df.limit(0), ["k", "k2"], ["v"], [F.col("trust")], ["doc"]).count() == 0


def test_truth_discovery(spark):
    claims = []
    for i in range(60):
        claims += [(f"m{i}", None, "v", f"t{i}", "good"), (f"m{i}", None, "v", f"t{i}" if i % 10 else "zzz", "fair")]
        claims += [(f"m{i}", None, "v", "wrong" if i % 3 else f"t{i}", s) for s in ("poor",)]
    claims += [("tie", None, "v", "a", "x"), ("tie", None, "v", "b", "y"), ("n", None, "v", None, "good"), ("solo", None, "v", "z", None)]
    df = spark.createDataFrame(claims, "k string, k2 string, field_name string, value string, source string")
    truths, sources = discover_truth(df, ["k", "k2"])
    got = {r["k"]: r["value"] for r in truths.collect()}
    assert all(got[f"m{i}"] == f"t{i}" for i in range(60)) and got["tie"] in "ab" and got["solo"] == "z" and "n" not in got
    score = {r["source"]: r["reliability"] for r in sources.collect()}
    assert score["good"] > score["fair"] > score["poor"]
    truths, sources = discover_truth(df.limit(0), ["k", "k2"])
    assert truths.count() == 0 and sources.count() == 0
