from ledgerloom.operators.compare import diff_copies

S = "k string, n int, v double, s string, extra int"


def found(spark, a, b):
    a, b = spark.createDataFrame(a, S), spark.createDataFrame(b, S)
    return sorted((r["k"] or "", r["n"] or 0, r["finding"]) for r in diff_copies(a, b, ["k", "n"], ["v", "s"]).collect())


def test_all_kinds(spark):
    a = [("a", 1, 1.0, "x", 1), ("a", 1, 1.0, "x", 2), ("b", 1, 2.0, "", 1), ("c", 1, float("nan"), None, 1), ("d", 1, 1.0, "x", 1), ("e", 1, 1e9, "x", 1), ("f", 1, 5.0, "x", 1), (None, None, 1.0, "x", 1), ("z", 1, 0.0, "q", 0)]
    b = [("a", 1, 1.0, "x", 9), ("b", 1, 2.0, None, 1), ("c", 1, None, "", 1), ("e", 1, 1e9 + 0.5, "x", 1), ("f", 1, 6.0, "y", 1), ("g", 1, None, None, 1), ("g", 1, None, None, 1), (None, None, 1.0, "w", 1), ("z", 1, -0.0, "q", 0)]
    assert found(spark, a, b) == [("", 0, "s"), ("d", 1, "only_in_first"), ("f", 1, "s"), ("f", 1, "v"), ("g", 1, "only_in_second")]


def test_null_against_value_and_zero(spark):
    assert found(spark, [("a", 1, None, "x", 1), ("b", 1, 0.0, "x", 1)], [("a", 1, 0.0, "x", 1), ("b", 1, 1e-12, "x", 1)]) == [("a", 1, "v"), ("b", 1, "v")]


def test_empty(spark):
    assert found(spark, [], []) == []
    assert found(spark, [("a", 1, None, None, 1)], []) == [("a", 1, "only_in_first")]
