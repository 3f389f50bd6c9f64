import pytest

from ledgerloom.llm.survivors import discover_truth


def test_no_convergence_is_an_error(spark):
    claims = spark.createDataFrame([(i, "f", "a" if i % 3 else "b", s) for i in range(9) for s in ("x", "y")] + [(i, "f", "c", "z") for i in range(9)], "k int, field_name string, value string, source string")
    with pytest.raises(RuntimeError):
        discover_truth(claims, ["k"], rounds=1)
    truths, _ = discover_truth(claims, ["k"])
    assert truths.count() == 9
