import pytest

from ledgerloom.llm.mixing import mix, plan_sizes

D = "doc_id long, source string, tokens long, copies int"
T = "source string, target_share double, max_repeats int"


def test_sizes():
    size, parts = plan_sizes([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 9)], {"a": 100, "b": 10})
    assert size == pytest.approx(80) and parts == {"a": pytest.approx(50), "b": pytest.approx(30)}
    assert plan_sizes([], {}) == (0.0, {}) and plan_sizes([("a", 0.0, 1)], {"a": 5}) == (0.0, {})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, "big" if i % 3 else "small", 50 + (i * 37) % 400, 0) for i in range(3000)] + [(9001, "other", 10, 0), (9002, None, 10, 0), (9003, "big", 0, 0), (9004, "tiny", 1000, 0)]
    return spark.createDataFrame(rows, D)


def test_shares(spark, docs):
    target = spark.createDataFrame([("big", 0.5, 1), ("small", 0.45, 3), ("tiny", 0.001, 4), ("gone", 0.049, 2)], T)
    used, shares = mix(docs, target)
    got = {r["source"]: r for r in shares.collect()}
    scale = 0.5 + 0.45 + 0.001
    assert got["big"]["reached_share"] == pytest.approx(0.5 / scale, abs=0.002) and got["small"]["reached_share"] == pytest.approx(0.45 / scale, abs=0.002)
    assert got["gone"]["reached_share"] == 0 and "other" not in got
    rows = used.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and all(r["copies"] <= {"big": 1, "small": 3, "tiny": 4}[r["source"]] for r in rows)
    assert all(r["tokens"] > 0 for r in rows)
    again = sorted(map(tuple, mix(docs, target)[0].collect()))
    assert again == sorted(map(tuple, rows)) and again != sorted(map(tuple, mix(docs, target, seed=12)[0].collect()))


def test_whole_copies_come_first(spark, docs):
    target = spark.createDataFrame([("big", 0.2, 1), ("small", 0.8, 5)], T)
    used = mix(docs, target)[0].where("source = 'small'")
    copies = {r["copies"] for r in used.collect()}
    assert max(copies) - min(copies) <= 1 and used.count() == 1000  # every document has the whole copies, some one more


def test_weights_and_totals(spark, docs):
    weighted = docs.selectExpr("doc_id", "source", "tokens", "if(doc_id % 2 = 0, 3.0, 1.0) as weight")
    target = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 1)], T)
    used, shares = mix(weighted, target, total=100_000.0)
    assert sum(r["tokens"] for r in shares.collect()) == pytest.approx(100_000, rel=0.01)
    even = used.where("doc_id % 2 = 0").count() / used.count()
    assert even == pytest.approx(0.75, abs=0.05)


def test_edges(spark, docs):
    target = spark.createDataFrame([("big", 0.5, 1), ("big", 0.1, 2), (None, 0.4, 1), ("null", None, 1)], T)
    used, shares = mix(docs, target)
    assert {r["source"]: (round(r["target_share"], 3), r["max_repeats"]) for r in shares.collect()} == {"big": (0.6, 1), "null": (0.0, 1)}
    used, shares = mix(docs.limit(0), target)
    assert used.count() == 0 and all(r["reached_share"] == 0 for r in shares.collect())
    assert mix(docs, target.limit(0))[0].count() == 0
