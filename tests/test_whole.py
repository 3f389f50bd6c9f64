import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.values import expand_pages
from ledgerloom.operators import serving as S
from ledgerloom.plans import metric_queries
from ledgerloom.plans.engine_queries import QUERIES


def lineage(spark, path, links):
    rows = [("d", "t", i, p, f"r{i}") for i, p in links]
    spark.createDataFrame(rows, "doc_id string, table_id string, row_id int, row_parent int, row_leaf_label string").write.parquet(f"{path}/row_dim.parquet")
    return {x["row_id"]: (x["lineage"], x["depth"]) for x in QUERIES["lineage_path"](spark, str(path)).collect()}


def test_lineage_of_deep_rows(spark, tmp_path):
    got = lineage(spark, tmp_path, [(i, i - 1 or None) for i in range(1, 41)])
    assert got[40] == (" > ".join(f"r{i}" for i in range(1, 41)), 40) and got[14][1] == 14 and got[1] == ("r1", 1)


def test_lineage_in_a_circle(spark, tmp_path):
    with pytest.raises(ValueError):
        lineage(spark, tmp_path, [(1, 2), (2, 1), (3, None)])


def test_pivot_keeps_every_column(spark, tmp_path):
    rows = [("d", "t", 1, i, float(i)) for i in (1, 2, 5, 100)]
    spark.createDataFrame(rows, "doc_id string, table_id string, row_id int, col_id int, value_num double").write.parquet(f"{tmp_path}/v_cell.parquet")
    got = QUERIES["pivot_first"](spark, str(tmp_path)).collect()[0].asDict()
    assert got == {"doc_id": "d", "table_id": "t", "row_id": 1, "c1": 1.0, "c2": 2.0, "c3": None, "c4": None, "c5": 5.0, "c100": 100.0}


def test_long_lists_are_not_cut(spark, tmp_path, monkeypatch):
    spark.createDataFrame([("d", "A")], "doc_id string, institution string").write.parquet(f"{tmp_path}/filing.parquet")
    spark.createDataFrame([("x", f"c{i}") for i in range(3)], "table_type string, concept_key string").write.parquet(f"{tmp_path}/concept_map.parquet")
    monkeypatch.setattr(metric_queries, "BROADCAST_ROWS", 2)
    with pytest.raises(ValueError):
        metric_queries.QUERIES["coverage_matrix"](spark, str(tmp_path))
    facts = spark.createDataFrame([(f"c{i}", "A") for i in range(3)], "concept_key string, institution string")
    spec = S.validate_spec(S.QuerySpec(("C2", "c9")), facts)
    assert spec.concepts == ("c2",) and spec.institutions == () and spec.problems == ("no concept 'c9'; close: c0, c1, c2",)


def test_wide_page_ranges(spark):
    df = spark.createDataFrame([("1-5000, 7",), ("999999",)], "r string").select(expand_pages(F.col("r")).alias("p"))
    assert [(len(x["p"]), x["p"][-1]) for x in df.collect()] == [(5000, 5000), (1, 999999)]


def test_each_printed_token_serves_once(spark):
    """Two cells of one label and number, printed once on its line and once elsewhere, and a third that is not printed any more."""
    cells = spark.createDataFrame([("d", 1, i, "Costs", 5.0) for i in (1, 2, 3)], "doc_id string, page int, cell_id int, label string, value_num double")
    lines = spark.createDataFrame([("d", 1, 1, "Costs 5"), ("d", 1, 2, "elsewhere 5")], "doc_id string, page int, line int, text string")
    words = spark.createDataFrame([("d", 1, 1, "5"), ("d", 1, 2, "5")], "doc_id string, page int, line int, text string")
    assert {x["cell_id"]: x["tier"] for x in S.page_parity(cells, lines, words).collect()} == {1: "line", 2: "page", 3: "missing"}
