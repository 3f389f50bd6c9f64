"""Every query with an oracle gives the oracle's rows on the smallest tables; the others run."""

import os

import pytest

import __spark_entry__ as entry_module
import verify

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return verify.connect(SF)


NAMES = [n for module in entry_module.CORE for n in module.QUERIES]


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name in entry_module.oracle_sql():
        cursor = duck.execute(entry_module.oracle_sql()[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert verify.rows(df.columns, got) == verify.rows(columns, cursor.fetchall())


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["rel", "doc_id", "table_id", "row_id", "col_id", "finding"]


def test_row_order_does_not_matter(spark, tmp_path):
    from pyspark.sql import functions as F

    d = str(tmp_path)
    for name in ("v_cell", "filing", "row_dim"):
        spark.read.parquet(f"{SF}/{name}.parquet").orderBy(F.rand(3)).write.parquet(f"{d}/{name}.parquet")
    for name in ("latest_vintage_dedupe", "conflict_resolution", "nearest_shallower_parent", "cluster_gap"):
        f = entry_module.queries()[name]
        assert sorted(map(str, f(spark, d).collect())) == sorted(map(str, f(spark, SF).collect()))
