from pyspark.sql import functions as F

from ledgerloom.operators import generic as G
from ledgerloom.operators.load import row_parents


def test_parents_at_any_level(spark):
    rows = [("t", i + 1, i) for i in range(20)] + [("t", 21, 15), ("t", 22, None), ("t", 23, 16), ("u", 1, 3), ("u", 2, 1), ("u", 3, 2)]
    df = spark.createDataFrame(rows, "k string, n int, level int")
    want = {("t", i + 1): i or None for i in range(20)} | {("t", 21): 15, ("t", 22): None, ("t", 23): 21, ("u", 1): None, ("u", 2): None, ("u", 3): 2}
    for f in (G.nearest_shallower, G.level_parent):
        assert {(x["k"], x["n"]): x["p"] for x in f(df, ["k"], "n", "level", "p").collect()} == want
    loaded = df.where("level is not null").select(F.lit("d").alias("doc_id"), F.when(F.col("k") == "t", 1).otherwise(2).alias("table_no"), F.col("n").alias("row_id"), F.lit("data").alias("row_type"), "level")
    links = spark.createDataFrame([], "doc_id string, table_no int, row_id int, up int")
    sums = spark.createDataFrame([], "doc_id string, table_no int, row_id int, sums_to int")
    got = {(x["table_no"], x["row_id"]): x["row_parent"] for x in row_parents(loaded, links, sums).collect()}
    assert got == {(1 if k == "t" else 2, n): p for (k, n), p in want.items() if (k, n) != ("t", 22)}
