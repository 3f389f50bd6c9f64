from datetime import date

import pytest

from ledgerloom.operators.axes import exclusive, member_map
from ledgerloom.operators.load import build_star
from ledgerloom.streaming.ingest import ingest_units
from tests.test_load import FILINGS, UNITS, r, table


@pytest.fixture(scope="module")
def members(spark):
    stamps = [("Retail", "S1", None, None), ("Retail (1)", "S1", None, None), ("Corporate", "S2", None, None), ("Others", "S9", None, None), ("others", None, "I9", None), ("Farms", None, "I1", None), ("Trade", None, "I2", None),
              ("Fees", None, None, None), ("Mixed", "S1", None, None), ("mixed", "S2", None, None), ("Total", "SEG_TOTAL", "IND_TOTAL", None)]
    rows = spark.createDataFrame(stamps, "label string, segment_key string, industry_key string, geo_key string")
    return member_map(rows, spark.createDataFrame([("North", "N")], "label string, geo_key string"))


def test_member_map(members):
    got = {x["key"]: (x["segment_key"], x["industry_key"], x["geo_key"]) for x in members.collect()}
    assert got == {"retail": ("S1", None, None), "corporate": ("S2", None, None), "others": ("S9", "I9", None), "farms": (None, "I1", None), "trade": (None, "I2", None), "total": ("SEG_TOTAL", "IND_TOTAL", None), "north": (None, None, "N")}


def test_three_axes_exclude(spark):
    rows = [("x", "A", "S1", None, None), ("x", "B", "S2", None, None), ("x", "C", "S3", None, "G1"), ("y", "A", "S1", None, None), ("y", "B", "S2", None, None), ("y", "D", None, None, "G1"), ("y", "E", None, None, "G2"), ("y", "C", "S3", None, "G1"), ("y", "T", "S1", "IND_TOTAL", None)]
    got = {(x["t"], x["label"]): (x["segment_key"], x["industry_key"], x["geo_key"], x["ambiguous"]) for x in exclusive(spark.createDataFrame(rows, "t string, label string, segment_key string, industry_key string, geo_key string"), ["t"]).collect()}
    assert got["x", "C"] == ("S3", None, None, False) and got["y", "C"] == (None, None, None, True) and got["y", "T"] == ("S1", "IND_TOTAL", None, False)


SEGMENTS = table("Segments", [(None, "Total"), (None, "Retail"), (None, "Corporate"), (None, "Others")], [r("Loans", "9", "4", "3", "2"), r("FARMS (1)", "8", "4", "3", "1")])
INDUSTRIES = table("Industries", [("North", "1H26"), (None, "1H25")], [r("Farms", "1", "1"), r("Trade", "2", "2"), r("Others", "3", "3"), r("Total", "6", "6", kind="total")], section="2")
UNCLEAR = table("Unclear", [(None, "1H26")], [r("Others", "3"), r("Farms", "1")], section="3")


def test_loader_stamps_members(spark, members):
    units = spark.createDataFrame([("u1", "d1", [SEGMENTS, INDUSTRIES, UNCLEAR])], UNITS)
    filings = spark.createDataFrame(FILINGS, "doc_id string, institution string, doc_period date")
    star = build_star(units, filings, members=members)
    got = {(x["table_no"], x["row_id"], x["col_id"]): (x["segment_key"], x["industry_key"], x["geo_key"]) for x in star["cell_fact"].collect()}
    assert [got[1, 1, i] for i in (1, 2, 3, 4)] == [(s, "IND_TOTAL", "GLOBAL") for s in ("SEG_TOTAL", "S1", "S2", "S9")]
    assert got[1, 2, 2] == ("S1", "I1", "GLOBAL")
    assert [got[2, i, 2] for i in (1, 2, 3, 4)] == [("SEG_TOTAL", i, "GLOBAL") for i in ("I1", "I2", "I9", "IND_TOTAL")]
    assert got[2, 1, 1] == ("SEG_TOTAL", "I1", "N")  # the banner's place
    assert got[3, 1, 1] == ("SEG_TOTAL", "IND_TOTAL", "GLOBAL") and got[3, 2, 1][1] == "I1"
    assert {x["label"]: x["industry_key"] for x in star["row_dim"].where("table_no = 2").collect()} == {"Farms": "I1", "Trade": "I2", "Others": "I9", "Total": "IND_TOTAL"}
    warned = [x["table_no"] for x in star["load_warning"].where("warning like '%several axes: Others'").collect()]
    assert warned == [3]


def test_stream_stamps_members(spark, members, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("u1", "d1", [INDUSTRIES])], UNITS).write.parquet(source)
    filings = spark.createDataFrame([("d1", "Marisund Concord", date(2026, 6, 30))], "doc_id string, institution string, doc_period date")
    ingest_units(spark, source, UNITS, filings, str(tmp_path / "out"), str(tmp_path / "check"), members).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out/cell_fact")).where("industry_key = 'I2'").count() == 2


def test_stored_labels_are_stamped(spark, tmp_path):
    from ledgerloom.plans.engine_queries import QUERIES

    rows = [("t", 1, "Retail", "S1", None), ("t", 2, "Corporate", "S2", None), ("t", 3, "Others", None, None), ("u", 1, "Others (1)", "S9", None), ("u", 2, "Others", None, "I9"), ("u", 3, "North", None, None)]
    stored = spark.createDataFrame([("d", *x, None) for x in [*rows, rows[0]]], "doc_id string, table_id string, row_id int, row_leaf_label string, segment_key string, industry_key string, geo_key string")
    stored.write.parquet(str(tmp_path / "row_dim.parquet"))
    spark.createDataFrame([("North", "N")], "label string, geo_key string").write.parquet(str(tmp_path / "geo_dim.parquet"))
    got = {(x["table_id"], x["row_id"]): (x["segment_key"], x["industry_key"], x["geo_key"], x["ambiguous"]) for x in QUERIES["axis_stamps"](spark, str(tmp_path)).collect()}
    assert got == {("t", 1): ("S1", None, None, False), ("t", 2): ("S2", None, None, False), ("t", 3): ("S9", None, None, False), ("u", 1): (None, None, None, True), ("u", 2): (None, None, None, True), ("u", 3): (None, None, "N", False)}
