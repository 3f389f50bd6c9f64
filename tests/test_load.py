from datetime import date

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.load import breakdown_violations, build_star
from ledgerloom.operators.totals import totals_of
from ledgerloom.sources.sinks import project, reload, seed_registry, sync
from ledgerloom.streaming.ingest import ingest_units, repeated_status, windowed_counts

UNITS = "unit_id string, doc_id string, tables array<struct<title:string,label_header:string,continued_from_previous:boolean,section_id:string,columns:array<struct<`group`:string,leaf:string>>,rows:array<struct<row_id:string,row_type:string,level:int,parent:string,label:string,values:array<struct<value:string,cell_state:string>>>>>>"


def v(*texts):
    return [{"value": t, "cell_state": "reported"} for t in texts]


def r(label, *texts, kind="data", level=0, parent=None, line=None):
    return {"row_id": line, "row_type": kind, "level": level, "parent": parent, "label": label, "values": v(*texts)}


def table(title, columns, rows, header=None, section="1"):
    return {"title": title, "label_header": header, "continued_from_previous": False, "section_id": section, "columns": [{"group": g, "leaf": x} for g, x in columns], "rows": rows}


INCOME = table("Income (S$m)", [("The Group", "1H26"), ("The Group", "1H25"), ("The Bank", "1H26"), (None, "+/(-) %")], [
    r("Interest", "100", "90", "80", "11.1"), r("Fees", "50", "40", "30", "25.0"), r("of which: cards", "20", "10", "5", "100", level=1), r("Income", "150", "130", "110", "15.4", kind="total"),
    r("Costs", "60", "55", "50", "9.1"), r("Profit", "90", "75", "60", "20.0", kind="total"), r("note", kind="note"), r("Too wide", "1", "2", "3", "4", "5"), r("Margin, bps", "12", "-", "#", "")])
BLOCKS = table("Marisund Concord Group", [(None, "Total"), (None, "Retail"), (None, "Others")], [
    r("2nd Half 2025", kind="section_header"), r("Loans", "30", "10", "20"), r("1st Half 2025", kind="section_header"), r("Loans", "28", "9", "19"), r("Bad", "3", "1", "1")], header="Segments in S$'000", section="2")
FILINGS = [("d1", "Marisund Concord", date(2026, 6, 30))]


@pytest.fixture(scope="module")
def star(spark):
    units = spark.createDataFrame([("u1", "d1", [INCOME, None]), ("u2", "d1", [BLOCKS])], UNITS)
    return build_star(units, spark.createDataFrame(FILINGS, "doc_id string, institution string, doc_period date"))


def test_facts(star):
    got = {(x["table_no"], x["row_id"], x["col_id"]): x for x in star["cell_fact"].collect()}
    assert got[1, 1, 1]["value_num"] == 100 and got[1, 1, 1]["period"] == date(2026, 6, 30) and got[1, 1, 1]["period_span"] == "1H" and got[1, 1, 1]["period_start"] == date(2026, 1, 1)
    assert got[1, 1, 1]["unit"] == "million" and got[1, 1, 4]["unit"] == "percent" and got[1, 9, 1]["unit"] == "bp"
    assert got[1, 1, 3]["legal_entity"] == "BANK_SOLO" and got[1, 1, 1]["legal_entity"] == "CONSOLIDATED"
    assert [got[1, 9, i]["cell_state"] for i in (1, 2, 3, 4)] == ["reported", "null", "suppressed", "empty"]
    assert not [k for k in got if k[:2] == (1, 8)] and not [k for k in got if k[:2] == (1, 7)]
    assert got[2, 2, 1]["period"] == date(2025, 12, 31) and got[2, 2, 1]["period_source"] == "row_banner" and got[2, 4, 2]["period_span"] == "1H"
    assert got[2, 2, 1]["unit"] == "thousand" and got[1, 1, 4]["period_source"] == "document"


def test_axes_and_totals(star):
    titles = {x["table_no"]: x["title"] for x in star["table_t"].collect()}
    assert titles[2] == "Segments in S$'000"  # the masthead changed places
    rows = {(x["table_no"], x["row_id"]): x for x in star["row_dim"].collect()}
    assert rows[1, 3]["row_parent"] == 2 and rows[1, 1]["sums_to"] == 4 and rows[1, 2]["sums_to"] == 4 and rows[1, 3]["sums_to"] is None
    assert (rows[1, 4]["sums_to"], rows[1, 4]["sums_sign"]) == (6, 1) and (rows[1, 5]["sums_to"], rows[1, 5]["sums_sign"]) == (6, -1)
    assert breakdown_violations(star).count() == 0
    col = star["column_sums"].collect()[0]
    assert (col["rows"], col["agreeing"], col["reconciled"]) == (3, 3, True)
    assert sorted({x["banner_id"] for x in star["col_dim"].where("table_no = 1").collect() if x["banner_id"]}) == [100, 101]
    assert star["load_warning"].where("warning like '%wider%'").count() == 1


def test_breakdown_that_misses_is_found(spark, star):
    broken = dict(star)
    broken["cell_fact"] = star["cell_fact"].withColumn("value_num", F.when((F.col("table_no") == 1) & (F.col("row_id") == 4), F.col("value_num") * 2).otherwise(F.col("value_num")))
    assert breakdown_violations(broken).count() > 0


def totals(rows):
    pdf = pd.DataFrame([(i + 1, k, lv) for i, (k, lv, _) in enumerate(rows)], columns=["row_id", "row_type", "level"])
    values = np.array([[np.nan if x is None else x for x in vals] for _, _, vals in rows], float)
    return totals_of(pdf, values.reshape(len(rows), -1) if rows else values, np.ones(len(rows[0][2]) if rows else 0, bool))


def test_total_rules():
    assert totals([("data", 0, [5, 1]), ("data", 0, [3, 1]), ("total", 0, [2, 0])]) == [(1, 3, 1, "signed"), (2, 3, -1, "signed")]
    assert totals([("data", 0, [5]), ("data", 0, [5]), ("total", 0, [0])])[0][3] == "2 ways"  # plus-minus or minus-plus
    assert totals([("data", 0, [100]), ("total", 0, [7])]) == [(2, None, None, "0 ways")]
    assert totals([("data", 0, [1])] * 15 + [("total", 0, [-40])])[0][3] == "too large"
    assert totals([("data", 0, [4]), ("section_header", 0, [None]), ("data", 0, [6]), ("note", 0, [None]), ("data", 0, [None]), ("total", 0, [6])]) == [(3, 6, 1, "added"), (5, 6, 1, "added")]
    assert totals([("data", 0, [4]), ("total", 0, [None])]) == [(2, None, None, "only ratios")]
    assert totals([]) == []


def test_empty_units(spark):
    empty = build_star(spark.createDataFrame([], UNITS), spark.createDataFrame([], "doc_id string, institution string, doc_period date"))
    assert {k: f.count() for k, f in empty.items()} == dict.fromkeys(empty, 0)
    nulls = build_star(spark.createDataFrame([("u", None, None), ("w", "d", [{"title": None, "label_header": None, "continued_from_previous": None, "section_id": None, "columns": None, "rows": [None, r(None, None)]}])], UNITS), spark.createDataFrame(FILINGS, "doc_id string, institution string, doc_period date"))
    assert nulls["cell_fact"].count() == 0


def test_reload_is_idempotent(spark, star, tmp_path):
    path = str(tmp_path / "facts")
    facts = star["cell_fact"]
    reload(facts.withColumn("doc_id", F.lit("other")), path)
    for _ in range(2):
        reload(facts, path)
    assert spark.read.parquet(path).groupBy("doc_id").count().count() == 2 and spark.read.parquet(path).count() == 2 * facts.count()
    with pytest.raises(ValueError):
        reload(facts, path, check=lambda df: df.where("row_id = 1"))
    assert project(facts, {"row_id": "long", "missing": "double"}).dtypes == [("row_id", "bigint"), ("missing", "double")]
    done = sync({"a": facts, "b": facts.select(F.raise_error(F.lit("no")).alias("x"))}, str(tmp_path / "serving"))
    assert done["a"] == "written" and done["b"].startswith("failed")


def test_seed_registry(spark):
    old = spark.createDataFrame([("a", "T1", "human_confirmed"), ("b", "T1", "seed")], "alias string, table_type_id string, source string")
    new = spark.createDataFrame([("a", "T2", "seed"), ("b", "T2", "seed"), ("c", "T3", "seed")], "alias string, table_type_id string, source string")
    assert sorted(tuple(x) for x in seed_registry(old, new, ["alias"]).collect()) == [("a", "T1", "human_confirmed"), ("b", "T2", "seed"), ("c", "T3", "seed")]


def test_stream_of_units(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("u1", "d1", [INCOME]), ("u1", "d1", [INCOME])], UNITS).write.parquet(source)
    filings = spark.createDataFrame(FILINGS, "doc_id string, institution string, doc_period date")
    for run in range(2):  # a second run of the same batch changes nothing
        query = ingest_units(spark, source, UNITS, filings, str(tmp_path / "out"), str(tmp_path / f"check{run}"))
        query.awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out/cell_fact")).where("row_id = 1").count() == 4


def test_streamed_events(spark, tmp_path):
    rows = [(i, f"2024-01-01 0{i % 3}:00:00", i % 2, "error" if i < 4 else "view", 1.0) for i in range(6)]
    df = spark.createDataFrame(rows, "event_id long, t string, user_id long, event_type string, value double").withColumn("ts", F.to_timestamp("t")).drop("t")
    df.coalesce(1).write.parquet(str(tmp_path / "ev"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "ev"))
    q = windowed_counts(stream).writeStream.outputMode("update").format("memory").queryName("w").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("select sum(events) from w").first()[0] == 6
    q = repeated_status(stream).writeStream.outputMode("update").format("memory").queryName("s").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(tuple(x) for x in spark.sql("select * from s").collect()) == [(0, "error", 2, True), (1, "view", 1, False)] or spark.sql("select count(*) from s").first()[0] == 2


def test_filing_in_two_batches(spark, tmp_path):
    """What an earlier batch loaded of a filing stays, a unit delivered again replaces itself, and emptied filings lose their rows."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    filings = spark.createDataFrame(FILINGS, "doc_id string, institution string, doc_period date")
    batches = [[("u1", "d1", [INCOME]), ("u9", "d2", [INCOME])], [("u2", "d1", [INCOME])], [("u9", "d2", None), ("u2", "d1", [INCOME])]]
    counts = []
    for rows in batches:
        spark.createDataFrame(rows, UNITS).coalesce(1).write.mode("append").parquet(source)
        ingest_units(spark, source, UNITS, filings, out, str(tmp_path / "check")).awaitTermination(120)
        counts.append({x["doc_id"]: x["count"] for x in spark.read.parquet(f"{out}/cell_fact").groupBy("doc_id").count().collect()})
    one = counts[0]["d1"]
    assert counts == [{"d1": one, "d2": one}, {"d1": 2 * one, "d2": one}, {"d1": 2 * one}]
    at_once = build_star(spark.createDataFrame([("u1", "d1", [INCOME]), ("u2", "d1", [INCOME])], UNITS), filings)["cell_fact"]
    assert at_once.count() == 2 * one


def test_period_gates(spark):
    """Words beside the periods of headings: the same everywhere they are a measure's name, different ones describe the columns; and a table of another date."""
    from ledgerloom.operators.load import column_axis

    def heads(*leaves):
        return {**INCOME, "columns": [{"group": None, "leaf": x} for x in leaves], "rows": [r("Fees", *["1"] * len(leaves))]}

    units = spark.createDataFrame([("u1", "d1", [heads("Note 3 2023", "Note 4 2022"), heads("2023 yield", "2022 yield"), heads("FY1999")])], UNITS)
    star = build_star(units, spark.createDataFrame(FILINGS, "doc_id string, institution string, doc_period date"))
    periods = {(x["table_no"], x["col_id"]): x["period"] and x["period"].year for x in star["col_dim"].collect()}
    assert periods == {(1, 1): None, (1, 2): None, (2, 1): 2023, (2, 2): 2022, (3, 1): 1999}
    said = sorted((x["table_no"], x["warning"].split(":")[0].split(",")[0]) for x in star["load_warning"].collect())
    assert [x for x in said if x[0] == 1] == [(1, "heading is a period beside words of its own")] * 2 and (3, "filing's period is not among the table's") in said
