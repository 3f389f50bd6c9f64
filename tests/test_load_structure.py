import pytest

from ledgerloom.operators.load import build_star
from tests.test_load import FILINGS, UNITS, r, table

HEADS = [(None, "1H26"), (None, "1H25"), (None, "+/(-) %"), (None, "+/(-) %")]
STACKED = table("Overview", HEADS, [
    r("Income, S$m"), r("Fees", "2", "1", level=1), r("of which: cards", "1", "1", level=2, parent="h2"),
    r("Staff (persons)"), r("Branch", "3", "2", "1", "9", level=1), r("Abroad", "1", "1", level=2, parent="h4"), r("Desks", "6", "5", level=1)])
REST = table("Staff (persons) (cont'd)", [(None, "+/(-) %"), (None, "1H26")], [r("Homes", "7", "1", level=2, parent="h9"), r("Head office", "8", "4", level=1), r("Tower", "2", "3", level=2, parent="h1"), r("Total", "0", "13", level=1, kind="total"), r("Too wide", "1", "2", "3", level=1)])
OTHER = table("Staff (persons) (continued)", [(None, "Elsewhere")], [r("Odd", "1")], section="2")


@pytest.fixture(scope="module")
def star(spark):
    units = spark.createDataFrame([("u1", "d1", [STACKED]), ("u2", "d1", [REST, OTHER])], UNITS)
    return build_star(units, spark.createDataFrame(FILINGS, "doc_id string, institution string, doc_period date"))


def test_split_then_merged(star):
    titles = {x["table_no"]: x["title"] for x in star["table_t"].collect()}
    assert titles == {1: "Income, S$m", 2: "Staff (persons)", 4: "Staff (persons) (continued)"}
    rows = {(x["table_no"], x["row_id"]): x for x in star["row_dim"].collect()}
    assert [rows[1, i]["label"] for i in (1, 2)] == ["Fees", "of which: cards"] and rows[1, 2]["row_parent"] == 1
    assert [rows[2, i]["label"] for i in range(1, 9)] == ["Branch", "Abroad", "Desks", "Homes", "Head office", "Tower", "Total", "Too wide"]
    # "Desks" heads the next part's first row, so that part's first heading is the third of the whole
    assert rows[2, 2]["row_parent"] == 1 and rows[2, 4]["row_parent"] == 3 and rows[2, 6]["row_parent"] == 5
    assert len(rows) == 11


def test_merged_values_and_totals(star):
    facts = {(x["table_no"], x["row_id"], x["col_id"]): x for x in star["cell_fact"].collect()}
    assert facts[2, 5, 1]["value_num"] == 4 and facts[2, 5, 3]["value_num"] == 8 and facts[2, 5, 2]["value_num"] is None
    assert facts[1, 1, 1]["unit"] == "million" and facts[2, 1, 1]["unit"] == facts[2, 5, 1]["unit"] != "million"
    assert {x["row_id"]: x["sums_to"] for x in star["sums"].where("table_no = 2").collect()} == {1: 7, 3: 7, 5: 7}
    assert [x["table_no"] for x in star["load_warning"].where("warning like 'row 8 is wider%'").collect()] == [2]
