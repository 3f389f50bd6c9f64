from datetime import date

from pyspark.sql import functions as F

from ledgerloom.operators import generic as G
from ledgerloom.operators import identity as I
from ledgerloom.operators import serving as S
from ledgerloom.operators import structure as X
from ledgerloom.sources.readers import html_tables, read_list, read_toc, read_units, richest_root, units_from_audit

ROW = "row_id:string,row_type:string,level:int,parent:string,label:string,values:array<struct<value:string,cell_state:string>>"


def v(*texts):
    return [{"value": t, "cell_state": "reported"} for t in texts]


def test_split_blocks(spark):
    rows = [("t", 1, "section_header", 0, "2nd Half 2025", []), ("t", 2, "data", 0, "Loans", v("1")), ("t", 3, "section_header", 0, "1st Half 2025", v("")), ("t", 4, "data", 0, "Loans", v("2")),
            ("u", 1, "data", 0, "Income, S$m", v("")), ("u", 2, "data", 1, "Fees", v("2")), ("u", 3, "data", 0, "Staff (persons)", []), ("u", 4, "data", 1, "Branch", v("3"))]
    df = spark.createDataFrame(rows, "k string, row_id int, row_type string, level int, label string, values array<struct<value:string,cell_state:string>>")
    by_date = {(x["k"], x["row_id"]): x["block"] for x in X.split_blocks(df, ["k"]).collect()}
    assert [by_date["t", i] for i in (1, 2, 3, 4)] == [1, 1, 2, 2] and {by_date["u", i] for i in (1, 2, 3, 4)} == {0}
    by_caption = {(x["k"], x["row_id"]): x["caption"] for x in X.split_blocks(df, ["k"], "caption").collect()}
    assert by_caption["u", 2] == "Income, S$m" and by_caption["u", 4] == "Staff (persons)" and by_caption["t", 2] is None
    states = df.where("k = 't'").select("row_id", X.normalise_states().alias("s")).orderBy("row_id").collect()
    assert states[2]["s"][0]["cell_state"] == "empty"


def test_continuations(spark):
    schema = f"doc_id string, table_no int, title string, columns array<struct<`group`:string,leaf:string>>, rows array<struct<{ROW}>>"
    col = lambda *x: [{"group": None, "leaf": y} for y in x]
    row = lambda label, level, parent, *vals: {"row_id": None, "row_type": "data", "level": level, "parent": parent, "label": label, "values": v(*vals)}
    data = [
        ("d", 1, "Assets", col("a", "b", "c"), [row("Loans", 0, None, "1", "2", "3"), row("Cards", 1, "h1", "4", "5", "6")]),
        ("d", 2, "Assets (cont'd)", col("c", "a"), [row("Paper", 0, None, "7", "8"), row("Bills", 1, "h1", "9", "10")]),
        ("d", 3, "Assets (continued)", col("z"), [row("Odd", 0, None, "1")]),
        ("d", 4, "Income (continued)", col("a"), [row("Odd", 0, None, "1")]),
    ]
    out = {x["table_no"]: x for x in X.merge_continuations(spark.createDataFrame(data, schema)).collect()}
    assert sorted(out) == [1, 3, 4] and out[1]["parts"] == 2
    rows = out[1]["rows"]
    assert [x["label"] for x in rows] == ["Loans", "Cards", "Paper", "Bills"] and [x["parent"] for x in rows] == [None, "h1", None, "h2"]
    assert [y["value"] if y else None for y in rows[2]["values"]] == ["8", None, "7"]
    assert X.merge_continuations(spark.createDataFrame([], schema)).count() == 0


def test_geometry_and_layout(spark):
    rows = [("t", 1, "Fees and", 0, 7, 10.0, "Fees and income"), ("t", 2, "income", 3, 7, 10.0, None), ("t", 3, "Cards", 0, 8, 20.0, "Cards"), ("u", 1, "A", 2, None, 1.0, None), ("u", 2, "B", 2, 9, 9.0, "b")]
    df = spark.createDataFrame(rows, "k string, row_id int, label string, level int, line_id int, indent double, label_clean string")
    got = sorted((x["k"], x["label"], x["level"], x["merged"]) for x in X.apply_geometry(df, ["k"]).collect())
    assert got == [("t", "Cards", 1, 1), ("t", "Fees and income", 0, 2), ("u", "A", 2, 1), ("u", "B", 2, 1)]
    boxes = spark.createDataFrame([("d", 1, 1, 0.0, 0.0, 10.0, 10.0), ("d", 1, 2, 1.0, 1.0, 5.0, 5.0), ("d", 1, 3, 8.0, 8.0, 20.0, 20.0), ("d", 1, 4, 0.0, 0.0, 10.0, 10.0)], "doc_id string, page int, box_id int, x0 double, y0 double, x1 double, y1 double")
    assert sorted(x["box_id"] for x in X.nested_regions(boxes).collect()) == [2, 4]
    windows = X.section_windows(spark.createDataFrame([("d", "s1", 1, 5.0), ("d", "s2", 1, 50.0), ("d", "s3", 3, 0.0)], "doc_id string, section_id string, page int, y double"))
    regions = spark.createDataFrame([("d", 1, 1, 1.0), ("d", 2, 1, 50.0), ("d", 3, 2, 1.0), ("d", 4, 3, 9.0)], "doc_id string, region_id int, page int, y0 double")
    assert sorted((x["region_id"], x["section_id"]) for x in X.regions_in_windows(regions, windows).collect()) == [("1", None), ("2", "s2"), ("3", "s2"), ("4", "s3")]
    lines = spark.createDataFrame([("d", p, t) for p in range(1, 5) for t in ("Report 2024", f"Body {'abcd'[p - 1]}")], "doc_id string, page int, text string")
    assert [x["key"] for x in X.running_headers(lines).collect()] == ["report 0"]
    words = spark.createDataFrame([("d", 1, "b", 5.0, 10.5), ("d", 1, "a", 1.0, 10.0), ("d", 1, "c", 1.0, 20.0)], "doc_id string, page int, text string, x0 double, top double")
    assert sorted((x["line"], x["text"]) for x in X.cluster_lines(words).collect()) == [(1, "a b"), (2, "c")]


def test_duplicate_tables(spark):
    rows = [(t, f"row {i}") for t, n in (("a", 10), ("b", 10), ("c", 9), ("d", 3)) for i in range(n)]
    got = sorted((x["a"], x["b"]) for x in X.duplicate_tables(spark.createDataFrame(rows, "id string, content string")).collect())
    assert got == [("a", "b"), ("a", "c")]


MASTER = "bank string, table_type_id string, line_ordinal int, canonical_leaf_id string, label string, full_path string, source_family string"


def test_identity(spark):
    master = spark.createDataFrame([("B", "INC", i, f"inc.{i}", x, x, "fs") for i, x in enumerate(["Income::Fees", "Income::Interest", "Costs", "Profit"])] + [("B", "INC", 9, "inc.dup", "Costs", "costs", "fs"), ("B", "BAL", 0, "bal.0", "Loans", "Loans", None), ("B", "BAL", 1, "bal.1", "Costs", "Costs", None), ("B", "SMALL", 0, "s.0", "Fees", "Profit", "other"), ("B", "SMALL", 1, "s.1", "Costs", "Costs", "other")], MASTER)
    tables = spark.createDataFrame([("d", "t1", "B", "fs"), ("d", "t2", "B", None), ("d", "t3", "X", None)], "doc_id string, table_id string, bank string, family string")
    paths = spark.createDataFrame([("d", "t1", 1, "P&L::income::fees"), ("d", "t1", 2, "Costs"), ("d", "t1", 3, "Gain"), ("d", "t2", 1, "loans"), ("d", "t2", 2, "COSTS"), ("d", "t3", 1, "Costs")], "doc_id string, table_id string, row_id int, path string")
    aliases = spark.createDataFrame([("B", "INC", "Gain", "Profit")], "bank string, table_type_id string, alias string, path string")
    hits = I.locate(tables, paths, master, aliases)
    assert sorted((x["table_id"], x["table_type_id"], x["matched"]) for x in hits.collect()) == [("t1", "INC", 3), ("t2", "BAL", 2)]
    kept = I.one_type(hits)
    stamped = I.stamp_rows(paths, kept, master, aliases)
    assert sorted((x["table_id"], x["row_id"], x["canonical_leaf_id"], x["how"]) for x in stamped.collect()) == [("t1", 1, "inc.0", "variant"), ("t1", 2, "inc.2", "path"), ("t1", 3, "inc.3", "alias"), ("t2", 1, "bal.0", "path"), ("t2", 2, "bal.1", "path")]
    assert I.unknown_stamps(stamped, master).count() == 0
    assert I.unknown_stamps(stamped.withColumn("canonical_leaf_id", F.lit("made.up")), master).count() == 5


def test_contests_columns_registry(spark):
    hits = spark.createDataFrame([("d", "t", "B", "A", 3, 4, 0.75), ("d", "t", "B", "C", 4, 4, 1.0), ("d", "u", "B", "C", 2, 4, 0.5), ("e", "x", "B", "P", 2, 2, 1.0), ("e", "x", "B", "Q", 2, 2, 1.0), ("e", "x", "B", "R", 2, 3, 0.7)], "doc_id string, table_id string, bank string, table_type_id string, matched int, declared int, share double")
    assert sorted((x["table_id"], x["table_type_id"]) for x in I.one_type(hits).collect()) == [("t", "A"), ("t", "C"), ("u", "C"), ("x", "P"), ("x", "Q"), ("x", "R")]
    cols = spark.createDataFrame([("d", "t", "A", "B", i, p) for i, p in enumerate(["Retail", "Total"])] + [("d", "u", "A", "B", i, p) for i, p in enumerate(["Retail", "x", "y"])], "doc_id string, table_id string, table_type_id string, bank string, col_id int, path string")
    members = spark.createDataFrame([("B", "A", f"c{i}", p) for i, p in enumerate(["retail", "corporate", "total", "others"])], "bank string, table_type_id string, canonical_col_id string, full_path string")
    assert sorted((x["table_id"], x["col_id"], x["canonical_col_id"], x["vetoed"]) for x in I.resolve_columns(cols, members).collect()) == [("t", 0, "c0", False), ("t", 1, "c2", False), ("u", 0, None, True), ("u", 1, None, True), ("u", 2, None, True)]
    tables = spark.createDataFrame([("d", "1", "B", "Note 1", "Loans"), ("d", "2", "B", "Note 1", "Other"), ("d", "3", "C", "x", "Loans (1)"), ("d", "4", "C", None, None)], "doc_id string, table_id string, bank string, section string, title string")
    registry = spark.createDataFrame([("*", "note 1::loans", "COMPOSITE"), ("*", "note 1", "ANY"), ("B", "note 1", "OWN"), ("*", "loans", "TITLE")], "bank string, alias string, table_type_id string")
    assert sorted((x["table_id"], x["table_type_id"]) for x in I.exhibit_type(tables, registry).collect()) == [("1", "COMPOSITE"), ("2", "OWN"), ("3", "TITLE")]


FACT = "institution string, bank string, table_type_id string, canonical_leaf_id string, canonical_col_id string, period date, period_span string, geo_key string, segment_key string, industry_key string, legal_entity string, col_role string, value_num double, unit string, doc_period date, doc_id string, table_id string, row_id int, col_id int"


def fact(leaf, value, period=date(2026, 6, 30), span="1H", bank="B", kind="FS_INCOME", doc="d1", doc_period=date(2026, 6, 30), role=None, entity=None):
    return (bank, bank, kind, leaf, None, period, span, None, None, None, entity, role, value, "million", doc_period, doc, "t", 1, 1)


def test_serving(spark):
    facts = spark.createDataFrame([
        fact("a", 10.0), fact("a", 9.0, doc="d0", doc_period=date(2025, 6, 30)), fact("b", 4.0), fact("x", 1.0, role="derived"), fact("x", 1.0, entity="BANK_SOLO"), fact("a", 7.0, date(2025, 12, 31), "FY"),
        fact("l", 100.0, span="as_at", kind="FS_BALANCE_X"), fact("l", 100.0, span="2Q", kind="FS_BALANCE_X"), fact("a", 5.0, bank="C"), fact("l", 50.0, date(2024, 1, 1), "as_at", kind="FS_BALANCE_X"),
    ], FACT)
    served = S.latest_facts(S.servable(facts))
    assert served.where("bank = 'B' and canonical_leaf_id = 'a' and period_span = '1H'").collect()[0]["value_num"] == 10.0
    axis = S.fiscal_axis(served)
    assert [x["label"] for x in axis.orderBy("place").collect()] == ["FY25", "1H26", "2Q26"]
    anchors = spark.createDataFrame([("Net", "B", "FS_INCOME", "a", 1, 1, None), ("Net", "B", "FS_INCOME", "b", -1, 2, "typo"), ("Net", "C", "FS_INCOME", "a", 1, 1, None), ("Net", "C", "FS_INCOME", "b", -1, 2, None), ("Loans", "B", "FS_BALANCE_X", "l", 1, 1, None)], "concept string, bank string, table_type_id string, canonical_leaf_id string, sign int, member_ordinal int, filter_by string")
    got = {(x["bank"], x["concept"], x["label"]): (x["value"], x["complete"]) for x in S.compose_items(served, anchors, axis).collect()}
    assert got == {("B", "Net", "1H26"): (6.0, True), ("B", "Net", "FY25"): (7.0, False), ("C", "Net", "1H26"): (5.0, False), ("B", "Loans", "1H26"): (100.0, True), ("B", "Loans", "2Q26"): (100.0, True)}
    items = S.compose_items(served, anchors, axis)
    sections = spark.createDataFrame([("Net", 1, "Income"), ("Loans", 2, "Balance")], "concept string, row_order int, section string")
    table = S.grid(items.where("bank = 'B'"), ["FY25", "1H26"], sections).collect()
    assert [x["concept"] for x in table] == ["Income", "Net", "Balance", "Loans"] and table[1]["1H26"] == "6" and table[1]["FY25"] == "7"
    wide = {(x["concept"], x["label"]): (x["B"], x["C"]) for x in S.compare_grid(items, ["B", "C"]).collect()}
    assert wide["Net", "1H26"] == (6.0, 5.0)
    assert S.anchor_coverage(anchors, served).where("hits = 0").count() == 1


def test_checks_and_specs(spark):
    cells = spark.createDataFrame([("d", 1, 1, "Fees and income", 5.0), ("d", 1, 2, "Costs", 5.0), ("d", 1, 3, "Lost", 9.0), ("d", 1, 4, "Costs", None)], "doc_id string, page int, cell_id int, label string, value_num double")
    lines = spark.createDataFrame([("d", 1, 1, "Fees and income 5"), ("d", 1, 2, "elsewhere (5)")], "doc_id string, page int, line int, text string")
    words = spark.createDataFrame([("d", 1, 1, "5"), ("d", 1, 2, "(5)")], "doc_id string, page int, line int, text string")
    assert {x["cell_id"]: x["tier"] for x in S.page_parity(cells, lines, words).collect()} == {1: "line", 2: "page", 3: "missing"}
    truth = spark.createDataFrame([("B", "a", date(2026, 6, 30), "1H", 10.4), ("B", "b", date(2026, 6, 30), "1H", 3.0), ("B", "c", date(2026, 6, 30), "1H", 1.0), ("B", "d", date(2026, 6, 30), "1H", None)], "bank string, concept_key string, period date, period_span string, value double")
    served = spark.createDataFrame([("B", "a", date(2026, 6, 30), "as_at", 10.0, "S$m"), ("B", "b", date(2026, 6, 30), "1H", 9.0, "S$m")], "bank string, concept_key string, period date, period_span string, value double, unit string")
    assert {x["concept_key"]: x["status"] for x in S.against_truth(truth, served).collect()} == {"a": "match", "b": "mismatch", "c": "missing", "d": "not transcribed"}
    facts = spark.createDataFrame([("Marisund", "pnl.fees", date(2026, 6, 30), "1H", None, None, None, None, 1.0), ("Velholm", "pnl.fees", date(2024, 6, 30), "1H", "SEG_RETAIL", None, None, None, 2.0)], "institution string, concept_key string, period date, period_span string, segment_key string, geo_key string, industry_key string, legal_entity string, value_num double")
    spec = S.validate_spec(S.QuerySpec(("PNL.FEES", "pnl.fee"), start="2027-01-01", end="2020-01-01"), facts)
    assert spec.concepts == ("pnl.fees",) and spec.start == "2020-01-01" and "close: pnl.fees" in spec.problems[0]
    assert S.run_spec(spec, facts).count() == 1


def test_generic_edges(spark):
    df = spark.createDataFrame([(None, None, 1), (None, 3, 2), ("a", None, 5), ("a", None, 4)], "k string, o int, t int")
    assert sorted(map(tuple, G.latest_by(df, ["k"], ["o"], ["t"]).collect()), key=str) == [("a", None, 4), (None, 3, 2)]
    modes = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", None), (None, "z")], "k string, v string")
    assert sorted(map(tuple, G.strict_mode(modes, ["k"], "v").collect()), key=str) == [("a", "x", 2, 3), ("b", None, 1, 2), (None, "z", 1, 1)]
    left = spark.createDataFrame([(1, None, 1.0)], "k int, s string, v double")
    right = spark.createDataFrame([(1, None, 2.0), (2, None, 3.0)], "k int, s string, v double")
    assert sorted(map(tuple, G.fill_only(left, right, ["k", "s"]).collect())) == [(1, None, 1.0), (2, None, 3.0)]
    rows = spark.createDataFrame([("a", x) for x in (1, 1, 2)] + [("b", x) for x in (2, 1, 1)] + [("c", x) for x in (1, 2, 2)], "k string, v int")
    signs = {x["k"]: x["signature"] for x in G.multiset_signature(rows, ["k"], "v").collect()}
    assert signs["a"] == signs["b"] != signs["c"]


def test_sources(spark, tmp_path):
    unit = tmp_path / "d" / "u1"
    unit.mkdir(parents=True)
    (unit / "parsed.json").write_text('{"tables": [{"title": "T", "rows": [{"values": ["1", {"value": "2"}]}]}]}')
    (unit / "meta.json").write_text('{"document": "d", "section_ids": ["3", "4"], "pages": [1, 2]}')
    bad = tmp_path / "d" / "u2"
    bad.mkdir()
    (bad / "parsed.json").write_text('{"tables": [')
    assert sorted(x["unit_id"] for x in read_units(spark, str(tmp_path)).collect()) == ["u1", "u2"]
    assert [(x["unit_id"], x["section_id"], x["tables"]) for x in units_from_audit(spark, str(tmp_path)).collect()] == [("u1", "3", 1)]
    toc = tmp_path / "toc"
    toc.mkdir()
    (toc / "d.json").write_text('{"sections": [{"id": "1.1", "title": "B", "page": 2, "level": 2, "parent_id": "1"}, {"id": "1", "title": "A", "page": 1, "level": 1}]}')
    assert [(x["doc_id"], x["section_id"], x["parent_section"], x["seq"]) for x in read_toc(spark, str(toc)).orderBy("seq").collect()] == [("d", "1.1", "1", 1), ("d", "1", None, 2)]
    (tmp_path / "list.csv").write_text('﻿\n\n bank,label\nB,"a, b"\n\nC,\n')
    assert [(x["line"], x["bank"], x["label"], x["missing"]) for x in read_list(spark, str(tmp_path / "list.csv"), ["bank", "label", "missing"]).collect()] == [(1, "B", "a, b", None), (2, "C", None, None)]
    html = '<table><tr><th colspan=2>H<th rowspan="2">R</tr><tr><td data-sign="-">1<td>2</table><p>x</p><table><tr><td>z</td></tr></table>'
    pages = spark.createDataFrame([(1, html), (2, None), (3, "<p>no</p>")], "page_id int, html string")
    got = sorted((x["table_no"], x["row_no"], x["col_no"], x["text"]) for x in html_tables(pages).collect())
    assert got == [(0, 0, 0, "H"), (0, 0, 1, "H"), (0, 0, 2, "R"), (0, 1, 0, "1"), (0, 1, 1, "2"), (0, 1, 2, "R"), (1, 0, 0, "z")]
    roots = spark.createDataFrame([("d", "b", 1, 5), ("d", "a", 1, 5), ("d", "c", 0, 9)], "doc_id string, path string, n_geometry int, n_units int")
    assert richest_root(roots).collect()[0]["path"] == "a"


def test_slices_do_not_add_up(spark):
    """The whole book stated with null axes and with total ones is one slice; a breakdown is not part of it."""
    base = fact("a", 100.0)
    named = base[:7] + ("GLOBAL", "SEG_TOTAL", "IND_TOTAL") + base[10:]
    retail = base[:7] + (None, "RETAIL", " ") + base[10:12] + (60.0,) + base[13:]
    both = base[:7] + ("SG", "RETAIL", None) + base[10:12] + (30.0,) + base[13:]
    column = base[:4] + ("c1",) + base[5:12] + (7.0,) + base[13:]
    facts = spark.createDataFrame([base, named[:15] + ("d0",) + named[16:], retail, both, column], FACT)
    served = S.latest_facts(S.servable(facts))
    axis = S.fiscal_axis(served)
    schema = "concept string, bank string, table_type_id string, canonical_leaf_id string, sign int, member_ordinal int, filter_by string, canonical_col_id string, row_dim_key string"
    anchors = spark.createDataFrame([("All", "B", "FS_INCOME", "a", 1, 1, None, None, None), ("Retail", "B", "FS_INCOME", "a", 1, 1, None, "", "RETAIL"), ("Column", "B", "FS_INCOME", "a", 1, 1, None, "c1", " "), ("Rest", "B", "FS_INCOME", "a", 1, 1, None, None, None), ("Rest", "B", "FS_INCOME", "a", -1, 2, None, None, "RETAIL")], schema)
    got = {x["concept"]: (x["value"], x["complete"]) for x in S.compose_items(served, anchors, axis).collect()}
    assert got == {"All": (100.0, True), "Retail": (60.0, True), "Column": (7.0, True), "Rest": (40.0, True)}


def test_near_duplicates_against_brute_force(spark):
    import random

    rng = random.Random(5)
    tables = {f"t{i}": {f"r{rng.randrange(6)}" for _ in range(3)} | {f"x{i // 3}.{j}" for j in range(rng.randrange(2, 22))} for i in range(24)}
    rows = spark.createDataFrame([(k, x) for k, v in tables.items() for x in v], "id string, content string")
    got = {(r["a"], r["b"]): (r["shared"], r["larger"]) for r in X.duplicate_tables(rows).collect()}
    want = {(a, b): (len(tables[a] & tables[b]), max(len(tables[a]), len(tables[b]))) for a in tables for b in tables if a < b}
    assert got == {k: v for k, v in want.items() if v[0] >= 0.9 * v[1]} and got


def test_windows_and_boxes(spark):
    sections = spark.createDataFrame([("d", "a", 1, 0.0), ("d", "b", 1, 50.0), ("d", "c", 3, 20.0)], "doc_id string, section_id string, page int, y double")
    regions = spark.createDataFrame([("d", 1, "r1", 10.0, 40.0), ("d", 1, "r2", 40.0, 60.0), ("d", 2, "r3", 0.0, 90.0), ("d", 3, "r4", 10.0, 30.0), ("d", 4, "r5", 0.0, 5.0), ("d", 1, "r6", 50.0, 60.0)], "doc_id string, page int, region_id string, y0 double, y1 double")
    got = sorted((r["region_id"], r["section_id"]) for r in X.windows_of_regions(regions, X.section_windows(sections), 4).collect())
    assert got == [("r1", "a"), ("r2", "a"), ("r2", "b"), ("r3", "b"), ("r4", "b"), ("r4", "c"), ("r5", "c"), ("r6", "b")]
    boxes = spark.createDataFrame([("d", 1, i, *xs) for i, xs in enumerate([(0.0, 0.0, 9.0, 9.0), (1.0, 1.0, 2.0, 2.0), (0.0, 3.0, 4.0, 4.0)])] + [("d", 2, 9, 1.0, 1.0, 2.0, 2.0)], "doc_id string, page int, box_id int, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r["box_id"] for r in X.outer_boxes(boxes).collect()) == [0, 2, 9]
