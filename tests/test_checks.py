from datetime import date

from pyspark.sql import functions as F

from ledgerloom.operators import checks as K
from ledgerloom.operators import curate as U


def test_identities_and_ratios(spark):
    rows = [("a", "t", 10.0), ("a", "x", 6.0), ("a", "y", 4.0), ("b", "t", 2.0), ("b", "x", 6.0), ("b", "y", 4.0), ("c", "t", 99.0), ("c", "x", 6.0), ("c", "y", 4.0), ("d", "t", 1.0), ("d", "x", 6.0), ("e", "t", None), ("e", "x", 1.0), ("e", "y", 1.0)]
    metrics = spark.createDataFrame(rows, "house string, concept_key string, value double")
    identities = spark.createDataFrame([("t", "x", 1), ("t", "y", -1)], "total string, concept_key string, sign int")
    got = K.identity_violations(metrics, identities, ["house"]).collect()
    assert [(r["house"], r["plain"], r["signed"]) for r in got] == [("c", 10.0, 2.0)]  # a: plain sum, b: signed sum, d: a member is missing
    ratios = spark.createDataFrame([("t", "x", "y")], "ratio string, part string, base string")
    assert sorted(r["house"] for r in K.ratio_violations(metrics, ratios, ["house"]).collect()) == ["a", "b", "c"]
    assert K.identity_violations(metrics.limit(0), identities, ["house"]).count() == 0


def test_cell_checks(spark):
    key = "doc_id string, table_id string, row_id int, col_id int, value_num double"
    cells = spark.createDataFrame([("d", "t", 1, 1, 9.0), ("d", "t", 2, 1, 9.0), ("d", "t", 3, 1, 1.0), ("d", "t", 4, 1, 5.0), ("d", "t", 5, 1, 5.0), ("d", "t", 6, 1, None)], key)
    parents = spark.createDataFrame([("d", "t", 2, 1), ("d", "t", 3, 1), ("d", "t", 5, 4), ("d", "t", 6, None)], "doc_id string, table_id string, row_id int, row_parent int")
    assert [(r["row_id"], r["parts"]) for r in K.part_is_whole(cells, parents).collect()] == [(2, 2)]  # 5 is the only part of 4
    spans = spark.createDataFrame([("a", "as_at", 1.0), ("a", "1H", -5.0), ("b", "as_at", 1.0), ("b", "1H", 2.0), ("c", "1H", 9.0), ("d", None, 9.0)], "k string, period_span string, value_num double")
    assert [r["k"] for r in K.stock_against_window(spans, ["k"]).collect()] == ["a"]
    facts = spark.createDataFrame([("a", 1.0), ("a", 1.2), ("b", 1.0), ("b", 9.0), ("c", 1.0), (None, 1.0), (None, 1.0), ("d", float("nan")), ("d", 1.0)], "k string, value_num double")
    assert sorted(((r["k"], r["conflict"]) for r in K.stated_conflicts(facts, ["k"]).collect()), key=str) == [("a", False), ("b", True), (None, False)]
    pages = lambda rows: spark.createDataFrame([("d", 1, x) for x in rows], "doc_id string, page int, n double")
    assert sorted((r["n"], r["extracted"], r["printed"]) for r in K.number_parity(pages([1.0, 1.0, 2.0]), pages([1.0, 2.0, 3.0])).collect()) == [(1.0, 2, 1), (3.0, 0, 1)]


TABLE = "unit_id string, table_no int, columns array<struct<group:string,leaf:string>>, rows array<struct<row_id:string,row_type:string,level:int,parent:string,label:string,values:array<struct<value:string,cell_state:string>>>>"


def test_contract(spark):
    v = lambda *xs: [{"value": x, "cell_state": None} for x in xs]
    row = lambda label, values, row_id=None: {"row_id": row_id, "row_type": None, "level": None, "parent": None, "label": label, "values": values}
    head = [{"group": None, "leaf": "A"}, {"group": None, "leaf": "2020"}, None]
    df = spark.createDataFrame([("u", 0, head, [row("x", v("1", "2", "3", "4"), "r1"), row(" ", v("1"), "R1"), None, row(None, None)]), ("u", 1, None, [row("x", v("1"))]), ("u", 2, None, None), ("u", 3, [], [])], TABLE)
    got = {(r["table_no"], r["problem"]): r["n"] for r in K.contract_violations(df).collect()}
    assert got == {(0, "row id twice"): 1, (0, "row too wide"): 1, (0, "values without a label"): 1, (0, "letter for a heading"): 1, (1, "no columns"): 1}


def test_classes_and_ancestry(spark):
    rows = [(1, "section_header", 0, "Assets", False), (2, None, 0, "30 June 2025", False), (3, None, 0, "Loans", False), (4, None, 1, "Retail", True), (5, "note", 0, "(1) restated", False), (6, None, 1, "2024", True), (7, None, 0, "Cash", True), (8, None, 0, "The end", False), (9, None, 0, None, True)]
    df = spark.createDataFrame([("t", *r) for r in rows], "t string, row_id int, row_type string, level int, label string, valued boolean")
    classes = U.row_classes(df, ["t"])
    got = {r["row_id"]: r["row_class"] for r in classes.collect()}
    assert got == {1: "SECTION_HEADER", 2: "PERIOD_BANNER", 3: "BANNER", 4: "DATA", 5: "EXCLUDED", 6: "PERIOD_ROW", 7: "DATA", 8: "BANNER", 9: "EXCLUDED"}
    up = classes.withColumn("row_parent", F.when(F.col("row_id") == 4, 3))
    assert {r["row_id"]: r["ancestors"] for r in U.ancestry(up, ["t"]).collect()} == {4: ["Loans"], 7: ["Loans"]}
    loop = classes.withColumn("row_parent", F.when(F.col("row_id") == 4, 7).when(F.col("row_id") == 7, 4))
    assert {r["row_id"]: r["ancestors"] for r in U.ancestry(loop, ["t"]).collect()} == {4: ["Cash"], 7: ["Retail"]}
    filled = U.filled_parents(df.select("t", "row_id", "row_type", "level"), ["t"])
    assert {r["row_id"]: r["parent"] for r in filled.collect() if r["parent"]} == {4: "h1", 6: "h2"}


def test_curation(spark):
    rows = spark.createDataFrame([("d", "t", 1, "k", 1), ("d", "t", 2, "k", None), ("d", "t", 3, "k", 4), ("d", "t", 4, "k", None)], "doc_id string, table_id string, row_id int, table_type_id string, ordinal int")
    entries = spark.createDataFrame([("k", i, f"k.{i}") for i in range(1, 6)], "table_type_id string, ordinal int, canonical_leaf_id string")
    assert sorted((r["row_id"], r["canonical_leaf_id"]) for r in U.suggest_between(rows, entries).collect()) == [(2, "k.2"), (2, "k.3")]
    roles = spark.createDataFrame([("d", "t", 1, None), ("d", "t", 2, 1), ("d", "t", 3, 2), ("d", "t", 4, None)], "doc_id string, table_id string, row_id int, row_parent int")
    assert {r["row_id"]: (r["role"], r["sum_group"]) for r in U.sum_roles(roles).collect()} == {1: ("total", "G1"), 2: ("total", "G2"), 3: ("component", "G2"), 4: ("atomic", None)}
    cols = spark.createDataFrame([("a", 1, date(2024, 6, 30), "2Q"), ("a", 2, date(2024, 12, 31), "as_at"), ("a", 3, date(2024, 12, 31), "FY"), ("b", 1, None, None)], "t string, col_id int, period date, period_span string")
    assert {r["t"]: (r["col_id"], r["why"]) for r in U.year_column(cols, ["t"]).collect()} == {"a": (3, "full year"), "b": (None, "none")}
    labels = spark.createDataFrame([("net fee income",), ("income of fees, net",), ("zzz",), (None,), ("",)], "label string")
    needles = spark.createDataFrame([("fee income",), ("net interest income",), (None,)], "needle string")
    assert {r["label"]: r["needle"] for r in U.fuzzy_lookup(labels, needles).collect()} == {"net fee income": "fee income"}
    scores = spark.createDataFrame([("d", "a", "x", 0.9), ("d", "a", "y", 0.8), ("d", "b", "x", 0.8), ("d", "b", "y", 0.1), ("e", "a", "x", 0.5)], "doc string, left string, right string, score double")
    assert sorted((r["doc"], r["left"], r["right"]) for r in U.greedy_pairs(scores, ["doc"]).collect()) == [("d", "a", "x"), ("d", "b", "y"), ("e", "a", "x")]
    texts = spark.createDataFrame([(1, "Net income"), (2, " "), (3, None), (4, "12.5%"), (5, "(1) Restated for the change of accounting policy in the year.")], "i int, t string")
    assert [r[0] for r in texts.orderBy("i").select(U.noise_reason(F.col("t"))).collect()] == [None, "blank", "blank", "number", "footnote"]
    bench = spark.createDataFrame([("a", date(2020, 1, 1), 1), ("a", date(2024, 1, 1), 2), ("b", date(2024, 1, 1), 3), ("b", None, 4)], "k string, period date, n int")
    assert sorted((r["k"], r["n"]) for r in U.benchmark_rows(bench, ["k"], "2020-01-01", ["n"]).collect()) == [("a", 1), ("b", 3)]
    sections = spark.createDataFrame([("d", "1", None, 1), ("d", "1.1", "1", 2), ("d", "2", None, 5), ("d", "3", None, 7)], "doc_id string, section_id string, parent_section string, seq int")
    assert sorted((r["section_id"], r["first_seq"], r["last_seq"]) for r in U.section_units(sections).collect()) == [("1.1", 2, 4), ("2", 5, 6), ("3", 7, 7)]


def test_leaked_tables(spark):
    from ledgerloom.operators.hierarchy import leaked_tables

    sections = spark.createDataFrame([("d", "a", "1", None), ("d", "b", "1.1", "a"), ("d", "c", "2", None)], "doc_id string, section_id string, section_no string, parent_section string")
    tables = spark.createDataFrame([("d", 1, "b", "2"), ("d", 2, "b", "1"), ("d", 3, "b", "b"), ("d", 4, "a", "b"), ("d", 5, "b", "nowhere"), ("d", 6, "b", None)], "doc_id string, table_no int, unit_section string, echo string")
    assert sorted((r["table_no"], r["owner"]) for r in leaked_tables(tables, sections).collect()) == [(1, "c"), (4, "b")]


def test_anchor_files(spark, tmp_path):
    from ledgerloom.sources.readers import anchor_declarations, anchor_sets, read_anchors, rebuildable

    head = "bank,concept,row_order,section,table_type_id,canonical_leaf_id,sign,filter_by\n"
    (tmp_path / "main_anchors.csv").write_text("﻿\n" + head + "B,Net,2,Income,FS,a,,\nB,Net,9,Other,FS,b,-1,typo\nC,Net,1,,FS,a,1,\n,Lost,1,,FS,a,1,\n")
    (tmp_path / "main_formulaanchors.csv").write_text(head + "B,Net,5,,FS,c,1,\n")
    (tmp_path / "lone_formulaanchors.csv").write_text(head + "B,Alone,1,,FS,a,1,\n")
    got = [tuple(r) for r in read_anchors(spark, str(tmp_path), "main").orderBy("bank", "member_ordinal").select("bank", "canonical_leaf_id", "sign", "member_ordinal", "row_order", "section", "filter_by").collect()]
    assert got == [("B", "a", 1, 1, 2, "Income", None), ("B", "b", -1, 2, 2, "Income", "typo"), ("B", "c", 1, 3, 2, "Income", None), ("C", "a", 1, 1, 1, None, None)]
    assert sorted(tuple(r) for r in anchor_sets(spark, str(tmp_path)).collect()) == [("lone", 0, 1, True), ("main", 4, 1, False)]
    assert {(r["bank"], r["canonical_leaf_id"]): r["anchor_set"] for r in anchor_declarations(spark, str(tmp_path)).collect()} == {("B", "a"): "lone", ("B", "b"): "main", ("B", "c"): "main", ("C", "a"): "main"}
    (tmp_path / "none").mkdir()
    assert read_anchors(spark, str(tmp_path / "none")).count() == 0
    docs = spark.createDataFrame([("A_1",), ("b_2",), ("c",)], "doc_id string")
    assert [r[0] for r in rebuildable(docs, docs.where("doc_id <> 'c'"), ["a_"]).collect()] == ["A_1"] and rebuildable(docs, docs).count() == 3


def test_letter_headings(spark):
    v = lambda *xs: [{"value": x, "cell_state": None} for x in xs]
    row = lambda label, values: {"row_id": None, "row_type": None, "level": 0, "parent": None, "label": label, "values": values}
    letters = [{"group": "G", "leaf": "A"}, {"group": None, "leaf": "b"}]
    plain = [{"group": None, "leaf": "2020"}, {"group": None, "leaf": "B"}]
    stacked = [row("2025", None), row("2024", v("", None)), row("Fees", v("1", "2"))]
    df = spark.createDataFrame([("u", 0, letters, stacked), ("u", 1, plain, stacked), ("u", 2, letters, stacked[1:]), ("u", 3, letters, None), ("u", 4, None, stacked), ("u", 5, [], [])], TABLE)
    got = {r["table_no"]: ([x["leaf"] for x in r["columns"] or []], len(r["rows"] or [])) for r in U.repaired_headings(df, ["unit_id", "table_no"]).collect()}
    assert got == {0: (["2025", "2024"], 1), 1: (["2020", "B"], 3), 2: (["A", "b"], 2), 3: (["A", "b"], 0), 4: ([], 3), 5: ([], 0)}
