from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions.labels import caption_key, caption_parts, caption_variants, family, filing_family, house_of, leaf_id, safe_clean, segment
from ledgerloom.operators import metrics as M

P = date(2026, 6, 30)
BASE = "institution string, concept_key string, period date, period_span string, segment_key string, geo_key string, industry_key string, legal_entity string, value_num double, unit string"


def metric(value, concept="c", unit=None, house="B", period=P, seg=None):
    return (house, concept, period, "1H", seg, None, None, None, value, unit)


def test_candidates(spark):
    rows = [(*metric(10.0, "a"), 1, 0, False, "p1"), (*metric(10.4, "a"), 1, 0, False, "p2"), (*metric(-99.0, "a"), 2, 0, False, "p3"), (*metric(5.0, "b"), 2, 0, True, "p1"), (*metric(500.0, "b"), 0, 0, False, "p2"), (*metric(-3.0, "s"), 1, 2, False, "p1"), (*metric(7.0, "s"), 1, 1, False, "p2"), (*metric(None, "n"), 1, 1, False, "p")]
    got = {r["concept_key"]: (r["value_num"], r["n_candidates"], r["resolved_by"]) for r in M.resolve_candidates(spark.createDataFrame(rows, BASE + ", tier int, depth int, anchored boolean, place string")).collect()}
    assert got == {"a": (10.0, 3, "tier"), "b": (5.0, 1, "single"), "s": (7.0, 2, "conflict")}


def test_units_formulas_averages(spark):
    df = spark.createDataFrame([metric(1.0, "a", "m"), metric(2.0, "a", None), metric(3.0, "a", None, "C"), metric(4.0, "b", "m"), metric(4.0, "b", "k", "C"), metric(4.0, "b", None, "D")], BASE)
    assert sorted((r["value_num"], r["unit"]) for r in M.infer_units(df).where("concept_key = 'a'").collect()) == [(1.0, "m"), (2.0, "m"), (3.0, "m")]
    assert M.infer_units(df).where("institution = 'D'").first()["unit"] is None
    base = spark.createDataFrame([metric(30.0, "cost"), metric(60.0, "income"), metric(0.0, "income", house="C"), metric(1.0, "cost", house="C"), metric(0.5, "ratio", house="E"), metric(1.0, "cost", house="E"), metric(4.0, "income", house="E")], BASE)
    out = {(r["institution"], r["concept_key"]): (r["value_num"], r["origin"]) for r in M.formulas(base, [("ratio", F.try_divide(F.col("cost"), F.col("income")), ["cost", "income"])]).collect()}
    assert out["B", "ratio"] == (0.5, "derived") and out["E", "ratio"] == (0.5, "reported") and ("C", "ratio") not in out
    series = spark.createDataFrame([metric(10.0, period=date(2026, 3, 31)), metric(20.0), metric(None, period=date(2026, 9, 30))], BASE)
    assert [r["average"] for r in M.period_average(series).orderBy("period").collect()] == [10.0, 15.0, 20.0]


def test_cuts_duplicates_coverage(spark):
    cells = spark.createDataFrame([metric(1.0, seg="A"), metric(1.0, seg="B"), metric(1.0, seg="SEG_TOTAL"), metric(1.0)], BASE)
    assert [tuple(r)[3:] for r in M.breakdown_cuts(cells).collect()] == [("segment", 2)]
    tables = spark.createDataFrame([("d", "t1", 1, 0, 1), ("d", "t2", 1, 3, 1), ("d", "t3", 2, 9, 1)], "doc_id string, table_id string, page int, anchors int, depth int")
    values = spark.createDataFrame([("d", t, v) for t in ("t1", "t2", "t3") for v in ("1", "2", "2")], "doc_id string, table_id string, value_raw string")
    assert sorted((r["table_id"], r["canonical_id"], r["quarantined"]) for r in M.pick_canonical(tables, values).collect()) == [("t1", "t2", True), ("t2", "t2", False)]
    declared = spark.createDataFrame([("B", x) for x in "abcde"], "institution string, concept_key string")
    rows = spark.createDataFrame([("B", "b", None), ("B", "c", "l"), ("B", "d", "l"), ("B", "e", "l")], "institution string, concept_key string, canonical_leaf_id string")
    cells = spark.createDataFrame([("B", "c", None, "m"), ("B", "d", 1.0, None), ("B", "e", 1.0, "m")], "institution string, concept_key string, value_num double, unit string")
    assert {r["concept_key"]: r["status"] for r in M.coverage_matrix(declared, rows, cells).collect()} == {"a": "absent", "b": "no structure", "c": "no value", "d": "no unit", "e": "clean"}
    built, stored = spark.createDataFrame([metric(1.0, "a"), metric(2.0, "b"), metric(3.0, "x")], BASE), spark.createDataFrame([metric(1.2, "a"), metric(9.0, "b"), metric(3.0, "y")], BASE)
    assert {r["concept_key"]: r["status"] for r in M.compare_metrics(built, stored).collect()} == {"a": "same", "b": "differs", "x": "only_built", "y": "only_stored"}


def run(spark, f, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select("i", f(F.col("t")).alias("x")).orderBy("i").select("x").collect()]


def test_labels(spark):
    assert run(spark, segment, ["Fees & costs (1)", "2024", "Réserve"]) == ["fees_and_costs", "2024", "réserve"]
    assert run(spark, caption_key, ["3. Net interest income (cont'd) — 1H25", "Loans"]) == ["net_interest_income", "loans"]
    parts = run(spark, caption_parts, ["NPAs (continued) — NPLs by industry", "Loans — The Group"])
    assert [(p["base"], p["breakdown"]) for p in parts] == [("NPAs", "NPLs by industry"), ("Loans — The Group", None)]
    assert run(spark, caption_variants, ["Audited income (continued) — The Group\nFOR THE YEAR"])[0][-1] == "income"
    assert run(spark, lambda x: leaf_id(F.array(F.lit("assets"), F.lit("loans")), x), ["Loans", "of which: Cards", None]) == ["assets::loans", "assets::loans::of_which::cards", "assets::loans"]
    assert run(spark, family, ["Condensed Interim Financial Statements", None]) == ["financial_statements", ""]
    assert run(spark, filing_family, ["DBS_4Q25_condensed-financial-statements", "1Q23_trading_update", "x"]) == ["financial_statements", "trading_update", "x"]
    pairs = spark.createDataFrame([("Total income", "Total income 1"), ("Fees¹", "Fees"), ("x", None), (None, "y"), ("ab", "ba")], "a string, b string")
    assert [r[0] for r in pairs.select(safe_clean(F.col("a"), F.col("b"))).collect()] == ["Total income", "Fees", "x", None, "ab"]
    assert run(spark, lambda x: house_of(x, {"velholm": "VEL", "mari": "MAR"}), ["Velholm Bank", "Marisund", "Z", None]) == ["VEL", "MAR", "Other", "Other"]
