from datetime import date

from pyspark.sql import functions as F

from ledgerloom.functions.periods import clamp_year, period_label, read_period
from ledgerloom.functions.text import label_key, plain, slug, strip_footnotes
from ledgerloom.functions.values import cell_number, cell_state, expand_pages, page_token


def run(spark, texts, **cols):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *[f(F.col("t")).alias(k) for k, f in cols.items()]).orderBy("i").collect()]


def test_periods(spark):
    cases = {
        "30 Jun 2025": (date(2025, 6, 30), "as_at", None), "Year ended 31 December 2024": (date(2024, 12, 31), "FY", date(2024, 1, 1)),
        "Half year ended 30 June 2025": (date(2025, 6, 30), "1H", date(2025, 1, 1)), "2nd Half 2024": (date(2024, 12, 31), "2H", date(2024, 7, 1)),
        "1H25": (date(2025, 6, 30), "1H", date(2025, 1, 1)), "3Q 2024": (date(2024, 9, 30), "3Q", date(2024, 7, 1)), "Second Quarter 2025": (date(2025, 6, 30), "2Q", date(2025, 4, 1)),
        "9 Mths 2025": (date(2025, 9, 30), "9M", date(2025, 1, 1)), "FY24": (date(2024, 12, 31), "FY", date(2024, 1, 1)), "Funds — 2024": (date(2024, 12, 31), "FY", date(2024, 1, 1)),
        "2025": None, "Basel III 2024 framework": None, "Dec-25": None, "Net loans": None, "": None, None: None,
    }
    got = run(spark, list(cases), p=read_period)
    assert [None if g[0] is None else (g[0]["end"], g[0]["span"], g[0]["start"]) for g in got] == list(cases.values())
    heads = {"2025": (date(2025, 12, 31), "FY"), "Dec-25": (date(2025, 12, 31), "as_at"), "2H25¹ $m": (date(2025, 12, 31), "2H"), "Q1 2019": (date(2019, 3, 31), "1Q"), "Sept 2023": (date(2023, 9, 30), "as_at"), "Note": None}
    got = run(spark, list(heads), p=lambda c: read_period(c, True))
    assert [None if g[0] is None else (g[0]["end"], g[0]["span"]) for g in got] == list(heads.values())


def test_labels_of_periods(spark):
    df = spark.createDataFrame([(0, date(2025, 12, 31), "FY"), (1, date(2025, 12, 31), "as_at"), (2, date(2025, 12, 31), None), (3, None, "FY")], "i int, p date, s string").orderBy("i")
    assert [r[0] for r in df.select(period_label(F.col("p"), F.col("s"))).collect()] == ["FY25", "31-Dec-25", "31-Dec-25", ""]
    clamp = spark.createDataFrame([("2026", date(2026, 12, 31), "FY", date(2026, 6, 30)), ("2025", date(2025, 12, 31), "FY", date(2026, 6, 30)), ("FY26", date(2026, 12, 31), "FY", date(2026, 6, 30))], "l string, e date, s string, d date")
    got = [tuple(r[0]) for r in clamp.select(clamp_year(F.col("l"), F.col("e"), F.col("s"), F.col("d"))).collect()]
    assert got == [(date(2026, 6, 30), "1H"), (date(2025, 12, 31), "FY"), (date(2026, 12, 31), "FY")]


def test_values(spark):
    cases = {"": ("empty", None), "-": ("null", None), "–": ("null", None), "#": ("suppressed", None), "0": ("zero", 0.0), "0.0": ("reported", 0.0), "(1,505)": ("reported", -1505.0), "137%": ("reported", 137.0), "1.2x": ("reported", None), "AAA to BBB+": ("reported", None), "S$1.63": ("reported", 1.63), "12d": ("reported", None), "nan": ("reported", None), None: ("empty", None), "x" * 5000: ("reported", None)}
    assert run(spark, list(cases), s=cell_state, n=cell_number) == list(cases.values())
    assert run(spark, ["S$1,234", "(5)", "7¹", "word", None], n=page_token) == [(1234.0,), (-5.0,), (7.0,), (None,), (None,)]
    assert run(spark, ["3,5-7", "9-8, x,3", "", None], p=expand_pages) == [([3, 5, 6, 7],), ([3, 8, 9],), ([],), (None,)]


def test_text(spark):
    assert run(spark, ["ＡＢ　c​d", "a  b¹ (2)", "Note (note 7) /a", "(1)", None], p=plain, k=label_key, f=strip_footnotes) == [("AB cd", "ab cd", "ＡＢ　c​d"), ("a  b¹ (2)", "a b", "a  b"), ("Note (note 7) /a", "note", "Note"), ("(1)", "(1)", "(1)"), (None, None, None)]
    assert run(spark, ["4. Fees & costs!", "", None], s=slug) == [("4_fees_costs",), ("",), (None,)]
