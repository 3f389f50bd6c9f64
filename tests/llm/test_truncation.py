from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.truncation import find_truncated, strict_prefixes, truncation_rates

D = "doc_id long, source string, text string, key int, n_chars int"


def run(spark, texts):
    df = spark.createDataFrame([(i, "s", t, 1, 1) for i, t in enumerate(texts)], D)
    return {r["doc_id"]: r["evidence"] for r in find_truncated(df).collect()}


BODY = ["The board proposes a dividend of 12 cents a share, to be paid after the meeting. Costs fell 4.5%, mostly because of levies. Staff numbers reached 1380 at the close of 4Q21. The end.",
        "The board proposes a dividend of 3 cents a share, to be paid after the meeting. Staff numbers reached 99 at the close of 1Q20. Costs fell 1.0%. Done.",
        "Fees\t1.5\t2.5\nCosts\t3.5\t4.5\nLoans\t3.5\t4.5\nTotal\t5.0\t7.0", "Costs\t1.5\t2.5\nLoans\t3.5\t4.5\nFees\t3.5\t4.5\nTotal\t5.0\t7.0", "Loans\t1.5\t2.5\nFees\t3.5\t4.5\nCosts\t3.5\t4.5\nTotal\t5.0\t7.0"]


def test_kinds(spark):
    texts = BODY + [
        "All well. The board proposes a dividend of 77 cents a sh",  # 5 within a word
        "All well. Costs fell 9",  # 6 within a sentence
        "Odd start: Velholm proposes a dividend of 5 cents a share, to be pa",  # 7 only its words are known
        "Staff numbers reached 1380 at the close of 1Q1",  # 8 within a figure
        "All well. The boar…",  # 9
        "All well. Things chan�",  # 10
        "Fees\t1.5\t2.5\nCosts\t3.5",  # 11 within a row
        "Loans\t1.5\t2.5\nFees\t3.5\t4.5",  # 12 a table without its end
        "All well. Costs fell 1.0%",  # 13 whole, lacks the stop
        "All well.\nEnd of section 4.2", "All well.\nSee also note 35", "All well.\nLending, notes and so on ...", "", "  \n", None, "All well. The board proposes a dividend of 1 cents a share, to be paid after the meeting.",
    ]
    got = run(spark, texts)
    assert got == {5: "prefix", 6: "prefix", 7: "words", 8: "figure", 9: "prefix", 10: "mark", 11: "prefix", 12: "table"}


def test_long_ties_and_rates(spark):
    long = "word " * 30_000 + "final sentence that goes on and on until it stops."
    texts = [long, long[:-20], long[:-20], long[:-20]]
    df = spark.createDataFrame([(i, None if i == 3 else "s", t, 1, 1) for i, t in enumerate(texts)] + [(9, "s", None, 1, 1), (None, "s", "x.", 1, 1)], D)
    bad = find_truncated(df)
    assert sorted(r["doc_id"] for r in bad.collect()) == [1, 2, 3]
    rates = {r["source"]: (r["documents"], r["texts"], r["truncated"]) for r in truncation_rates(df, bad).collect()}
    assert rates == {"s": (5, 4, 2), None: (1, 1, 1)}
    assert find_truncated(df.limit(0)).count() == 0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=40), min_size=1, max_size=40), st.lists(st.text("ab", min_size=1, max_size=40), min_size=1, max_size=40))
def test_strict_prefixes(spark, asked, keys):
    asked += [k[: len(k) // 2] for k in keys if len(k) > 1] + ["a" * 12, "ab" * 12]
    keys += ["a" * 13, "ab" * 12, "ab" * 40, "b" * 100]
    a, k = (spark.createDataFrame([(x,) for x in xs], "key string") for xs in (asked, keys))
    got = sorted(r["key"] for r in strict_prefixes(a, k).collect())
    assert got == sorted(q for q in set(asked) if any(x.startswith(q) and len(x) > len(q) for x in keys))
