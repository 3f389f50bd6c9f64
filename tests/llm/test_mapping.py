import random

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.confusables import confusables
from ledgerloom.llm.mapping import GluedIndex, MapRule, Matcher, WordIndex, alike, edits, map_labels, words_of

ENTRIES = [("results", "interest earned on lending", "nii"), ("results", "fee and service income", "fees"), ("results", "of which client flow", "flow"), ("capital", "core capital ratio", "ratio"), ("capital", "credit exposure", "credit"), ("*", "rounding difference", "round"), ("funding", "depots a terme", "term"), ("funding", "others", "other"), ("lines", "others", "seg.other")]


class Asked:
    """Answers of the operator to single labels, asked for together."""

    def __init__(self, spark):
        self.spark = spark

    def all(self, asks):
        df = self.spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(asks)], "i int, scope string, label string")
        ref = self.spark.createDataFrame(ENTRIES, "scope string, label string, concept string")
        return [(r["concept"], r["score"], r["how"]) for r in map_labels(df, ref).orderBy("i").collect()]

    def best(self, scope, label):
        return self.all([(scope, label)])[0]


@pytest.fixture(scope="module")
def matcher(spark):
    return Asked(spark)


SAME = ["interest earned on lending", "(a) INT EARNED ON LENDG", "on lending, interest earned - group", "interest earned on lending (S$m) *", "interestearned lending", "o/w interst earned on lendings /1", "Interest_Earned-on lending(note 4)", "ｉｎｔｅｒｅｓｔ earned on lending"]


def test_same_entry(matcher):
    assert {a[0] for a in matcher.all([("results", x) for x in SAME])} == {"nii"}


def test_none_meant(matcher):
    none = ["courier permits", "12.4", "-", "???", "", None, "see above", "vending rota", "core capital ratio", "x" * 20_000]
    assert {a[0] for a in matcher.all([("results", x) for x in none])} == {""}
    asks = [(None, "core capital ratio"), ("capital", "RATlO, CORE CAPITAL"), ("capital", "rounding difference"), ("funding", "Dépôts à terme"), ("lines", "others (a)"), ("unknown", "others")]
    got = matcher.all(asks)
    assert [a[0] for a in got] == ["ratio", "ratio", "round", "term", "seg.other", ""] and got[2][2] == "mention"


def test_words_and_edits(spark):
    assert words_of("(a) The Fees [S$m] - group (restated)", confusables(spark)) == ["fees"]
    assert edits("abcd", "abdc", 2) == 1 and edits("abc", "xyz", 1) == 2
    assert alike("int", "interest") > 0.8 and alike("lendg", "lending") > 0.8 and alike("rota", "ratio") < 0.9 and alike("1", "12") == 0


def test_noisy_labels_come_back(matcher):
    rng = random.Random(3)
    asks, right = [], []
    for _ in range(300):
        scope, label, concept = rng.choice(ENTRIES[:5])
        words = label.split()
        w = rng.randrange(len(words))
        x = list(words[w])
        if len(x) > 3:
            i = rng.randrange(1, len(x) - 1)
            x[i], x[i + 1 if i + 1 < len(x) else i] = x[i + 1 if i + 1 < len(x) else i], x[i]
        words[w] = "".join(x)
        asks.append((scope, " ".join(words)))
        right.append(concept)
    assert sum(a[0] == r for a, r in zip(matcher.all(asks), right)) >= 294


def test_in_spark(spark):
    labels = spark.createDataFrame([(1, "results", "int earned on lendg", 3), (1, "results", "int earned on lendg", 3), (2, None, None, 3), (3, "results", "", 3), (4, "results", "of which client flow and credit exposure", 3), (5, "capital", "of which credit exposure", 3)], "alias_id long, scope string, label string, x int")
    ref = spark.createDataFrame(ENTRIES + [("results", None, "null"), ("results", "none", None), ("results", "credit exposure", "own")], "scope string, label string, concept string")
    seen = []
    for block in (100, 3, 1):  # the whole list at once, and in blocks: rows, mentions of two blocks and scores are the same
        seen.append(sorted(tuple(r) for r in map_labels(labels, ref, block=block).collect()))
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == 6
    assert [(r[0], r[4]) for r in seen[0]][:4] == [(1, "nii"), (1, "nii"), (2, ""), (3, "")] and seen[0][4][6] != "mention" and seen[0][5][4] == "credit"
    assert [r["concept"] for r in map_labels(labels, ref.limit(0)).collect()] == [""] * 6
    assert map_labels(labels.limit(0), ref).count() == 0


WORDS = st.text("abst", min_size=1, max_size=9)


@settings(max_examples=60, deadline=None)
@given(st.sets(WORDS, min_size=1, max_size=25), WORDS)
def test_word_index_finds_all(words, asked):
    index = WordIndex(words)
    assert index.near(asked) == {w: alike(asked, w) for w in words if alike(asked, w) > 0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=26), min_size=1, max_size=10), st.text("ab", min_size=5, max_size=28))
def test_glued_index_finds_all(wholes, asked):
    near = GluedIndex(wholes).near(asked)
    assert {i for i, w in enumerate(wholes) if edits(asked, w, GluedIndex.allowed(len(w))) <= GluedIndex.allowed(len(w))} <= near
