from ledgerloom.llm.confusables import confusables, disguised, groups, relation


def test_relation(spark):
    """The whole public relation, not a choice of it; letters stand for the plain one of their case."""
    by = confusables(spark)
    assert len(relation(spark)) > 5_000 and by.letters[ord("І")] == "I" and by.letters[ord("о")] == "o" and by.letters[ord("ɑ")] == "a" and by.letters[ord("օ")] == "o"
    assert by.skeleton("рayраl") == by.skeleton("paypal") and by.skeleton("Il1|") == "llll" and by.canonical("bɑnk") == "bank"
    df = spark.createDataFrame([("Im 10% \"x\"|`",)], "t string")
    assert df.select(by.ascii_skeleton(df.t)).first()[0] == by.skeleton("Im 10% \"x\"|`")


def test_forms(spark):
    by = confusables(spark)
    canonical, disguise, foreign_words, skeleton = by.canonical, by.disguise, by.foreign_words, by.skeleton
    same = ["Café", "AA – B — C", "Fees ²", "Μετοχικό κεφάλαιο", "Δ on prior year", "β-weighted", "Капитал и резервы", "現金及存款", "", "12,345", "x" * 100_000, "it’s", "現金（存款）"]
    assert [t for t in same if disguise(t)] == []
    cases = {"Ｔｏｔａｌ": "Total", "Totаl": "Total", "Café": "Café", "1​23": "123", "a\u00a0b": "a b", "﻿x": "x", "ﬁnance": "finance", "AA‑ to B": "AA- to B", "NМ": "NM", "so­ft": "soft", "AΑ": "AA", "（5）": "(5)"}
    for text, form in cases.items():
        assert disguise(text) and canonical(text) == form and canonical(form) == form and skeleton(text) == skeleton(form)
    assert foreign_words("АА bank") == 1 and foreign_words("Капитал") == 0


KEY = "rel string, doc_id string, n int, text string, skeleton int"


def test_disguised(spark):
    rows = [("r", "d", 1, "Totаl", 0), ("r", "d", 1, "Totаl", 0), ("r", "d", 2, "Total", 0), ("r", "d", 3, None, 0), ("r", "d", 4, "", 0), ("r", "d", 5, "АА notes", 0), ("r", "d", 6, "AA notes", 0), ("r", "d", 7, "ВВ alone", 0), (None, None, None, "a\u00a0b", 0)]
    df = spark.createDataFrame(rows, KEY)
    assert sorted((r["n"] or 0) for r in disguised(df, ["rel", "doc_id", "n"]).collect()) == [0, 1, 5]
    more = spark.createDataFrame([("r", "d", 8, "АА – notes", 0), ("r", "d", 9, "AA – notes", 0)], KEY)
    assert [r["n"] for r in disguised(more, ["rel", "doc_id", "n"]).collect()] == [8]
    assert disguised(df.limit(0), ["rel", "doc_id", "n"]).count() == 0
    g = {r["canonical"]: (r["texts"], r["records"], r["disguised"]) for r in groups(df.select("text")).collect()}
    assert g["Total"] == (2, 3, 1) and g["AA notes"] == (2, 2, 0) and g[""] == (1, 1, 0)
