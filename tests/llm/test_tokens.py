import random

import pytest

from ledgerloom.llm.tokens import TOKENIZERS, Encoder, count_tokens, encode_corpus

ALPHABET = "ab'srelvtdm  \n\t é1２漢，.!—🙂́\x1c\x85İ"


def test_joins_equal_one_pass():
    rng = random.Random(5)
    encoders = [Encoder(leaf=n) for n in (2, 3, 5, 16, 64)]
    whole = encoders[0].bpe.encode_ordinary
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(80))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 3000, "we're they've I'll " * 200, "\n\n \n" * 500, "x1" * 900, "漢字" * 700]
    for text in texts:
        for e in encoders:
            assert e.encode(text) == whole(text)


def test_against_the_other_library():
    tokenizers = pytest.importorskip("tokenizers")
    other = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    other.encode_special_tokens = True
    e = Encoder(leaf=40)
    for text in ["Hello, world", "<|endoftext|> stays text", "S$12.3 million — 2Q24", "Crédit-bail ²", "x" * 10_000]:
        assert e.encode(text) == other.encode(text, add_special_tokens=False).ids
        assert e.decode(e.encode(text)) == text


def test_corpus(spark):
    df = spark.createDataFrame([(1, "one two", 5), (1, "one two", 5), (2, "", 5), (3, None, 5), (None, " ", 5)], "doc_id long, text string, ids int")
    got = sorted(((r["doc_id"] or 0), r["ids"]) for r in encode_corpus(df).collect())
    assert [g[0] for g in got] == [0, 1, 1, 2, 3] and got[3][1] == [] and got[4][1] == [] and len(got[1][1]) == 2 and len(got[0][1]) == 1
    assert encode_corpus(df.limit(0)).count() == 0
    assert sorted(r["tokens"] for r in count_tokens(df, ["doc_id"]).collect()) == [0, 0, 1, 2, 2]
