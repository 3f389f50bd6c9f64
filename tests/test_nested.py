import json
import random

import pytest

from ledgerloom.operators.nested import CHUNK_BYTES, Index, _unwrap, flatten, flatten_chunk, stated_values

DOC = {"tables": [{"title": "A \"q\" \\ {x}", "columns": [{"group": None, "leaf": "c1"}, None], "rows": [
    {"label": "r0", "level": 1, "values": [{"value": "1", "cell_state": "reported"}, "2", 3, 4.50, None, {"value": None}, {"value": ""}, ""]},
    None, {"label": "é", "values": None}, {"label": "x"}, {"values": [[1], {"other": 2}]}]}, None, {"title": None, "rows": []}]}


def values(text):
    out = flatten_chunk(["u"], [_unwrap(text)])
    return out, [(int(r.table_no), int(r.row_no), int(r.col_no), r.value) for r in out[out.rel == "value"].itertuples()]


def test_values_and_positions():
    out, got = values(json.dumps(DOC))
    assert [g for g in got if isinstance(g[3], str) and g[3]] == [(0, 0, 0, "1"), (0, 0, 1, "2"), (0, 0, 2, "3"), (0, 0, 3, "4.5")]
    assert len([g for g in got if g[:2] == (0, 0)]) == 8 and len(out[out.rel == "row"]) == 5 and len(out[out.rel == "table"]) == 3
    assert out[(out.rel == "table") & (out.table_no == 0)].title.iloc[0] == 'A "q" \\ {x}'
    assert set(out[out.rel == "row"].label.dropna()) == {"r0", "é", "x"}


@pytest.mark.parametrize("wrap", [lambda d: "﻿" + json.dumps(d), lambda d: json.dumps(json.dumps(d)), lambda d: json.dumps({"extraction": d, "note": None}), lambda d: json.dumps(d, indent=2, ensure_ascii=False), lambda d: json.dumps({"tables": d["tables"][0]})])
def test_forms_of_the_contract(wrap):
    assert [g for g in values(wrap(DOC))[1] if isinstance(g[3], str) and g[3]][:4] == [g for g in values(json.dumps(DOC))[1] if isinstance(g[3], str) and g[3]][:4]


def test_only_json_is_readable():
    rng = random.Random(4)
    base = json.dumps(DOC)
    texts = ["", " ", "null", "3", '"x"', "{}", "[]", '{"a":}', '{"a":1,}', "[1,2", '{"a":1}x', '{"a" "b":1}', '{"a":[{} {}]}', '{"tables":[,]}', '{1:2}', '{"a":tru}', '{"a":"\\u00e9"}', '{"a":"\\x"}', '{"a":01}', '{"a":"b\nc"}']
    for _ in range(1500):
        i = rng.randrange(len(base))
        texts.append(rng.choice([base[:i], base[:i] + rng.choice('{}[],:"\\ 1a') + base[i:], base[:i] + base[i + 1 :]]))
    ix = Index([_unwrap(t) for t in texts])
    for text, ok, first in zip(texts, ix.ok, ix.first):
        try:
            want = isinstance(json.loads(text), (dict, list))
        except ValueError:
            want = False
        assert want == bool(ok and first >= 0), text[-80:]


def test_in_spark(spark):
    long = json.dumps({"tables": [{"rows": [{"values": ["x" * (CHUNK_BYTES + 5)]}]}]})
    df = spark.createDataFrame([("a", json.dumps(DOC), 1), ("b", None, 1), ("c", "", 1), (None, "{", 1), ("l", long, 1), ("m", '{"tables": []}', 1)], "unit_id string, payload string, rel int")
    out = flatten(df)
    assert sorted(r["unit_id"] or "" for r in out.where("rel = 'unreadable'").collect()) == ["", "b", "c"]
    assert out.where("rel = 'unit'").count() == 3
    assert sorted(tuple(r) for r in stated_values(out).collect()) == [("a", 0, 0, 0), ("a", 0, 0, 1), ("a", 0, 0, 2), ("a", 0, 0, 3), ("l", 0, 0, 0)]
    assert flatten(df.limit(0)).count() == 0
