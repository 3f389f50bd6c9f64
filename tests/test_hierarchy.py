import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.operators.hierarchy import hierarchy, peel, rank_list, table_links, tours

S = "scope string, node string, parent string, depth int"


def brute(rows):
    """Root, depth and path by walking up, for {(scope, node): parent}."""
    out = {}
    for (scope, node), parent in rows.items():
        chain, at = [node], node
        endless = False
        while (up := rows.get((scope, at))) is not None and (scope, up) in rows:
            if up in chain:
                endless = True
                break
            chain.append(up)
            at = up
        out[scope, node] = ("" if endless else chain[-1], chain)
    return out


def check(spark, rows, **kw):
    df = spark.createDataFrame([(s, n, p, 7) for (s, n), p in rows.items()], S)
    got = {(r["scope"], r["node"]): r for r in hierarchy(df, **kw).collect()}
    want = brute(rows)
    assert set(got) == set(want)
    for key, (root, chain) in want.items():
        assert got[key]["root"] == root, key
        if root:
            assert got[key]["depth"] == len(chain) - 1 and got[key]["path"] == " > ".join(reversed(chain))
            for other, (_, line) in want.items():  # entry-exit intervals are ancestry
                if other[0] == key[0] and want[other][0]:
                    inside = got[key]["entry"] < got[other]["entry"] < got[key]["exit"]
                    assert inside == (key[1] in line[1:])
            assert got[key]["descendants"] == sum(key[1] in line[1:] for (s, _), (r, line) in want.items() if s == key[0] and r)
    return got


def sample(seed, n=40):
    rng = random.Random(seed)
    rows = {}
    for scope in "xy":
        names = [f"n{i}" for i in range(n)]
        for x in names:
            rows[scope, x] = rng.choice([None, "gone", x, *names, *names])
    return rows


def test_forest_with_cycles(spark):
    got = check(spark, sample(1))
    assert any(r["in_cycle"] for r in got.values())


def test_joins_agree_with_tasks(spark):
    rows = sample(2, 25)
    a, b = check(spark, rows), check(spark, rows, task_nodes=5)
    for key, r in a.items():
        assert (r["root"], r["in_cycle"]) == (b[key]["root"], b[key]["in_cycle"])
        assert tuple(r) == tuple(b[key])


def test_deep_chain_and_edges(spark):
    rows = {("s", f"{i:03d}"): (f"{i - 1:03d}" if i else None) for i in range(300)}
    check(spark, rows)
    assert hierarchy(spark.createDataFrame([], S)).count() == 0
    df = spark.createDataFrame([(None, "a", None, 1), (None, "b", "a", 1), (None, "b", "a", 2), ("s", None, "a", 1)], S)
    assert sorted((r["scope"], r["node"], r["root"]) for r in hierarchy(df).collect()) == [("", "a", "a"), ("", "b", "a")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(-1, 30), max_size=30))
def test_kernels(parents):
    parent = np.array([p if p < len(parents) else -1 for p in parents], np.int64)
    left = peel(parent)
    for v in range(len(parent)):
        seen, at = set(), v
        while parent[at] >= 0 and at not in seen:
            seen.add(at)
            at = parent[at]
        assert left[v] == (parent[at] >= 0 and at == v)
    forest = np.where(left, -1, parent)
    depth, entry, exit_, root = tours(forest)
    assert sorted([*entry, *exit_]) == list(range(2 * len(parent)))
    for v in range(len(parent)):
        at, d = v, 0
        while forest[at] >= 0:
            at, d = forest[at], d + 1
        assert (depth[v], root[v]) == (d, at)


def test_list_ranking():
    count, total = rank_list(np.array([1, 2, 2, 3]), np.array([5, 7, 9, 1]))
    assert count.tolist() == [3, 2, 1, 1] and total.tolist() == [21, 16, 9, 1]


def test_table_links(spark):
    row = "row_id string, row_type string, level int, parent string, label string"
    rows = [("1", "section_header", 0, None, "Top"), ("2", "data", 0, None, "Assets"), (None, "data", 1, " H1 ", "Cash"), ("4a", "data", 2, "h2", "Notes"), ("5", "data", 3, "4A", "Coins"), ("6", "data", 1, "assets", "Others"), ("7", "data", 2, "others", "Deep"), ("8", "data", 1, "h9", "Lost"), None, ("10", "data", 1, "10", "Self"), ("11", "data", 1, "  ", "Blank")]
    df = spark.createDataFrame([("u", [{"rows": None}, {"rows": rows}, None])], f"unit_id string, tables array<struct<rows:array<struct<{row.replace(' ', ':').replace(',:', ',')}>>>>")
    got = {r["node"]: r["parent"] for r in table_links(df).where("scope = 'u:1'").collect()}
    assert got == {"0": None, "1": None, "2": "1", "3": "2", "4": "3", "5": "1", "6": "5", "7": "?h9", "8": None, "9": "9", "10": None}
