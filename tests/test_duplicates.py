import pytest

import __spark_entry__ as entry_module
import verify
from ledgerloom.operators import structure as X

V = "doc_id string, table_id string, row_id int, col_id int, row_leaf_label string, value_raw string, unit string"


def table(t, n, doc="d", odd=None):
    return [(doc, t, i, k, f"Row {i}", "odd" if i == odd and k == 2 else f"{i}.{k}", None) for i in range(n) for k in (1, 2)]


def test_query_is_its_sql_and_reads_the_cells_once(spark, tmp_path):
    """Three copies, a near copy of them all, repeated records and records that differ in another field only; one pass over the cells."""
    rows = [*table("a", 10), *table("b", 10), *table("c", 10), *table("near", 10, odd=3), *table("far", 11, odd=3), *table("a", 10, "e")]
    rows += [rows[0], rows[0], ("e", "a", 0, 1, "Row 0", "0.1", "S$m"), ("e", "b", 0, None, None, None, None), ("e", "c", 0, 5, None, "", None), (None, "a", 0, 1, "Row 0", "0.1", None)]
    spark.createDataFrame(rows, V).coalesce(1).write.parquet(f"{tmp_path}/made")
    (path,) = (tmp_path / "made").glob("*.parquet")
    path.rename(tmp_path / "v_cell.parquet")
    df = entry_module.queries()["duplicate_tables"](spark, str(tmp_path))
    got = [tuple(r) for r in df.collect()]
    cursor = verify.connect(str(tmp_path)).execute(entry_module.oracle_sql()["duplicate_tables"])
    columns = [d[0] for d in cursor.description]
    assert verify.rows(df.columns, got) == verify.rows(columns, cursor.fetchall()) and len(got) == 8
    assert not [f for f in df.inputFiles() if "v_cell" in f]


@pytest.mark.parametrize("broadcast", [True, False])
def test_copies_are_paired_as_asked(spark, monkeypatch, broadcast):
    import random

    if not broadcast:
        monkeypatch.setattr(X, "small_side", lambda df: df)
    rng = random.Random(3)
    sets = [frozenset(f"x{j}" for j in range(rng.randrange(1, 24))) | {f"r{rng.randrange(3)}"} for _ in range(14)]
    tables = {f"t{i:02d}": sets[i % 14] for i in range(40)}
    rows = spark.createDataFrame([(k, x) for k, v in tables.items() for x in [*v, min(v)]], "id string, content string")
    got = sorted(map(tuple, X.duplicate_tables(rows, copies=True).collect()))
    every = {(a, b): (len(tables[a] & tables[b]), max(len(tables[a]), len(tables[b]))) for a in tables for b in tables if a < b}
    assert got == sorted((*k, *v) for k, v in every.items() if 10 * v[0] >= 9 * v[1])
