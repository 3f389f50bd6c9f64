"""Verified totals: which rows a printed total adds up, with the sign of each; and total columns."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most non-zero members of a block whose signs are tried.
MOST_MEMBERS = 14
SCHEMA = "doc_id string, table_id string, row_id int, sums_to int, sums_sign int, outcome string"


def _signs(values: np.ndarray, goal: np.ndarray, within: float) -> list[np.ndarray]:
    """All sign vectors (+1, -1) with which the rows of ``values`` add up to ``goal`` in every column; two halves met in the middle."""
    half = len(values) // 2
    left = np.array(list(itertools.product((1, -1), repeat=half))).reshape(2**half, half)
    right = np.array(list(itertools.product((1, -1), repeat=len(values) - half))).reshape(-1, len(values) - half)
    a, b = left @ values[:half], right @ values[half:]
    order = np.argsort(b[:, 0])
    low = np.searchsorted(b[order, 0], goal[0] - within - a[:, 0])
    high = np.searchsorted(b[order, 0], goal[0] + within - a[:, 0], "right")
    out = []
    for i, (p, q) in enumerate(zip(low, high)):
        for j in order[p:q]:
            if np.all(np.abs(a[i] + b[j] - goal) <= within):
                out.append(np.concatenate((left[i], right[j])))
    return out


def totals_of(rows: pd.DataFrame, values: np.ndarray, additive: np.ndarray) -> list[tuple[int, int | None, int | None, str]]:
    """(row_id, total's row_id, sign, outcome) for one table; rows in order with row_id, row_type, level.

    A total's block reaches up to the last header or total; notes are passed over; a total at its top is carried in.
    Members are the block's shallowest rows. All added must give the total in every additive column it fills, to
    within one unit a member; else signs are tried, the carried-in total among the members, and hold if there is
    just one way. Members without a value count as 0 and keep their plus.
    """
    out: list[tuple[int, int | None, int | None, str]] = []
    ids, kinds, levels = rows["row_id"].tolist(), rows["row_type"].tolist(), rows["level"].fillna(0).astype(int).tolist()
    block: list[int] = []
    carry: int | None = None
    for i, kind in enumerate(kinds):
        if kind in ("section_header", "sub_header"):
            block, carry = [], None
        elif kind == "total":
            top = min((levels[k] for k in block), default=0)
            data = [k for k in block if levels[k] == top]
            use = additive & ~np.isnan(values[i])
            members = data + ([carry] if carry is not None else [])
            if members and not use.any():
                out.append((ids[i], None, None, "only ratios"))
            elif members:
                goal, filled = values[i, use], np.nan_to_num(values[:, use])
                if data and np.all(np.abs(filled[data].sum(0) - goal) <= len(data)):
                    out += [(ids[k], ids[i], 1, "added") for k in data]
                else:
                    live = [k for k in members if np.any(filled[k] != 0)]
                    found = _signs(filled[live], goal, float(len(members))) if 0 < len(live) <= MOST_MEMBERS else []
                    if len(found) == 1:
                        sign = dict(zip(live, found[0].tolist()))
                        out += [(ids[k], ids[i], int(sign.get(k, 1)), "signed") for k in members]
                    else:
                        out.append((ids[i], None, None, "too large" if len(live) > MOST_MEMBERS else f"{len(found)} ways"))
            block, carry = [], i
        elif kind != "note":
            block.append(i)
    return out


def verified_totals(rows: DataFrame, cells: DataFrame, columns: DataFrame) -> DataFrame:
    """Members of totals and totals that could not be verified (sums_to null), for all tables.

    ``rows``: doc_id, table_id, row_id, row_type, level; ``cells``: doc_id, table_id, row_id, col_id, value_num;
    ``columns``: doc_id, table_id, col_id, unit (per cent columns do not add up). One printed table is one group;
    its values are packed into arrays first, so a group is as large as the table and no larger.
    """
    additive = columns.where("unit is null or unit not in ('percent', '%')").groupBy("doc_id", "table_id").agg(F.array_sort(F.collect_set("col_id")).alias("cols"))
    packed = cells.where("value_num is not null").groupBy("doc_id", "table_id", "row_id").agg(F.map_from_entries(F.collect_list(F.struct("col_id", "value_num"))).alias("v"))
    base = rows.select("doc_id", "table_id", "row_id", "row_type", "level").join(packed, ["doc_id", "table_id", "row_id"], "left").join(additive, ["doc_id", "table_id"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        cols = list(pdf["cols"].iloc[0])
        get = lambda m: [np.nan if m is None else dict(m).get(x, np.nan) for x in cols]
        values = np.array([get(m) for m in pdf["v"]], float).reshape(len(pdf), len(cols))
        found = totals_of(pdf, values, np.ones(len(cols), bool))
        out = pd.DataFrame(found, columns=["row_id", "sums_to", "sums_sign", "outcome"]).astype({"sums_to": "Int32", "sums_sign": "Int32"})
        out.insert(0, "table_id", pdf["table_id"].iloc[0])
        out.insert(0, "doc_id", pdf["doc_id"].iloc[0])
        return out

    return base.groupBy("doc_id", "table_id").applyInPandas(run, SCHEMA)


def total_columns(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """(doc_id, table_id, total_col, rows, agreeing, reconciled): whether the other columns add up to the one headed "Total" in every row they can be checked in."""
    c = F.col
    heads = columns.where(F.trim(F.lower("leaf")) == "total").groupBy("doc_id", "table_id").agg(F.min("col_id").alias("total_col"))
    base = cells.where("value_num is not null").join(heads, ["doc_id", "table_id"])
    is_total = c("col_id") == c("total_col")
    sums = base.groupBy("doc_id", "table_id", "total_col", "row_id").agg(F.max(F.when(is_total, c("value_num"))).alias("total"), F.sum(F.when(~is_total, c("value_num"))).alias("parts"), F.count(F.when(~is_total, 1)).alias("n"))
    ok = F.abs(c("parts") - c("total")) <= F.greatest(F.lit(1), c("n"))
    return sums.where("total is not null and n > 0").groupBy("doc_id", "table_id", "total_col").agg(F.count("*").alias("rows"), F.count(F.when(ok, 1)).alias("agreeing"), F.bool_and(ok).alias("reconciled"))
