"""Parent links to full hierarchies: cycles by peeling leaves, intervals by Euler tours and list ranking."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import parallelism, stage

#: Scopes of up to so many nodes are ranked inside one task, many scopes at a time; larger ones by joins.
TASK_NODES = 100_000
#: Nodes a task gets at a time, about.
BATCH_NODES = 40_000

SCHEMA = "scope string, node string, parent string, root string, depth int, entry long, exit long, descendants long, in_cycle boolean, path string"


def peel(parent: np.ndarray) -> np.ndarray:
    """Mask of the nodes left when leaves are taken off again and again: just those on a cycle."""
    n = len(parent)
    children = np.bincount(parent[parent >= 0], minlength=n)
    left = np.ones(n, bool)
    front = np.flatnonzero(children == 0)
    while len(front):
        left[front] = False
        up = parent[front]
        up = up[up >= 0]
        np.subtract.at(children, up, 1)
        up = np.unique(up)
        front = up[(children[up] == 0) & left[up]]
    return left


def rank_list(follow: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parallel list ranking: for each element the number and the summed weight of the elements from it to its list's end.

    ``follow`` is the next element, or the element itself at the end of a list. Every round doubles the reach.
    """
    nxt = follow.copy()
    end = nxt == np.arange(len(nxt))
    count, total = np.where(end, 0, 1), np.where(end, 0, weight)
    while True:
        after = nxt[nxt]
        if np.array_equal(after, nxt):
            break
        count, total = count + count[nxt], total + total[nxt]
        nxt = after
    last = weight[nxt]
    return count + 1, total + last


def tours(parent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Depth, entry, exit and root of each node of a forest (parent -1 at roots), from one Euler tour over all trees."""
    n = len(parent)
    down, up = np.arange(n), np.arange(n) + n
    order = np.lexsort((np.arange(n), parent))  # siblings together, roots first
    same = parent[order][1:] == parent[order][:-1]
    after = np.full(n, -1)
    after[order[:-1][same]] = order[1:][same]
    first = np.full(n, -1)
    heads = order[np.concatenate(([True], ~same))] if n else order
    heads = heads[parent[heads] >= 0]
    first[parent[heads]] = heads
    follow = np.empty(2 * n, np.int64)
    follow[down] = np.where(first >= 0, first, up)
    follow[up] = np.where(after >= 0, after, np.where(parent >= 0, parent + n, up))  # a root's sibling is the next root
    weight = np.concatenate((np.ones(n, np.int64), -np.ones(n, np.int64)))
    count, total = rank_list(follow, weight)
    entry, exit_ = 2 * n - count[down], 2 * n - count[up]
    depth = -total[down]  # the weights from a node's entry to the end sum to minus its depth, roots 0
    by_entry = np.argsort(entry, kind="stable")
    roots = by_entry[parent[by_entry] < 0]
    root = roots[np.searchsorted(entry[roots], entry, "right") - 1] if n else entry
    return depth, entry, exit_, root


def _open_cycles(parent: np.ndarray, on_cycle: np.ndarray) -> np.ndarray:
    """The links with each cycle cut above its smallest node."""
    at = np.flatnonzero(on_cycle)
    if not len(at):
        return parent
    low, jump = np.arange(len(parent)), np.where(on_cycle, parent, np.arange(len(parent)))
    for _ in range(int(np.ceil(np.log2(len(at) + 1))) + 1):
        low, jump = np.minimum(low, low[jump]), jump[jump]
    opened = parent.copy()
    opened[at[low[at] == at]] = -1
    return opened


def rank_scopes(pdf: pd.DataFrame, paths: bool = True) -> pd.DataFrame:
    """All scopes of a batch at once: rows (scope, node, parent) to rows of SCHEMA; path is null unless asked for."""
    pdf = pdf.sort_values(["scope", "node"], kind="stable").reset_index(drop=True)
    n = len(pdf)
    place = pd.Series(np.arange(n), index=pd.MultiIndex.from_frame(pdf[["scope", "node"]]))
    stated = pdf["parent"].notna().to_numpy()
    found = place.reindex(pd.MultiIndex.from_arrays([pdf["scope"], pdf["parent"].where(pdf["parent"].notna(), None)])).to_numpy()
    parent = np.where(stated & ~pd.isna(found), np.nan_to_num(found, nan=-1.0), -1).astype(np.int64)
    on_cycle = peel(parent)
    links = _open_cycles(parent, on_cycle)
    depth, entry, exit_, root = tours(links)
    # entries count within the scope: the first entry of the scope is 0
    codes = pdf["scope"].factorize()[0]
    start = np.full(codes.max() + 1 if n else 0, np.iinfo(np.int64).max)
    np.minimum.at(start, codes, entry)
    names = pdf["node"].to_numpy(object)
    path = np.full(n, None, object)
    at = np.argsort(depth, kind="stable")
    for level in np.split(at, np.flatnonzero(np.diff(depth[at])) + 1) if n and paths else []:
        above = links[level]
        path[level] = [names[v] if u < 0 else f"{path[u]} > {names[v]}" for v, u in zip(level, above)]
    endless = on_cycle[root]
    return pd.DataFrame({
        "scope": pdf["scope"], "node": pdf["node"], "parent": pdf["parent"], "root": np.where(endless, "", names[root] if n else names),
        "depth": depth.astype("int32"), "entry": entry - start[codes], "exit": exit_ - start[codes],
        "descendants": (exit_ - entry - 1) // 2, "in_cycle": on_cycle, "path": path,
    })


def _by_joins(nodes: DataFrame, paths: bool = True) -> DataFrame:
    """The same for scopes too large for one task: pointer doubling by joins, twice log2(nodes) rounds.

    Doubling replaces the peeling here, which would need as many joins as the deepest tree has levels: a node
    whose pointer still moves after log2(nodes) + 1 rounds never reaches a root, so it is on or below a cycle.
    """
    c, spark = F.col, nodes.sparkSession
    there = nodes.select("scope", c("node").alias("parent"), F.lit(True).alias("known"))
    links = stage(nodes.join(there, ["scope", "parent"], "left").select("scope", "node", "parent", F.when(c("known"), c("parent")).alias("up")))
    rounds = int(np.ceil(np.log2(max(2, links.groupBy("scope").count().agg(F.max("count")).first()[0])))) + 1

    def double(at: DataFrame, more: list[str], merge) -> DataFrame:
        """One round: at (scope, node, ptr, *more) with the pointer's own state merged in."""
        ahead = at.select("scope", c("node").alias("ptr"), c("ptr").alias("next"), *[c(x).alias(f"{x}2") for x in more])
        both = at.join(ahead, ["scope", "ptr"], "left")
        return stage(both.select("scope", "node", c("next").alias("ptr"), *[merge(x).alias(x) for x in more]))

    # what a cycle holds, and its smallest node: the minimum over all nodes reached
    state = links.select("scope", "node", c("up").alias("ptr"), F.least(c("node"), F.coalesce("up", "node")).alias("low"), F.coalesce("up", "node").alias("far"))
    merge = {"low": F.least(c("low"), F.coalesce("low2", "low")), "far": F.coalesce("far2", "far")}
    state = stage(state)
    for _ in range(rounds):
        state = double(state, ["low", "far"], merge.get)
    endless = stage(state.where("ptr is not null").select("scope", "node", "low", c("ptr").alias("far")))
    # far is on the cycle; a node is on it itself if some node that never ends points at it that far ahead
    on_cycle = stage(endless.select("scope", c("far").alias("node")).distinct())
    # pointing 2^rounds ahead maps the cycle onto itself, so every node of it is some node's far end
    cuts = on_cycle.join(endless, ["scope", "node"]).where("low = node").select("scope", "node", F.lit(True).alias("cut"))
    links = links.join(on_cycle.withColumn("in_cycle", F.lit(True)), ["scope", "node"], "left").join(cuts, ["scope", "node"], "left")
    links = stage(links.select("scope", "node", "parent", F.when(c("cut").isNull(), c("up")).alias("up"), F.coalesce("in_cycle", F.lit(False)).alias("in_cycle")))
    # root, depth and path by doubling
    state = links.select("scope", "node", c("up").alias("ptr"), F.when(c("up").isNull(), c("node")).otherwise(c("up")).alias("root"), F.when(c("up").isNull(), 0).otherwise(1).alias("depth"), (c("node") if paths else F.lit(None).cast("string")).alias("path"))
    merge = {"root": F.coalesce("root2", "root"), "depth": c("depth") + F.coalesce("depth2", F.lit(0)), "path": F.when(c("path2").isNull(), c("path")).otherwise(F.concat_ws(" > ", "path2", "path"))}
    state = stage(state)
    for _ in range(rounds):
        state = double(state, ["root", "depth", "path"], merge.get)
    # sizes of subtrees, and entries: a node's entry is its parent's plus one plus twice the nodes of its earlier siblings' subtrees
    tree = stage(state.select("scope", "node", "root", "depth", "path").join(links, ["scope", "node"]))
    arcs = _tour_ranks(tree, rounds + 1, double)
    bad = links.where("in_cycle").select("scope", c("node").alias("root"), F.lit(True).alias("loops")).distinct()
    out = tree.join(arcs, ["scope", "node"]).join(bad, ["scope", "root"], "left")
    return spark.createDataFrame([], SCHEMA).unionByName(out.select(
        "scope", "node", "parent", F.when(c("loops"), "").otherwise(c("root")).alias("root"), c("depth").cast("int"), "entry", "exit",
        ((c("exit") - c("entry") - 1) / 2).cast("long").alias("descendants"), "in_cycle", "path",
    ))


def _tour_ranks(tree: DataFrame, rounds: int, double) -> DataFrame:
    """Entry and exit of each node by ranking the Euler tour's list of arcs (node + '>' down, '<' up) with doubling joins."""
    from pyspark.sql import Window as W

    c = F.col
    arc = lambda x, way: F.concat(x, F.lit(way))
    # siblings in order: ranges of the whole order are parts, so that one node's children may fill many; within a part a window
    # tells the next one, and between parts the first child of the next part that has any
    family = ["scope", "up"]
    parts = tree.select(*family, "node").repartitionByRange(parallelism(tree.sparkSession), *family, "node").withColumn("part", F.spark_partition_id())
    parts = stage(parts)
    ends = parts.groupBy(*family, "part").agg(F.min("node").alias("head"), F.max("node").alias("node"))
    ends = ends.withColumns({"after": F.lead("head").over(W.partitionBy(*family).orderBy("part")), "nth": F.row_number().over(W.partitionBy(*family).orderBy("part"))})
    beside = parts.select(*family, "node", F.lead("node").over(W.partitionBy(*family, "part").orderBy("node")).alias("next_here"))
    kids = beside.join(ends.select("scope", "node", "after"), ["scope", "node"], "left").select(*family, "node", F.coalesce("next_here", "after").alias("next_kin"))
    kids = stage(kids)
    first = ends.where("nth = 1 and up is not null").select("scope", c("up").alias("node"), c("head").alias("first"))
    both = kids.join(first, ["scope", "node"], "left")
    down = both.select("scope", arc(c("node"), ">").alias("node"), F.when(c("first").isNotNull(), arc(c("first"), ">")).otherwise(arc(c("node"), "<")).alias("ptr"))
    up = both.select("scope", arc(c("node"), "<").alias("node"), F.when(c("next_kin").isNotNull(), arc(c("next_kin"), ">")).when(c("up").isNotNull(), arc(c("up"), "<")).alias("ptr"))
    state = stage(down.unionByName(up).withColumn("far", F.when(c("ptr").isNull(), 0).otherwise(1).cast("long")))
    for _ in range(rounds):
        state = double(state, ["far"], lambda _: c("far") + F.coalesce("far2", F.lit(0)))
    total = tree.groupBy("scope").agg((2 * F.count("*")).alias("arcs"))
    placed = state.join(total, "scope").select("scope", F.expr("left(node, length(node) - 1)").alias("node"), F.right("node", F.lit(1)).alias("way"), (c("arcs") - 1 - c("far")).alias("place"))
    return placed.groupBy("scope", "node").agg(F.max(F.when(c("way") == ">", c("place"))).alias("entry"), F.max(F.when(c("way") == "<", c("place"))).alias("exit"))


def hierarchy(links: DataFrame, task_nodes: int = TASK_NODES, paths: bool = True) -> DataFrame:
    """Every node once, with root, depth, path (null without ``paths``) and tour interval; input (scope, node, parent), all strings.

    v is below u just if they share the scope and entry(u) < entry(v) < exit(u); ``descendants`` counts them. A null
    parent, or one that is not a node of the scope, ends the chain: that node is a root. Nodes on a cycle have
    in_cycle true; their root, and that of all nodes below them, is '' (each cycle is cut above its smallest
    node for depth, path and interval). A node stated twice counts once, with its smallest parent; rows without
    a node are left out; a null scope is the scope ''; an empty table gives an empty result; other columns are ignored.
    """
    c = F.col
    rows = links.select(F.coalesce("scope", F.lit("")).alias("scope"), "node", "parent").where("node is not null")
    nodes = stage(rows.groupBy("scope", "node").agg(F.min("parent").alias("parent")))
    sizes = nodes.groupBy("scope").count()
    n, most = sizes.agg(F.sum("count"), F.max("count")).first()
    small = nodes
    if (most or 0) > task_nodes:
        large = sizes.where(c("count") > task_nodes).select("scope")
        small, big = nodes.join(large, "scope", "left_anti"), nodes.join(large, "scope", "left_semi")
    buckets = max(1, min(parallelism(nodes.sparkSession), (n or 0) // 2000 + 1), -(-(n or 0) // BATCH_NODES))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return rank_scopes(pdf[["scope", "node", "parent"]], paths)

    out = small.withColumn("bucket", F.pmod(F.xxhash64("scope"), F.lit(buckets))).groupBy("bucket").applyInPandas(run, SCHEMA)
    return out.unionByName(_by_joins(big, paths)) if (most or 0) > task_nodes else out


def table_links(units: DataFrame) -> DataFrame:
    """Links (scope, node, parent) of the rows of extracted tables; input (unit_id, tables), each unit once.

    A node is a row's position. The parent named by a row is the N-th heading row (``hN``: the N-th row that is no
    section_header and is directly followed by a row of higher level), else the row of that row_id, else the
    nearest earlier row of that label; case and outer blanks do not matter. A name that fits nothing stays a
    parent that is not there (``?`` and the name). Null rows keep their position and name nothing.
    """
    from pyspark.sql import Window as W

    c = F.col
    key = lambda x: F.lower(F.trim(x))
    tables = units.select("unit_id", F.posexplode("tables").alias("table_no", "t"))
    rows = tables.select(F.concat_ws(":", "unit_id", "table_no").alias("scope"), F.posexplode("t.rows").alias("at", "r"))
    rows = rows.select(
        "scope", "at", c("r.level").alias("level"), c("r.row_type").alias("row_type"), key(c("r.parent")).alias("named"),
        key(c("r.row_id")).alias("row_id"), key(c("r.label")).alias("label"),
    )
    rows = rows.withColumn("named", F.when(c("named") != "", c("named")))
    order = W.partitionBy("scope").orderBy("at")
    heads = (F.coalesce("row_type", F.lit("")) != "section_header") & (F.lead("level").over(order) > c("level"))
    rows = stage(rows.withColumn("heads", F.coalesce(heads, F.lit(False))).withColumn("nth", F.when(c("heads"), F.sum(c("heads").cast("int")).over(order))))
    asks = rows.where("named is not null").select("scope", "at", "named")
    # each way to name a row is one equi join or one last-value window keyed by the name
    nth = rows.where("nth is not null").select("scope", F.concat(F.lit("h"), c("nth").cast("string")).alias("named"), c("at").alias("by_nth"))
    ids = rows.where("row_id is not null and row_id <> ''").groupBy("scope", c("row_id").alias("named")).agg(F.min("at").alias("by_id"))
    labels = rows.where("label is not null and label <> ''").select("scope", c("label").alias("named"), "at", F.lit(1).alias("is_label"))
    seen = asks.select("scope", "named", "at", F.lit(0).alias("is_label")).unionByName(labels)
    # an asking row never answers itself: equal positions sort the asking row first
    before = W.partitionBy("scope", "named").orderBy("at", "is_label").rowsBetween(W.unboundedPreceding, -1)
    last = seen.withColumn("by_label", F.last(F.when(c("is_label") == 1, c("at")), True).over(before)).where("is_label = 0").drop("is_label")
    spelt = F.regexp_replace("named", "^h0*([1-9][0-9]*)$", "h$1")
    found = last.withColumn("spelt", spelt).join(nth.withColumnRenamed("named", "spelt"), ["scope", "spelt"], "left").join(ids, ["scope", "named"], "left")
    answer = F.coalesce(c("by_nth"), c("by_id"), c("by_label"))
    found = found.select("scope", "at", F.coalesce(answer.cast("string"), F.concat(F.lit("?"), "named")).alias("parent"))
    return rows.select("scope", "at").join(found, ["scope", "at"], "left").select("scope", c("at").cast("string").alias("node"), "parent")


def leaked_tables(tables: DataFrame, sections: DataFrame) -> DataFrame:
    """Tables that say they belong to another section than the unit they came with: (doc_id, table_no, unit_section, echo, owner).

    ``tables``: doc_id, table_no, unit_section, echo (a section's id or number); ``sections``: doc_id, section_id, section_no,
    parent_section. An echo that names the unit's own section or one above it is right, one that names no section is left to
    the unit; the others would be loaded twice. Sections above come from the intervals of one tour, not from walking up.
    """
    c = F.col
    tour = stage(hierarchy(sections.select(c("doc_id").alias("scope"), c("section_id").alias("node"), c("parent_section").alias("parent"))).select(c("scope").alias("doc_id"), c("node").alias("section_id"), "entry", "exit"))
    names = sections.select("doc_id", "section_id", F.explode(F.array_distinct(F.array_compact(F.array("section_id", "section_no")))).alias("echo")).groupBy("doc_id", "echo").agg(F.min("section_id").alias("owner"))
    asked = tables.withColumn("echo", F.trim("echo")).where("echo <> '' and unit_section is not null").join(names, ["doc_id", "echo"])
    own = tour.select("doc_id", c("section_id").alias("unit_section"), c("entry").alias("at"))
    of = tour.select("doc_id", c("section_id").alias("owner"), "entry", "exit")
    placed = asked.join(own, ["doc_id", "unit_section"]).join(of, ["doc_id", "owner"])
    return placed.where(~((c("entry") <= c("at")) & (c("at") < c("exit")))).select("doc_id", "table_no", "unit_section", "echo", "owner")
