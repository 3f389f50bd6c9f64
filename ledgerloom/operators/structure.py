"""Transforms of printed table structure before loading: splits, continuations, states, geometry, duplicates."""

from __future__ import annotations

from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.periods import mere_period, read_period
from ledgerloom.functions.text import label_key
from ledgerloom.functions.units import unit_of_label
from ledgerloom.runtime import small_side, stage

c = F.col
_HEADS = ("section_header", "sub_header")


def normalise_states(values: str = "values") -> Column:
    """A row's values with their states put right: a dash is nil, 0 is zero, blank is empty; others stay."""

    def one(v: Column) -> Column:
        t = F.trim(F.coalesce(v["value"], F.lit("")))
        state = F.when(t.isin("-", "–", "—"), "nil").when(t == "0", "zero").when((t == "") & F.coalesce(v["cell_state"] == "reported", F.lit(True)), "empty").otherwise(v["cell_state"])
        return F.when(v.isNotNull(), F.struct(v["value"].alias("value"), state.alias("cell_state")))

    return F.transform(values, one)


def _without_values() -> Column:
    return ~F.exists(F.coalesce("values", F.array().cast("array<struct<value:string,cell_state:string>>")), lambda v: F.coalesce(F.trim(v["value"]) != "", F.lit(False)))


def split_blocks(rows: DataFrame, keys: list[str], kind: str = "date") -> DataFrame:
    """Rows with ``block`` (0 before the first heading) and ``caption``, where a table is several printed below each other.

    ``date``: headings that are nothing but a period; ``caption``: valueless rows of the table's lowest level that state
    a unit. A table with fewer than two such headings, or (date) a block without data, stays whole: block 0.
    """
    order = W.partitionBy(*keys).orderBy("row_id")
    valueless = _without_values()
    if kind == "date":
        p = read_period(c("label"), True)
        head = c("row_type").isin(*_HEADS) & valueless & F.coalesce(mere_period(p["rest"]), F.lit(False))
    else:
        head = valueless & unit_of_label(c("label")).isNotNull() & (c("level") == F.min("level").over(W.partitionBy(*keys)))
    marked = rows.withColumn("head", F.coalesce(head, F.lit(False)))
    marked = marked.withColumns({"b": F.sum(c("head").cast("int")).over(order), "cap": F.last(F.when(c("head"), c("label")), True).over(order), "data": ~c("head") & ~valueless})
    blocks = marked.groupBy(*keys, "b").agg(F.max("data").alias("has")).groupBy(*keys).agg(F.max("b").alias("n"), F.min(F.when(c("b") > 0, c("has"))).alias("all"))
    ok = (c("n") >= 2) & (c("all") if kind == "date" else F.lit(True))
    out = marked.join(blocks, keys).withColumns({"block": F.when(ok, c("b")).otherwise(0), "caption": F.when(ok, c("cap"))})
    return out.drop("head", "b", "cap", "data", "n", "all")


CONTINUED = r"(?i)\s*\(?\s*(?:continued|cont'?d\.?)\s*\)?\s*"


def _rebased(parent: Column, low: Column, high: Column, by: Column) -> Column:
    """A named parent, with a heading's number (``hN``) from ``low`` to ``high`` moved by ``by``; other numbers name none."""
    number = F.regexp_extract(F.lower(F.trim(parent)), r"^h(\d+)$", 1)
    n = number.try_cast("int")
    return F.when(number != "", F.when((n >= low) & (n <= high), F.concat(F.lit("h"), (n + by).cast("string")))).otherwise(parent)


def _heads_block(kind: Column, level: Column, order: W) -> Column:
    """Whether ``hN`` counts the row: no section_header, and the next row is of a higher level."""
    return F.coalesce((F.coalesce(kind, F.lit("")) != "section_header") & (F.coalesce(F.lead(level).over(order), F.lit(0)) > F.coalesce(level, F.lit(0))), F.lit(False))


def _with_fields(r: str, fields: list[str], **new: Column) -> Column:
    return F.when(c(r).isNotNull(), F.struct(*[new.get(f, c(f"{r}.{f}")).alias(f) for f in fields]))


def split_captions(tables: DataFrame) -> DataFrame:
    """Tables, each that stacks several captioned ones as one table a caption; numbered anew in the same order.

    Input: doc_id, table_no, title, rows and any others, which the parts keep. The caption becomes the title and leaves
    the rows; rows before the first caption stay a table of the old title; a caption without rows below gives none.
    """
    keys = ["doc_id", "table_no"]
    filled = lambda v: F.exists(v, lambda x: F.coalesce(F.trim(x["value"]) != "", F.lit(False)))
    stated = F.filter("rows", lambda r: unit_of_label(r["label"]).isNotNull() & ~F.coalesce(filled(r["values"]), F.lit(False)))
    may = F.coalesce(F.size(stated) >= 2, F.lit(False))
    rows = tables.where(may).select(*keys, F.posexplode("rows").alias("row_id", "r"))
    rows = rows.select(*keys, "row_id", "r", c("r.row_type").alias("row_type"), F.coalesce(c("r.level"), F.lit(0)).alias("level"), c("r.label").alias("label"), c("r.values").alias("values"))
    order = W.partitionBy(*keys).orderBy("row_id")
    rows = rows.withColumn("heads", _heads_block(c("row_type"), c("level"), order).cast("int")).withColumn("upto", F.sum("heads").over(order))
    part = W.partitionBy(*keys, "block")
    body = split_blocks(rows, keys, "caption").withColumn("nth", F.row_number().over(part.orderBy("row_id"))).where("block = 0 or nth > 1")
    body = body.withColumns({"before": F.min(c("upto") - c("heads")).over(part), "own": F.sum("heads").over(part)})
    row = _with_fields("r", tables.schema["rows"].dataType.elementType.names, parent=_rebased(c("r.parent"), c("before") + 1, c("before") + c("own"), -c("before")))
    parts = body.select(*keys, "block", "caption", F.struct("row_id", row.alias("row")).alias("x")).groupBy(*keys, "block").agg(F.min("caption").alias("caption"), F.array_sort(F.collect_list("x")).alias("x"))
    split = tables.where(may).drop("rows").join(parts, keys).withColumns({"title": F.coalesce("caption", "title"), "rows": F.transform("x", lambda y: y["row"])}).drop("caption", "x")
    both = tables.where(~may).withColumn("block", F.lit(0)).unionByName(split)
    return both.withColumn("table_no", F.row_number().over(W.partitionBy("doc_id").orderBy("table_no", "block"))).drop("block")


def _printed_heads(columns: str) -> Column:
    """Names of the columns, each with how often it has come so far: equal headings pair up from left to right."""
    names = F.transform(columns, lambda x: F.concat_ws("|", label_key(x["group"]), label_key(x["leaf"])))
    return F.transform(names, lambda h, i: F.concat_ws("#", h, F.size(F.filter(F.slice(names, 1, i + 1), lambda x: x == h)).cast("string")))


def continuation_groups(tables: DataFrame) -> DataFrame:
    """Tables (doc_id, table_no, title, columns) with ``first_no``: the table that each one continues, itself if none.

    A table continues the one before it if its title is that one's with a mark of continuation and each of its
    columns is one of that table's. Chains end at the first table: a running count of starts numbers them.
    """
    order = W.partitionBy("doc_id").orderBy("table_no")
    bare = label_key(F.regexp_replace("title", CONTINUED, " "))
    t = tables.withColumns({"bare": bare, "marked": F.coalesce(c("title").rlike(r"(?i)\(?(continued|cont'?d)"), F.lit(False)), "heads": _printed_heads("columns")})
    before_bare, before_heads = F.lag("bare").over(order), F.lag("heads").over(order)
    goes_on = c("marked") & (c("bare") == before_bare) & (F.size(F.array_except("heads", before_heads)) == 0)
    t = t.withColumn("start", ~F.coalesce(goes_on, F.lit(False)))
    return t.withColumn("first_no", F.last(F.when(c("start"), c("table_no")), True).over(order)).drop("bare", "marked", "heads", "start")


def merge_continuations(tables: DataFrame) -> DataFrame:
    """One table a chain: rows of all parts one after the other, values laid under the first part's columns, ``hN`` parents rebased.

    Input: doc_id, table_no, title, columns, rows. The chain's parts are read in order; a printed document bounds a chain.
    """
    return _merged(continuation_groups(tables))


def whole_tables(tables: DataFrame) -> DataFrame:
    """Tables without those that continue others, whose rows stand in the first of their chain; only chains are rebuilt.

    Input: as merge_continuations, and any other columns, which the first part gives.
    """
    keys = ["doc_id", "table_no"]
    groups = continuation_groups(tables.select(*keys, "title", "columns"))
    later = groups.where("first_no <> table_no").select(*keys, "first_no")
    chained = groups.join(later.select("doc_id", "first_no").distinct(), ["doc_id", "first_no"], "left_semi").select(*keys, "first_no")
    merged = _merged(tables.select(*keys, "title", "columns", "rows").join(chained, keys)).select(*keys, c("rows").alias("merged"))
    return tables.join(later.select(*keys), keys, "left_anti").join(merged, keys, "left").withColumn("rows", F.coalesce("merged", "rows")).drop("merged")


def _merged(t: DataFrame) -> DataFrame:
    """merge_continuations of tables that have their first_no. Rows wider than their part's heading stay wider than the first's."""
    fields = t.schema["rows"].dataType.elementType.names
    first = t.where("first_no = table_no").select("doc_id", "first_no", c("title").alias("first_title"), c("columns").alias("first_columns"))
    parts = t.join(first, ["doc_id", "first_no"]).withColumns({"heads_here": _printed_heads("columns"), "heads_first": _printed_heads("first_columns")})
    at = F.transform("heads_first", lambda x: F.array_position("heads_here", x).cast("int"))
    rows = parts.select("doc_id", "first_no", "table_no", "first_title", "first_columns", F.size("columns").alias("width"), at.alias("at"), F.posexplode_outer("rows").alias("i", "r"))
    there = F.size(c("r.values"))
    none = F.get(c("r.values"), there)  # beyond the end: a null of the values' type
    laid = F.when(there <= 0, c("r.values")).when(there > c("width"), F.concat(c("r.values"), F.transform("at", lambda p: none))).otherwise(F.transform("at", lambda p: F.when(p > 0, F.get(c("r.values"), p - 1))))
    order = W.partitionBy("doc_id", "first_no", c("i").isNull()).orderBy("table_no", "i")
    part = W.partitionBy("doc_id", "first_no", "table_no")
    # the last row of a part may come to head the next one's rows: numbers are those of the whole chain
    rows = rows.withColumns({"heads": _heads_block(c("r.row_type"), c("r.level"), order).cast("int"), "own": _heads_block(c("r.row_type"), c("r.level"), part.orderBy("i")).cast("int"), "laid": F.when(c("table_no") == c("first_no"), c("r.values")).otherwise(laid)})
    rows = rows.withColumn("upto", F.sum("heads").over(order)).withColumns({"shift": F.min(c("upto") - c("heads")).over(part), "own": F.sum("own").over(part)})
    row = _with_fields("r", fields, values=c("laid"), parent=_rebased(c("r.parent"), F.lit(1), c("own"), c("shift")))
    rows = rows.withColumn("row", F.when(c("i").isNotNull(), F.struct("table_no", "i", row.alias("row"))))
    merged = rows.groupBy("doc_id", "first_no").agg(F.first("first_title").alias("title"), F.first("first_columns").alias("columns"), F.array_sort(F.collect_list("row")).alias("x"), F.count_distinct("table_no").alias("parts"))
    return merged.select("doc_id", c("first_no").alias("table_no"), "title", "columns", F.transform("x", lambda y: y["row"]).alias("rows"), "parts")


def apply_geometry(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with levels from printed indents and twins (neighbours of one ``line_id``) as one; input adds line_id, indent, label_clean.

    All or nothing: a table with a row that has no line_id keeps its rows and levels. Indents a step of more than 3
    points apart are levels of their own, numbered from the left.
    """
    order = W.partitionBy(*keys).orderBy("row_id")
    whole = W.partitionBy(*keys)
    rows = rows.withColumn("all", F.min(c("line_id").isNotNull().cast("int")).over(whole) == 1)
    rows = rows.withColumn("twin", c("all") & F.coalesce(F.lag("line_id").over(order) == c("line_id"), F.lit(False)))
    runs = rows.withColumn("run", F.sum((~c("twin")).cast("int")).over(order))
    merged = runs.groupBy(*keys, "run").agg(F.min("row_id").alias("row_id"), F.min_by("label", "row_id").alias("label"), F.min_by("label_clean", "row_id").alias("label_clean"), F.min_by("level", "row_id").alias("level"), F.min("indent").alias("indent"), F.max("all").alias("all"), F.count("*").alias("merged"))
    by_indent = W.partitionBy(*keys).orderBy("indent")
    steps = merged.where("indent is not null").select(*keys, "indent").distinct().withColumn("new", F.coalesce((c("indent") - F.lag("indent").over(by_indent) > 3).cast("int"), F.lit(0))).withColumn("rank", F.sum("new").over(by_indent)).drop("new")
    out = merged.join(steps, [*keys, "indent"], "left")
    return out.select(*keys, "row_id", F.when(c("all"), F.coalesce("label_clean", "label")).otherwise(c("label")).alias("label"), F.when(c("all"), F.coalesce(c("rank").cast("int"), c("level"))).otherwise(c("level")).alias("level"), "merged")


def duplicate_tables(rows: DataFrame, share: float = 0.9, copies: bool = False) -> DataFrame:
    """(a, b, shared, larger): tables that share at least ``share`` of the larger one's distinct rows; input (id, content).

    A table is staged once, as the digests of its distinct rows (128 bits, equal just for equal rows but for chance). Tables
    with the same rows are one class, of which only the first is compared with others: the answer pairs it with each of its
    copies, with ``copies`` the copies with each other and with all that the first is paired with, too. An inverted index
    brings tables together; it holds only rows that several tables have, of each table the rarest ones, as many as could all be missing and one more.
    """
    part = F.lit(Decimal(str(share)))  # as a decimal: 0.9 of ten rows is nine
    digest = F.base64(F.unhex(F.md5("content")))
    printed = rows.groupBy("id").agg(F.array_sort(F.collect_set(digest)).alias("rows"))
    printed = stage(printed.select("id", "rows", F.size("rows").alias("n"), F.md5(F.array_join("rows", "")).alias("signature")))
    classes = printed.groupBy("signature").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1").select("signature", "first")
    member = stage(printed.select("id", "n", "signature").join(classes, "signature").select("id", "first", "n"))
    one = printed.join(small_side(member.where("id <> first").select("id")), "id", "left_anti")
    each = one.select("id", "n", F.explode("rows").alias("content"))
    seen = stage(each.groupBy("content").agg(F.count("*").alias("seen")).where("seen > 1"))
    # rows that no other table has come first in the order of rarity, so they count without being there
    by_id = W.partitionBy("id")
    common = each.join(small_side(seen), "content").withColumns({"place": F.row_number().over(by_id.orderBy("seen", "content")), "common": F.count("*").over(by_id)})
    rarest = stage(common.where(c("place") <= c("common") - F.ceil(part * c("n")) + 1).select("id", "n", "content"))
    other = rarest.select(c("id").alias("b"), c("n").alias("nb"), "content")
    asked = rarest.select(c("id").alias("a"), c("n").alias("na"), "content").join(other, "content").where((c("a") < c("b")) & (F.least("na", "nb") >= part * F.greatest("na", "nb")))
    asked = stage(asked.select("a", "b", F.greatest("na", "nb").alias("larger")).distinct())
    left, right = one.select(c("id").alias("a"), c("rows").alias("rows_a")), one.select(c("id").alias("b"), c("rows").alias("rows_b"))
    right = right.join(small_side(asked.select("b").distinct()), "b", "left_semi")
    pairs = left.join(small_side(asked), "a").join(right, "b").select("a", "b", F.size(F.array_intersect("rows_a", "rows_b")).alias("shared"), "larger")
    near = pairs.where(c("shared") >= part * c("larger"))
    x, y = member.select("first", c("id").alias("x")), member.select("first", c("id").alias("y"), "n")
    exact = x.join(y, "first").where("x < y" if copies else "x = first and x < y").select(c("x").alias("a"), c("y").alias("b"), c("n").alias("shared"), c("n").alias("larger"))
    if copies:
        near = near.join(x.withColumnRenamed("first", "a"), "a", "left").join(y.drop("n").withColumnRenamed("first", "b"), "b", "left").withColumns({"a": F.coalesce("x", "a"), "b": F.coalesce("y", "b")})
        near = near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "shared", "larger")
    return near.unionByName(exact).withColumns({k: c(k).cast("long") for k in ("shared", "larger")})


def section_windows(sections: DataFrame) -> DataFrame:
    """Sections (doc_id, section_id, page, y) with the place where the next one starts: half-open windows in reading order."""
    order = W.partitionBy("doc_id").orderBy("page", "y", "section_id")
    nxt = F.lead(F.struct("page", "y")).over(order)
    return sections.withColumns({"to_page": nxt["page"], "to_y": nxt["y"]})


def regions_in_windows(regions: DataFrame, windows: DataFrame) -> DataFrame:
    """Regions (doc_id, page, y0) in the window that holds their upper edge: the last window that starts at or before it.

    A range join as an as-of one: both sides in one ordered window, the last start before each region wins.
    """
    starts = windows.select("doc_id", "page", c("y").alias("at"), F.lit(0).alias("kind"), "section_id", F.lit(None).cast("string").alias("region"))
    asks = regions.select("doc_id", "page", c("y0").alias("at"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("section_id"), c("region_id").cast("string").alias("region"))
    order = W.partitionBy("doc_id").orderBy("page", "at", "kind").rowsBetween(W.unboundedPreceding, 0)
    both = starts.unionByName(asks).withColumn("inside", F.last("section_id", True).over(order))
    return both.where("kind = 1").select("doc_id", "page", "at", c("region").alias("region_id"), c("inside").alias("section_id"))


def windows_of_regions(regions: DataFrame, windows: DataFrame, last_page: int) -> DataFrame:
    """(doc_id, region_id, section_id): every window that a region (doc_id, page, region_id, y0, y1) has some height in.

    ``windows`` as section_windows gives them; one without an end reaches to ``last_page``. Windows are laid out by page, so
    regions meet only those of their own page; a region on the border of two sections belongs to both.
    """
    upto = F.coalesce("to_page", F.lit(last_page))
    pages = windows.select("doc_id", "section_id", "page", "y", "to_page", "to_y", F.explode(F.sequence("page", F.greatest(c("page"), upto))).alias("p"))
    span = pages.select("doc_id", c("p").alias("page"), "section_id", F.when(c("p") == c("page"), c("y")).alias("top"), F.when(c("p") == c("to_page"), c("to_y")).alias("bottom"))
    inside = (c("top").isNull() | (c("y1") > c("top"))) & (c("bottom").isNull() | (c("y0") < c("bottom")))
    return regions.join(span, ["doc_id", "page"]).where(inside).select("doc_id", "region_id", "section_id").distinct()


def outer_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes (doc_id, page, box_id, x0, y0, x1, y1) that lie strictly inside no other of their page."""
    b = boxes.select("doc_id", "page", *[c(x).alias(f"{x}b") for x in ("x0", "y0", "x1", "y1")])
    inner = boxes.join(b, ["doc_id", "page"]).where((c("x0") > c("x0b")) & (c("x1") < c("x1b")) & (c("y0") > c("y0b")) & (c("y1") < c("y1b"))).select("doc_id", "page", "box_id").distinct()
    return boxes.join(inner, ["doc_id", "page", "box_id"], "left_anti")


def nested_regions(boxes: DataFrame, least: float = 0.9) -> DataFrame:
    """Boxes (doc_id, page, box_id, x0, y0, x1, y1) that lie to at least ``least`` of their area in a larger one of the page."""
    area = (c("x1") - c("x0")) * (c("y1") - c("y0"))
    a = boxes.withColumn("area", area)
    b = a.select("doc_id", "page", *[c(x).alias(f"{x}b") for x in ("box_id", "x0", "y0", "x1", "y1", "area")])
    both = a.join(b, ["doc_id", "page"]).where((c("box_id") != c("box_idb")) & ((c("area") < c("areab")) | ((c("area") == c("areab")) & (c("box_id") > c("box_idb")))))
    w = F.least("x1", "x1b") - F.greatest("x0", "x0b")
    h = F.least("y1", "y1b") - F.greatest("y0", "y0b")
    return both.where((w > 0) & (h > 0) & (w * h >= least * c("area"))).select("doc_id", "page", "box_id").distinct()


def running_headers(lines: DataFrame, least_pages: int = 3, share: float = 0.5) -> DataFrame:
    """Lines (doc_id, page, text) that recur on at least ``least_pages`` pages and ``share`` of a document's."""
    pages = lines.groupBy("doc_id").agg(F.count_distinct("page").alias("pages"))
    seen = lines.withColumn("key", F.regexp_replace(label_key(c("text")), r"\d+", "0")).groupBy("doc_id", "key").agg(F.count_distinct("page").alias("on"))
    return seen.join(pages, "doc_id").where((c("on") >= least_pages) & (c("on") >= share * c("pages"))).select("doc_id", "key", "on", "pages")


def cluster_lines(words: DataFrame, within: float = 3.0) -> DataFrame:
    """Words (doc_id, page, text, x0, top) as printed lines: (doc_id, page, line, top, text).

    A word joins the line whose running mean height is within ``within`` of its own: sequential, so one page is one group.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["top", "x0"])
        lines, mean, n = [], None, 0
        for top in pdf["top"]:
            if mean is None or top - mean > within:
                lines.append((lines[-1] if lines else 0) + 1)
                mean, n = top, 1
            else:
                lines.append(lines[-1])
                mean, n = (mean * n + top) / (n + 1), n + 1
        pdf = pdf.assign(line=lines).sort_values(["line", "x0"])
        return pdf.groupby(["doc_id", "page", "line"], as_index=False).agg(top=("top", "min"), text=("text", " ".join))[["doc_id", "page", "line", "top", "text"]]

    return words.groupBy("doc_id", "page").applyInPandas(run, "doc_id string, page int, line int, top double, text string")
