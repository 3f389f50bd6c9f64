"""Serving: anchored items, the fiscal axis, grids, coverage, query specs, parity and ground-truth checks."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.periods import is_flow, period_label, span_rank
from ledgerloom.functions.values import page_token
from ledgerloom.operators.generic import latest_by
from ledgerloom.runtime import small_side

c = F.col
ADDRESS = ["bank", "table_type_id", "canonical_leaf_id"]


def resolve_filter(declared: str = "filter_by", kind: str = "table_type_id"):
    """How an anchor is placed: as declared, else (blank or misspelt) by date for balance sheets and by label for the rest."""
    word = F.trim(F.coalesce(declared, F.lit("")))
    by_kind = F.when(F.upper(F.trim(F.coalesce(kind, F.lit("")))).startswith("FS_BALANCE"), "period_end_date").otherwise("period_label")
    return F.when(word.isin("period_label", "period_end_date"), word).otherwise(by_kind)


def servable(facts: DataFrame) -> DataFrame:
    """Facts fit to be shown: identified, of a plain column, with period and value, of the consolidated entity."""
    return facts.where("canonical_leaf_id is not null and table_type_id is not null and col_role is null and period is not null and value_num is not null and coalesce(legal_entity, 'CONSOLIDATED') = 'CONSOLIDATED'")


#: The member of each axis that means the whole book. Fixed values.
WHOLE = {"segment_key": "SEG_TOTAL", "geo_key": "GLOBAL", "industry_key": "IND_TOTAL"}


def whole_book_named(facts: DataFrame) -> DataFrame:
    """Facts whose null and blank axes name the whole book, as they mean it."""
    return facts.withColumns({k: F.coalesce(F.nullif(F.trim(k), F.lit("")), F.lit(v)) for k, v in WHOLE.items()})


def latest_facts(facts: DataFrame) -> DataFrame:
    """One fact for each address, period and slice: of the filing with the latest period, then by place. A null axis is the whole book's slice."""
    keys = ["institution", "table_type_id", "canonical_leaf_id", "period", "period_span", "canonical_col_id", *WHOLE]
    return latest_by(whole_book_named(facts), keys, ["doc_period"], ["doc_id", "table_id", "row_id", "col_id"])


def fiscal_axis(facts: DataFrame) -> DataFrame:
    """(label, end, span, place): the columns of a grid, from flows only, or from stocks where there is no flow, in order of time."""
    rows = facts.where("period is not null").select("period", "period_span").distinct()
    flow = is_flow(c("period_span"))
    rows = rows.withColumns({"flow": flow, "any": F.max(flow).over(W.partitionBy(F.lit(1)))})  # a few hundred periods
    rows = rows.where(c("flow") | ~c("any")).withColumns({"label": period_label(c("period"), c("period_span")), "rank": span_rank(c("period_span"))})
    best = rows.groupBy("label").agg(F.min(F.struct(c("period").alias("end"), "rank", c("period_span").alias("span"))).alias("k"))
    order = W.partitionBy(F.lit(1)).orderBy("k.end", "k.rank", "label")
    return best.select("label", "k.end", "k.span", F.row_number().over(order).alias("place"))


def sliced(facts: DataFrame) -> DataFrame:
    """Facts joined with members, only those of the one slice a member means.

    A member without ``row_dim_key`` means the whole book on every axis; one with it means that member on the axis that has
    it and the whole book on the others. Without ``canonical_col_id`` it means columns of the period axis, which have none.
    """
    named = [F.coalesce(c(k) == c("row_dim_key"), F.lit(False)) for k in WHOLE]
    total = [c(k) == v for k, v in WHOLE.items()]
    whole = F.when(c("row_dim_key").isNull(), total[0] & total[1] & total[2])
    for n, t, u in ((0, 1, 2), (1, 0, 2), (2, 0, 1)):
        whole = whole.when(named[n], total[t] & total[u])
    return facts.where(whole & c("canonical_col_id").eqNullSafe(c("member_col_id")))


def compose_items(facts: DataFrame, anchors: DataFrame, axis: DataFrame) -> DataFrame:
    """(bank, concept, label, value, members, declared, complete, unit, parts): anchored items on the axis, composed a bank at a time.

    ``anchors``: concept, bank, table_type_id, canonical_leaf_id, sign, member_ordinal, filter_by, and, if members are cut
    by column or by axis, canonical_col_id and row_dim_key. Each member has one fact on a column of the axis, of the slice
    it means (``sliced``): the whole book stated with and without its axes, or a balance stated under several spans, counts
    once; slices never add up to it. A missing member is not read as 0 unseen: complete says so. Banks are keys, so that one
    bank's members never add to another's.
    """
    anchors = anchors.withColumn("mode", resolve_filter())
    for name in ("canonical_col_id", "row_dim_key"):
        anchors = anchors.withColumn(name, F.nullif(F.trim(name), F.lit("")) if name in anchors.columns else F.lit(None).cast("string"))
    declared = anchors.groupBy("bank", "concept").agg(F.count_distinct("member_ordinal").alias("declared"))
    members = anchors.withColumnRenamed("canonical_col_id", "member_col_id").drop("filter_by")
    rows = sliced(whole_book_named(facts).join(small_side(members), ADDRESS))
    axis = small_side(axis)
    flows = rows.where("mode = 'period_label'").withColumn("label", period_label(c("period"), c("period_span"))).join(axis.select("label"), "label")
    stocks = rows.where("mode = 'period_end_date'").join(axis.select("label", c("end").alias("closes")), c("period") == c("closes")).drop("closes").select(*flows.columns)
    placed = flows.unionByName(stocks).withColumn("rank", span_rank(c("period_span")))
    one = latest_by(placed, ["bank", "concept", "member_ordinal", "label"], ["doc_period"], ["rank", "period_span", "doc_id", "table_id", "row_id", "col_id"])
    value = c("sign") * c("value_num").cast("decimal(28,4)")
    out = one.groupBy("bank", "concept", "label").agg(
        F.sum(value).cast("double").alias("value"), F.count("*").alias("members"), F.min_by("unit", "member_ordinal").alias("unit"),
        F.array_join(F.array_sort(F.collect_set(F.concat(F.when(c("sign") < 0, "-").otherwise("+"), "canonical_leaf_id"))), " ").alias("parts"),
    )
    return out.join(declared, ["bank", "concept"]).withColumn("complete", c("members") == c("declared"))


def grid(items: DataFrame, labels: list[str], sections: DataFrame | None = None) -> DataFrame:
    """One row an item, one column a period label (values as text), in the items' order; each section's name in a row of its own above them.

    ``items``: bank, concept, label, value; ``sections``: concept, row_order, section.
    """
    text = F.regexp_replace(F.regexp_replace(F.format_number("value", 2), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    wide = items.withColumn("text", text).groupBy("bank", "concept").pivot("label", labels).agg(F.first("text"))
    if sections is None:
        return wide
    order = sections.groupBy("concept").agg(F.min(F.struct("row_order", "section")).alias("s")).select("concept", "s.*")
    body = wide.join(small_side(order), "concept", "left").withColumn("head", F.lit(1))
    heads = body.groupBy("bank", "section").agg(F.min("row_order").alias("row_order")).where("section is not null").select("bank", c("section").alias("concept"), "section", "row_order", F.lit(0).alias("head"))
    return body.unionByName(heads, allowMissingColumns=True).orderBy("bank", F.coalesce("row_order", F.lit(999_999)), "head", "concept")


def compare_grid(items: DataFrame, banks: list[str]) -> DataFrame:
    """One row an item and period, one column a bank."""
    return items.groupBy("concept", "label").pivot("bank", banks).agg(F.first("value"))


def printed_table(cells: DataFrame, columns: list[int]) -> DataFrame:
    """A table as printed: rows in order with indented labels, one column a leaf, the raw tokens; columns without a cell left out by the caller."""
    label = F.concat(F.repeat(F.lit("  "), F.greatest(c("row_hierarchy"), F.lit(0))), "row_leaf_label")
    return cells.withColumn("label", label).groupBy("doc_id", "table_id", "row_id", "label").pivot("col_id", columns).agg(F.min("value_raw"))


def anchor_coverage(anchors: DataFrame, facts: DataFrame) -> DataFrame:
    """Declared addresses with hits, filings and latest period; none is 0."""
    declared = anchors.select(*ADDRESS).distinct()
    seen = facts.groupBy(*ADDRESS).agg(F.count("*").alias("hits"), F.count_distinct("doc_id").alias("docs"), F.max("period").alias("latest"))
    return declared.join(seen, ADDRESS, "left").select(*ADDRESS, F.coalesce("hits", F.lit(0)).alias("hits"), F.coalesce("docs", F.lit(0)).alias("docs"), "latest")


def page_parity(cells: DataFrame, lines: DataFrame, words: DataFrame) -> DataFrame:
    """Cells whose number is not printed: neither on the line of their label (``line``) nor on their page (``page``); each printed token serves once.

    ``cells``: doc_id, page, cell_id, label, value_num; ``lines``: doc_id, page, line, text; ``words``: doc_id, page, line, text.
    """
    key = lambda x: F.slice(F.filter(F.split(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "), " "), lambda w: w != ""), 1, 6)
    number = lambda x: F.round(F.abs(x), 6)
    printed = words.withColumn("n", number(page_token(c("text")))).where("n is not null").select("doc_id", "page", "line", "n")
    asks = cells.where("value_num is not null").withColumns({"n": number(c("value_num")), "k": key(c("label"))})
    near = asks.join(lines.select("doc_id", "page", "line", key(c("text")).alias("lk")), ["doc_id", "page"])
    near = near.where(F.size(F.array_intersect("k", "lk")) >= 0.6 * F.size("k")).select("doc_id", "page", "cell_id", "line", "n")
    on_lines = printed.groupBy("doc_id", "page", "line", "n").agg(F.count("*").alias("there"))
    # a cell asks on the first of its lines that has its number; a line gives each of its tokens once
    first = near.join(on_lines, ["doc_id", "page", "line", "n"]).groupBy("doc_id", "page", "cell_id", "n").agg(F.min(F.struct("line", "there")).alias("l")).select("doc_id", "page", "cell_id", "n", "l.*")
    on_line = first.withColumn("nth", F.row_number().over(W.partitionBy("doc_id", "page", "line", "n").orderBy("cell_id"))).where("nth <= there")
    used = on_line.groupBy("doc_id", "page", "n").agg(F.count("*").alias("used"))
    rest = asks.join(on_line.select("doc_id", "page", "cell_id"), ["doc_id", "page", "cell_id"], "left_anti")
    stock = on_lines.groupBy("doc_id", "page", "n").agg(F.sum("there").alias("there")).join(used, ["doc_id", "page", "n"], "left").withColumn("left", c("there") - F.coalesce("used", F.lit(0)))
    order = W.partitionBy("doc_id", "page", "n").orderBy("cell_id")
    on_page = rest.withColumn("nth", F.row_number().over(order)).join(stock, ["doc_id", "page", "n"]).where("nth <= left").select("doc_id", "page", "cell_id", F.lit("page").alias("tier"))
    found = on_line.select("doc_id", "page", "cell_id", F.lit("line").alias("tier")).unionByName(on_page)
    return asks.join(found, ["doc_id", "page", "cell_id"], "left").select("doc_id", "page", "cell_id", F.coalesce("tier", F.lit("missing")).alias("tier"))


#: How far a served figure may be from a transcribed one, by unit. Fixed values.
WITHIN = {"%": 0.05, "percent": 0.05, "S$m": 1.0, "million": 1.0}


def against_truth(truth: DataFrame, served: DataFrame) -> DataFrame:
    """Transcribed figures beside served ones: match, mismatch or missing; the exact span, else one without span or as_at.

    ``truth`` and ``served``: bank, concept_key, period, period_span, value, and served unit.
    """
    key = ["bank", "concept_key", "period"]
    exact = served.groupBy(*key, "period_span").agg(F.max("value").alias("own"), F.max("unit").alias("own_unit"))
    loose = served.where("period_span is null or period_span = 'as_at'").groupBy(*key).agg(F.max("value").alias("any"), F.max("unit").alias("any_unit"))
    both = truth.join(exact, [*key, "period_span"], "left").join(loose, key, "left").withColumns({"served": F.coalesce("own", "any"), "unit": F.coalesce("own_unit", "any_unit")})
    limits = F.create_map(*[F.lit(x) for item in WITHIN.items() for x in item])
    within = F.coalesce(limits[c("unit")], F.lit(1.0))
    status = F.when(c("value").isNull(), "not transcribed").when(c("served").isNull(), "missing").when(F.abs(c("served") - c("value")) <= within, "match").otherwise("mismatch")
    return both.select(*key, "period_span", "value", "served", status.alias("status"))


@dataclass(frozen=True)
class QuerySpec:
    """A metric query: names, institutions (none: all), a range of periods (None: open), spans, default slices or all."""

    concepts: tuple[str, ...]
    institutions: tuple[str, ...] = ()
    start: str | None = None
    end: str | None = None
    spans: tuple[str, ...] = ()
    whole_book: bool = True
    problems: tuple[str, ...] = field(default=())


def _known(facts: DataFrame, column: str, asked: tuple[str, ...]) -> dict[str, tuple[str | None, list[str]]]:
    """For each name asked for the stored one it is, case aside, and the three closest others."""
    if not asked:
        return {}
    names = facts.where(c(column).isNotNull()).select(c(column).alias("name")).distinct()
    pairs = names.select("name", F.explode(F.array(*[F.lit(x) for x in dict.fromkeys(asked)])).alias("asked"))
    key, bare = F.lower("name"), F.lower(F.trim("asked"))
    close = 1 - F.levenshtein(key, bare) / F.greatest(F.length(key), F.length(bare))
    near = pairs.withColumn("close", close).where("close >= 0.5")
    top = near.withColumn("place", F.row_number().over(W.partitionBy("asked").orderBy(c("close").desc(), "name"))).where("place <= 3")
    got = top.select("asked", "name", "close").orderBy("asked", "place").collect()  # three for each name asked
    return {x: (next((r["name"] for r in got if r["asked"] == x and r["close"] == 1), None), [r["name"] for r in got if r["asked"] == x]) for x in asked}


def validate_spec(spec: QuerySpec, facts: DataFrame, most: int = 12) -> QuerySpec:
    """The spec completed: unknown names named with close ones, turned ranges put right, no more than ``most`` concepts.

    The names are those that ``facts`` have; they are compared where they are, and only the closest come back.
    """
    problems, good = [], []
    for asked, column, what in ((spec.concepts, "concept_key", "concept"), (spec.institutions, "institution", "institution")):
        known = _known(facts, column, asked)
        problems += [f"no {what} {x!r}" + (f"; close: {', '.join(near)}" if near else "") for x, (name, near) in known.items() if name is None]
        good.append(tuple(dict.fromkeys(name for name, _ in known.values() if name is not None)))
    if len(good[0]) > most:
        problems.append(f"{len(good[0])} concepts; the first {most} are taken")
    start, end = spec.start, spec.end
    if start and end and start > end:
        start, end = end, start
    return replace(spec, concepts=good[0][:most], institutions=good[1], start=start, end=end, problems=tuple(problems))


def run_spec(spec: QuerySpec, facts: DataFrame) -> DataFrame:
    """Facts that a validated spec asks for; every part becomes a filter that reaches the scan."""
    out = facts.where(c("concept_key").isin(list(spec.concepts)))
    if spec.institutions:
        out = out.where(c("institution").isin(list(spec.institutions)))
    if spec.start:
        out = out.where(c("period") >= F.lit(spec.start).cast("date"))
    if spec.end:
        out = out.where(c("period") <= F.lit(spec.end).cast("date"))
    if spec.spans:
        out = out.where(c("period_span").isin(list(spec.spans)))
    if spec.whole_book:
        out = out.where("coalesce(segment_key, 'SEG_TOTAL') = 'SEG_TOTAL' and coalesce(geo_key, 'GLOBAL') = 'GLOBAL' and coalesce(industry_key, 'IND_TOTAL') = 'IND_TOTAL' and coalesce(legal_entity, 'CONSOLIDATED') = 'CONSOLIDATED'")
    return out
