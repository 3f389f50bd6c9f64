"""Extraction units to the star schema: one frame a step, each a plain projection, join or window of earlier ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.periods import BESIDE, UNIT_TOKENS, clamp_year, let, mere_period, read_period, span_start
from ledgerloom.functions.text import label_key, plain, slug, squeeze, strip_footnotes
from ledgerloom.functions.units import unit_of_heading, with_stated_unit
from ledgerloom.functions.values import cell_number, cell_state
from ledgerloom.operators.axes import AXES, column_members, resolve
from ledgerloom.operators.generic import level_parent, strict_mode
from ledgerloom.operators.hierarchy import table_links
from ledgerloom.operators.structure import split_captions, whole_tables
from ledgerloom.operators.totals import total_columns, verified_totals
from ledgerloom.runtime import small_side, stage

#: Column banners that name a legal entity, and the member that none means. Fixed values.
ENTITIES = {"the group": "CONSOLIDATED", "group": "CONSOLIDATED", "the bank": "BANK_SOLO", "bank": "BANK_SOLO", "the company": "COMPANY_SOLO", "company": "COMPANY_SOLO"}
#: Words of a heading that do not describe its column.
NO_WORDS = {*" ".join(ENTITIES).split(), "restated", "unaudited", "audited"}
#: Words of which a masthead consists besides the institution's own name. Fixed values.
MASTHEAD = ["and", "its", "subsidiaries", "group", "limited", "ltd", "holdings", "bank", "banking", "corporation", "the", "plc", "berhad"]
KEY = ["doc_id", "table_no"]
c = F.col


def raw_tables(units: DataFrame, filings: DataFrame) -> DataFrame:
    """Tables of each filing, numbered in the order of their units; captions put right, echoed groups dropped.

    Input: units (unit_id, doc_id, tables), each unit once; filings (doc_id, institution, doc_period). A title that is
    nothing but a masthead changes place with a label header that says more.
    """
    # numbers come from slim rows: how many tables the filing's earlier units have
    present = F.filter("tables", lambda t: t.isNotNull())
    before = W.partitionBy("doc_id").orderBy("unit_id").rowsBetween(W.unboundedPreceding, -1)
    counts = units.select("unit_id", "doc_id", F.coalesce(F.size(present), F.lit(0)).alias("n")).select(c("unit_id").alias("u"), c("doc_id").alias("d"), F.coalesce(F.sum("n").over(before), F.lit(0)).cast("int").alias("before"))
    numbered = units.join(small_side(counts), c("unit_id").eqNullSafe(c("u")) & c("doc_id").eqNullSafe(c("d")))
    rows = numbered.select("unit_id", "doc_id", "before", F.posexplode(present).alias("at", "t")).withColumn("table_no", c("before") + c("at") + 1)
    rows = rows.join(filings.select("doc_id", "institution", "doc_period"), "doc_id", "left")
    words = lambda x: F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "), " "), lambda w: w != "")
    extra = F.array_except(words(c("t.title")), F.concat(words(c("institution")), F.array(*[F.lit(w) for w in MASTHEAD])))
    masthead = (F.size(words(c("t.title"))) > 0) & (F.size(extra) == 0) & (F.size(words(c("t.label_header"))) > 0)
    return rows.select(
        "doc_id", "table_no", "unit_id", "institution", "doc_period", F.when(masthead, c("t.label_header")).otherwise(c("t.title")).alias("title"),
        F.when(masthead, c("t.title")).otherwise(c("t.label_header")).alias("label_header"), c("t.section_id").alias("section_id"),
        F.coalesce(c("t.continued_from_previous"), F.lit(False)).alias("continued"), c("t.columns").alias("columns"), c("t.rows").alias("rows"),
    )


def column_axis(tables: DataFrame) -> DataFrame:
    """One row a leaf column: period of the leaf, else of its banner; unit, legal entity, role, banner's number (from 100)."""
    cols = tables.select(*KEY, "doc_period", F.posexplode("columns").alias("at", "col"))
    echo = squeeze(F.lower(c("col.group"))) == squeeze(F.lower(c("col.leaf")))
    cols = cols.select(*KEY, "doc_period", (c("at") + 1).alias("col_id"), F.when(~F.coalesce(echo, F.lit(False)), c("col.group")).alias("banner"), c("col.leaf").alias("leaf"))
    # a banner that repeats in front of the leaf's own words ("The Group Q1 2020") is read from the leaf
    own, above = read_period(c("leaf"), True), read_period(c("banner"), True)
    cols = cols.withColumns({"own": own, "above": above})
    # a period beside other words dates a column only if all such columns have the same words there: a measure's name flattened
    # into the axis; words that differ describe the columns
    words = F.array_join(F.filter(F.split("own.rest", " "), lambda w: w.rlike("[a-z0-9]") & ~w.isin(*BESIDE, *UNIT_TOKENS, *NO_WORDS)), " ")
    cols = cols.withColumn("words", F.nullif(words, F.lit("")))
    kinds = F.size(F.collect_set("words").over(W.partitionBy(*KEY)))
    cols = cols.withColumn("gap", c("words").isNotNull() & (kinds > 1)).withColumn("own", F.when(~c("gap"), c("own")))
    cols = cols.withColumn("p", F.coalesce("own", "above")).withColumn("k", clamp_year(F.when(c("own").isNotNull(), c("leaf")).otherwise(c("banner")), c("p.end"), c("p.span"), c("doc_period")))
    entity = F.create_map(*[F.lit(x) for item in ENTITIES.items() for x in item])
    named = let(squeeze(F.lower(plain(F.coalesce(c("banner"), F.lit(""))))), lambda b: entity[F.nullif(b, F.lit(""))])
    leading = let(F.regexp_extract(F.lower(squeeze(plain(c("leaf")))), r"^(the (?:group|bank|company))\b", 1), lambda b: entity[F.nullif(b, F.lit(""))])
    first = W.partitionBy(*KEY, "banner")
    cols = cols.withColumn("first_of", F.min("col_id").over(first))
    rank = F.dense_rank().over(W.partitionBy(*KEY).orderBy(c("banner").isNull(), "first_of"))
    role = F.when(c("leaf").rlike(r"(?i)^\s*(\+\s*/\s*\(?-\)?|change|movement|variance|% chg)"), "derived").when(c("leaf").rlike(r"(?i)^\s*notes?\s*$"), "reference")
    return cols.select(
        *KEY, "col_id", "banner", "leaf", F.when(c("banner").isNotNull(), rank + 99).alias("banner_id"), F.when(c("p").isNotNull(), c("k.end")).alias("period"),
        F.when(c("p").isNotNull(), c("k.span")).alias("period_span"), F.coalesce(named, leading).alias("legal_entity"), role.alias("col_role"), "gap",
    )


def row_axis(tables: DataFrame) -> DataFrame:
    """One row a printed row: clean label, level, its period if the label is nothing but one, and that of the banner above.

    A banner is a heading row without values that is a period; the last one above a row holds for it.
    """
    rows = tables.select(*KEY, "doc_period", F.posexplode("rows").alias("at", "r"))
    rows = rows.select(*KEY, "doc_period", (c("at") + 1).alias("row_id"), c("r.row_id").alias("line_no"), c("r.row_type").alias("row_type"), F.coalesce(c("r.level"), F.lit(0)).alias("level"), c("r.label").alias("label"), c("r.values").alias("values"))
    rows = rows.withColumn("label_clean", squeeze(strip_footnotes(plain(c("label"))))).withColumn("p", read_period(c("label"), True))
    covers = F.coalesce(mere_period(c("p.rest"), units=True), F.lit(False))
    rows = rows.withColumn("k", F.when(covers, clamp_year(c("label"), c("p.end"), c("p.span"), c("doc_period"))))
    heading = c("row_type").isin("section_header", "sub_header")
    before = W.partitionBy(*KEY).orderBy("row_id").rowsBetween(W.unboundedPreceding, -1)
    banner = F.last(F.when(heading, c("k")), True).over(before)
    return rows.withColumn("b", banner).select(
        *KEY, "row_id", "line_no", "row_type", "level", "label", "label_clean", "values", c("k.end").alias("period"), c("k.span").alias("period_span"),
        F.when(~(heading & c("k").isNotNull()), c("b.end")).alias("banner_period"), F.when(~(heading & c("k").isNotNull()), c("b.span")).alias("banner_span"),
    )


def row_parents(rows: DataFrame, links: DataFrame, sums: DataFrame) -> DataFrame:
    """(key, row_id, row_parent): the printed parent if it is shallower, else the nearest earlier row of the level above.

    Totals and notes are passed over, but a total that adds nothing up and is followed by deeper rows heads a block.
    """
    heads = sums.where("sums_to is not null").select(*KEY, c("sums_to").alias("row_id"), F.lit(True).alias("adds")).distinct()
    order = W.partitionBy(*KEY).orderBy("row_id")
    base = rows.select(*KEY, "row_id", "row_type", "level").join(heads, [*KEY, "row_id"], "left")
    base = base.withColumn("heads", (F.lead("level").over(order) > c("level")) & c("adds").isNull())
    kind = F.coalesce("row_type", F.lit("data"))
    may = (kind != "total") | F.coalesce("heads", F.lit(False))
    base = level_parent(base, KEY, "row_id", "level", "notes", may)
    base = level_parent(base, KEY, "row_id", "level", "data", may & (kind != "note"))
    base = base.withColumn("by_place", F.when(kind == "note", c("notes")).otherwise(c("data")))
    printed = links.join(base.select(*KEY, c("row_id").alias("up"), c("level").alias("up_level")), [*KEY, "up"])
    out = base.join(printed.select(*KEY, "row_id", "up", "up_level"), [*KEY, "row_id"], "left")
    return out.select(*KEY, "row_id", F.when(c("up_level") < c("level"), c("up")).otherwise(c("by_place")).alias("row_parent"))


def printed_links(tables: DataFrame) -> DataFrame:
    """(key, row_id, up) of the parents that rows name and that are there."""
    one = tables.select(F.concat_ws("|", "doc_id", "table_no").alias("unit_id"), F.array(F.struct("rows")).alias("tables"))
    links = table_links(one).where("parent is not null and parent not like '?%'")
    parts = F.split(F.regexp_replace("scope", r":0$", ""), r"\|")
    return links.select(parts[0].alias("doc_id"), parts[1].cast("int").alias("table_no"), (c("node").cast("int") + 1).alias("row_id"), (c("parent").cast("int") + 1).alias("up"))


def build_star(units: DataFrame, filings: DataFrame, only: set[str] | None = None, members: DataFrame | None = None) -> dict[str, DataFrame]:
    """Frames table_t, col_dim, row_dim, cell_fact, sums, column_sums and load_warning of all units, or the ones in ``only``.

    Tables that stack several captioned ones are split, then printed continuations are joined to what they continue.
    cell_fact has the period of the first that states one (column, row, banner above, title, filing) with that source's
    span, the unit by precedence and last the filing's most frequent table unit, and on each axis the member that the
    row's label names, else the column's, else the whole book. ``members`` (axes.member_map) tells what labels name;
    without it nothing is named. Rows wider than the heading are left out and reported; so are tables whose id comes
    twice and labels that name members of several axes of which none counts.
    """
    tables = stage(whole_tables(stage(split_captions(raw_tables(units, filings)))))
    members = members if members is None else stage(members)
    cols = stage(column_members(column_axis(tables), KEY, members))
    rows = stage(resolve(row_axis(tables), KEY, members))
    width = cols.groupBy(*KEY).agg(F.max("col_id").alias("width"))
    sized = rows.select(*KEY, "row_id", "row_type", F.size(F.coalesce("values", F.array())).alias("n"), "values").join(width, KEY, "left")
    wide = sized.where("n > coalesce(width, 0) and n > 0")
    kept = sized.where("n <= coalesce(width, 0)").where(~F.coalesce(c("row_type"), F.lit("data")).isin("section_header", "sub_header", "note"))
    cells = kept.select(*KEY, "row_id", F.posexplode("values").alias("at", "v")).select(*KEY, "row_id", (c("at") + 1).alias("col_id"), c("v.value").alias("value_raw"))
    cells = cells.withColumns({"cell_state": cell_state(c("value_raw")), "value_num": cell_number(c("value_raw"))})
    titled = stage(tables.select(*KEY, "unit_id", "institution", "doc_period", "title", "label_header", "section_id", "continued", read_period(c("title")).alias("t")))
    named = lambda df: df.withColumnRenamed("table_no", "table_id").withColumn("table_id", c("table_id").cast("string"))
    need = only or {"table_t", "col_dim", "row_dim", "cell_fact", "sums", "column_sums", "load_warning"}
    when = cells.select(*KEY, "col_id").distinct().join(cols.select(*KEY, "col_id", "period"), [*KEY, "col_id"]).groupBy(*KEY).agg(F.max("period").alias("col_period"))
    table_t = titled.join(when, KEY, "left").withColumn("table_period", F.coalesce(c("t.end"), c("col_period"), c("doc_period")))
    table_t = table_t.withColumn("table_id", F.concat_ws("|", F.coalesce("section_id", F.lit("")), slug(c("title")), c("table_period").cast("string"))).drop("t")
    out = {"table_t": table_t, "col_dim": cols.drop("ambiguous", "banner_ambiguous", "gap")}
    if not need - set(out):
        return out
    facts = stage(_facts(cells, cols, rows, titled))
    ids = table_t.select(*KEY, "table_id")
    if "cell_fact" in need:
        votes = facts.where("unit is not null").select(*KEY, "unit").distinct()
        modal = strict_mode(votes, ["doc_id"], "unit").select("doc_id", c("mode").alias("modal"))
        out["cell_fact"] = facts.join(modal, "doc_id", "left").withColumn("unit", F.coalesce("unit", "modal")).drop("modal").join(ids, KEY)
    if "column_sums" in need:
        out["column_sums"] = total_columns(named(facts), named(cols))
    if need & {"row_dim", "sums", "load_warning"}:
        column_units = cols.select(*KEY, "col_id", unit_of_heading(c("leaf")).alias("unit"))
        sums = verified_totals(named(rows), named(facts), named(column_units)).withColumn("table_no", c("table_id").cast("int")).drop("table_id")
        out["sums"] = sums = stage(sums)
    if "load_warning" in need:
        out["load_warning"] = _warnings(wide, table_t, rows, cols, sums, titled)
    if "row_dim" in need:
        parents = row_parents(rows, printed_links(tables), sums)
        sums_of = sums.where("sums_to is not null").select(*KEY, "row_id", "sums_to", "sums_sign")
        out["row_dim"] = rows.drop("values", "ambiguous").join(parents, [*KEY, "row_id"]).join(sums_of, [*KEY, "row_id"], "left").withColumn("label_key", label_key(c("label")))
    return out


def _facts(cells: DataFrame, cols: DataFrame, rows: DataFrame, titled: DataFrame) -> DataFrame:
    """Cells with their unit, period and its source, legal entity and axis members."""
    no_unit = F.lit(None).cast("string")
    facts = cells.join(cols, [*KEY, "col_id"]).join(rows.select(*KEY, "row_id", "label", c("period").alias("r_period"), c("period_span").alias("r_span"), "banner_period", "banner_span", *[c(a).alias(f"r_{a}") for a in AXES]), [*KEY, "row_id"]).join(titled.select(*KEY, "doc_period", "title", "label_header", "t"), KEY)
    facts = with_stated_unit(facts.withColumn("u", no_unit), "unit", row_unit="u", row_label="label", col_unit="u", col_label="leaf", table_unit="u", table_title="title")
    sources = [("col", c("period"), c("period_span")), ("row", c("r_period"), c("r_span")), ("row_banner", c("banner_period"), c("banner_span")), ("table_title", c("t.end"), c("t.span")), ("document", c("doc_period"), no_unit)]
    chosen = F.coalesce(*[F.when(p.isNotNull(), F.struct(p.alias("period"), s.alias("period_span"), F.lit(n).alias("period_source"))) for n, p, s in sources])
    return facts.withColumn("chosen", chosen).select(
        *KEY, "row_id", "col_id", "value_raw", "value_num", "cell_state", "unit", "chosen.*", span_start(c("chosen.period_span"), c("chosen.period")).alias("period_start"),
        F.coalesce("legal_entity", F.lit("CONSOLIDATED")).alias("legal_entity"), *[F.coalesce(f"r_{a}", a, F.lit(total)).alias(a) for a, total in AXES.items()], "col_role",
    )


def undated(table_t: DataFrame, cols: DataFrame, titled: DataFrame) -> DataFrame:
    """(KEY, table_period): tables that neither a column nor their own period puts at the filing's date, and whose title does not say why."""
    has = cols.groupBy(*KEY).agg(F.max("period").alias("any")).join(cols.join(titled.select(*KEY, "doc_period"), KEY).where("period = doc_period").select(*KEY, F.lit(True).alias("has")).distinct(), KEY, "left")
    dated = titled.where("t.end is not null").select(*KEY)
    return table_t.join(has, KEY).where("any is not null and has is null and doc_period is not null and table_period <> doc_period").join(dated, KEY, "left_anti").select(*KEY, "table_period")


def _warnings(wide: DataFrame, table_t: DataFrame, rows: DataFrame, cols: DataFrame, sums: DataFrame, titled: DataFrame) -> DataFrame:
    """What was left out, is doubtful or could not be verified."""
    ids = table_t.select(*KEY, "table_id")
    twice = ids.groupBy("doc_id", "table_id").agg(F.count("*").alias("n")).where("n > 1")
    doubtful = rows.where("ambiguous").select(*KEY, "label").unionByName(cols.where("ambiguous").select(*KEY, c("leaf").alias("label"))).unionByName(cols.where("banner_ambiguous").select(*KEY, c("banner").alias("label"))).distinct()
    said = lambda df, *parts: df.select(*KEY, F.concat(*parts).alias("warning"))
    out = said(wide, F.lit("row "), c("row_id").cast("string"), F.lit(" is wider than the heading"))
    out = out.unionByName(said(ids.join(twice, ["doc_id", "table_id"]), F.lit("table id comes twice: "), c("table_id")))
    out = out.unionByName(said(cols.where("gap"), F.lit("heading is a period beside words of its own: "), c("leaf")))
    out = out.unionByName(said(undated(table_t, cols, titled), F.lit("filing's period is not among the table's, latest "), c("table_period").cast("string")))
    out = out.unionByName(said(doubtful, F.lit("label names members of several axes: "), c("label")))
    return out.unionByName(said(sums.where("sums_to is null"), F.lit("total "), c("row_id").cast("string"), F.lit(" not verified: "), c("outcome")))


def breakdown_violations(star: dict[str, DataFrame]) -> DataFrame:
    """Verified members whose signed sum misses their total by more than a unit a member: must be empty."""
    facts = star["cell_fact"].where("value_num is not null and coalesce(unit, '') <> 'percent'").select(*KEY, "row_id", "col_id", "value_num")
    members = star["sums"].where("sums_to is not null").join(facts, [*KEY, "row_id"])
    sums = members.groupBy(*KEY, c("sums_to").alias("row_id"), "col_id").agg(F.sum(c("sums_sign") * c("value_num")).alias("sum"), F.count("*").alias("n"))
    both: Column = F.abs(c("sum") - c("value_num")) > F.greatest(c("n"), F.lit(1)) + 1
    return sums.join(facts, [*KEY, "row_id", "col_id"]).where(both)
