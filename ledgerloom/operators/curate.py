"""What a curator of the lists works with: row classes and ancestry, addresses, suggestions, proposals, fingerprints."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.labels import segment
from ledgerloom.functions.periods import mere_period, read_period
from ledgerloom.functions.text import label_key, plain, squeeze
from ledgerloom.functions.values import cell_number
from ledgerloom.runtime import small_side

c = F.col
#: Words that leave a label a mere footnote in front of its text. Fixed values.
NOTE_MARKS = r"^\s*(?:\(?[0-9a-z]{1,2}\)|[*†‡]+|notes?\s*:|n\.?b\.?\s*:)"


def noise_reason(label: Column) -> Column:
    """Why a label names no item: ``blank``, ``number`` (nothing but figures and signs), ``footnote`` (a mark and a sentence); null if it does."""
    t = F.trim(F.coalesce(label, F.lit("")))
    sentence = t.rlike(r"\.\s*$") & (F.length(t) > 40)
    return F.when(t == "", "blank").when(~t.rlike(r"\p{L}"), "number").when(F.lower(t).rlike(NOTE_MARKS) & sentence, "footnote")


def row_classes(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``row_class``: DATA, PERIOD_ROW (figures under a mere period), SECTION_HEADER, PERIOD_BANNER, BANNER or EXCLUDED.

    Input: keys, row_id, row_type, label, valued. Without figures a period is a banner, a declared heading is one, any other
    row is a banner if rows with figures follow and left out if none does; so are notes and rows without a label.
    """
    later = F.coalesce(F.max("valued").over(W.partitionBy(*keys).orderBy("row_id").rowsBetween(1, W.unboundedFollowing)), F.lit(False))
    period = F.coalesce(mere_period(read_period(c("label"), True)["rest"]), F.lit(False))
    blank = F.coalesce(F.trim("label"), F.lit("")) == ""
    kind = F.coalesce("row_type", F.lit("data"))
    out = (
        F.when(blank | (kind == "note"), "EXCLUDED").when(c("valued") & period, "PERIOD_ROW").when(c("valued"), "DATA")
        .when(period, "PERIOD_BANNER").when(kind == "section_header", "SECTION_HEADER").when(later, "BANNER").otherwise("EXCLUDED")
    )
    return rows.withColumns({"later": later}).withColumn("row_class", out).drop("later")


def ancestry(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row_id, ancestors): labels above each row of class DATA, outermost first, without periods.

    Input: keys, row_id, level, label, row_class, row_parent. The captured chain of parents comes first; a row without one
    stands under the innermost banners that are not deeper than it. Sequential within a printed table, which is one group.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        at = {r.row_id: r for r in pdf.itertuples()}
        out, banners = [], []
        for r in pdf.itertuples():
            if r.row_class in ("SECTION_HEADER", "BANNER"):
                level = 0 if pd.isna(r.level) else r.level
                banners = [b for b in banners if b[0] < level] + [(level, r.label)]
            elif r.row_class == "DATA":
                chain, up, seen = [], r.row_parent, {r.row_id}
                while not pd.isna(up) and up in at and up not in seen:
                    seen.add(up)
                    if at[up].row_class not in ("PERIOD_ROW", "PERIOD_BANNER"):
                        chain.append(at[up].label)
                    up = at[up].row_parent
                level = 0 if pd.isna(r.level) else r.level
                out.append((r.row_id, chain[::-1] or [label for deep, label in banners if deep <= level]))
        found = pd.DataFrame(out, columns=["row_id", "ancestors"])
        for k in reversed(keys):
            found.insert(0, k, pdf[k].iloc[0])
        return found

    kinds = dict(rows.dtypes)
    return rows.groupBy(*keys).applyInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + f", row_id {kinds['row_id']}, ancestors array<string>")


def filled_parents(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row_id, parent): each row's nearest earlier row of a lower level, as ``hN`` (the N-th row that heads deeper ones); input keys, row_id, row_type, level.

    A row that another stands under heads it unless it is a section_header, which has no number and gives its label's place ``#row``.
    """
    from ledgerloom.operators.generic import nearest_shallower

    order = W.partitionBy(*keys).orderBy("row_id")
    heads = (F.coalesce("row_type", F.lit("")) != "section_header") & (F.lead("level").over(order) > c("level"))
    numbered = rows.withColumn("heads", F.coalesce(heads, F.lit(False))).withColumn("nth", F.sum(c("heads").cast("int")).over(order))
    found = nearest_shallower(rows.select(*keys, "row_id", "level"), keys, "row_id", "level", "up")
    names = numbered.select(*keys, c("row_id").alias("up"), F.when(c("heads"), F.concat(F.lit("h"), c("nth").cast("string"))).otherwise(F.concat(F.lit("#"), c("row_id").cast("string"))).alias("parent"))
    return found.join(names, [*keys, "up"], "left").select(*keys, "row_id", "parent")


def addresses(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, row_id, address): the label, behind its parent's where the rows of that depth have several; input keys, row_id, depth, label, parent_label."""
    several = rows.groupBy(*keys, "depth").agg((F.count_distinct(F.coalesce("parent_label", F.lit(""))) > 1).alias("several"))
    both = rows.join(several, [*keys, "depth"])
    return both.select(*keys, "row_id", F.when(c("several") & c("parent_label").isNotNull(), F.concat_ws("::", "parent_label", "label")).otherwise(c("label")).alias("address"))


def benchmark_rows(cells: DataFrame, by: list[str], period: str, ties: list[str]) -> DataFrame:
    """One row for each ``by``: of the preferred period if there is one, else of the latest; the first by ``ties``."""
    key = F.struct(~F.coalesce(c("period") == F.lit(period).cast("date"), F.lit(False)), -F.coalesce(F.unix_date("period"), F.lit(-(10**6))), *ties)
    return cells.groupBy(*by).agg(F.min_by(F.struct(*[x for x in cells.columns if x not in by]), key).alias("r")).select(*by, "r.*")


def suggest_between(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """(doc_id, table_id, row_id, canonical_leaf_id): what an unresolved row may be: entries between those of the resolved rows around it.

    ``rows``: doc_id, table_id, row_id, table_type_id, ordinal (null: unresolved); ``entries``: table_type_id, ordinal,
    canonical_leaf_id. The places between are listed and looked up, so only entries of the gap are met.
    """
    order = W.partitionBy("doc_id", "table_id", "table_type_id").orderBy("row_id")
    low = F.last("ordinal", True).over(order.rowsBetween(W.unboundedPreceding, -1))
    high = F.first("ordinal", True).over(order.rowsBetween(1, W.unboundedFollowing))
    gaps = rows.withColumns({"low": low, "high": high}).where("ordinal is null and high - low > 1")
    asked = gaps.select("doc_id", "table_id", "row_id", "table_type_id", F.explode(F.sequence(c("low") + 1, c("high") - 1)).alias("ordinal"))
    return asked.join(small_side(entries), ["table_type_id", "ordinal"]).select("doc_id", "table_id", "row_id", "canonical_leaf_id")


def sum_roles(rows: DataFrame) -> DataFrame:
    """(doc_id, table_id, row_id, role, sum_group): total, component or atomic, and the group of a total and its parts, numbered in printed order.

    Input: doc_id, table_id, row_id, row_parent. A row that is both counts as a total.
    """
    key = ["doc_id", "table_id"]
    heads = rows.where("row_parent is not null").groupBy(*key, c("row_parent").alias("head")).agg(F.min("row_id").alias("first"))
    heads = heads.withColumn("g", F.concat(F.lit("G"), F.dense_rank().over(W.partitionBy(*key).orderBy(F.least("head", "first"))).cast("string"))).drop("first")
    own, above = heads.withColumnsRenamed({"head": "row_id", "g": "own"}), heads.withColumnsRenamed({"head": "row_parent", "g": "above"})
    out = rows.join(own, [*key, "row_id"], "left").join(above, [*key, "row_parent"], "left")
    role = F.when(c("own").isNotNull(), "total").when(c("above").isNotNull(), "component").otherwise("atomic")
    return out.select(*key, "row_id", role.alias("role"), F.coalesce("own", "above").alias("sum_group"))


def year_column(columns: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, col_id, why): the column that stands for the year: a full year, else the year's close, else its last quarter, the first of equals; ``none`` without one.

    Input: keys, col_id, period, period_span.
    """
    december = F.coalesce(F.month("period") == 12, F.lit(False))
    rank = F.when(c("period_span") == "FY", 0).when(december & (c("period_span") == "as_at"), 1).when(december & (c("period_span") == "4Q"), 2)
    best = columns.groupBy(*keys).agg(F.min(F.when(rank.isNotNull(), F.struct(rank.alias("rank"), c("col_id").alias("col_id")))).alias("b"))
    why = F.get(F.array(F.lit("full year"), F.lit("year's close"), F.lit("last quarter")), c("b.rank"))
    return best.select(*keys, c("b.col_id").alias("col_id"), F.coalesce(why, F.lit("none")).alias("why"))


def propose_rows(rows: DataFrame) -> DataFrame:
    """(table_type_id, segment, filings, seen, sample): identities that printed rows have and the list lacks, for a curator to decide on; input table_type_id, doc_id, label, canonical_leaf_id.

    A label counts as known if any row of its type and segment is resolved.
    """
    named = rows.where("table_type_id is not null").withColumn("segment", segment(c("label"))).where("segment <> ''")
    sums = named.groupBy("table_type_id", "segment").agg(F.max(F.coalesce(F.trim("canonical_leaf_id") != "", F.lit(False))).alias("known"), F.count_distinct("doc_id").alias("filings"), F.count("*").alias("seen"), F.min("label").alias("sample"))
    return sums.where("not known").drop("known")


def fuzzy_lookup(labels: DataFrame, needles: DataFrame, least: float = 0.6) -> DataFrame:
    """(label, needle, shared, score): the closest needle of each label: two words or more that are all of one side, or a Jaccard share of ``least``.

    Both sides have one text column. An inverted index by word finds the pairs; equal scores by more shared words, then by the smaller needle.
    """
    words = lambda x: F.array_distinct(F.filter(F.split(F.lower(x), r"[^a-z0-9]+"), lambda w: w != ""))
    a = labels.select(c("label")).distinct().withColumn("w", words(c("label"))).select("label", F.size("w").alias("na"), F.explode("w").alias("word"))
    b = needles.select(c("needle")).distinct().withColumn("w", words(c("needle"))).select("needle", F.size("w").alias("nb"), F.explode("w").alias("word"))
    pairs = a.join(small_side(b), "word").groupBy("label", "needle", "na", "nb").agg(F.count("*").alias("shared"))
    score = c("shared") / (c("na") + c("nb") - c("shared"))
    near = pairs.withColumn("score", F.round(score, 6)).where(((c("shared") >= 2) & (c("shared") == F.least("na", "nb"))) | (score >= least))
    return near.groupBy("label").agg(F.min_by(F.struct("needle", "shared", "score"), F.struct(-c("score"), -c("shared"), "needle")).alias("b")).select("label", "b.*")


def greedy_pairs(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, left, right, score): one-to-one pairs, the best score first, then the smaller names; input keys, left, right, score.

    Sequential within a group, which is one document's candidates.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right, kept = set(), set(), []
        for i, r in pdf.sort_values(["score", "left", "right"], ascending=[False, True, True]).iterrows():
            if r["left"] not in left and r["right"] not in right:
                left.add(r["left"])
                right.add(r["right"])
                kept.append(i)
        return pdf.loc[kept]

    return scores.groupBy(*keys).applyInPandas(run, scores.schema)


def fingerprint(title: Column, leaves: Column, labels: Column) -> Column:
    """Twelve digits that tell a printed table: of its title, its column headings and its first three row labels."""
    text = lambda x: F.concat_ws("\x1f", F.transform(x, lambda y: F.coalesce(plain(y), F.lit(""))))
    return F.substring(F.sha1(F.concat_ws("\x1e", F.coalesce(plain(title), F.lit("")), text(leaves), text(F.slice(labels, 1, 3)))), 1, 12)


def section_units(sections: DataFrame) -> DataFrame:
    """(doc_id, section_id, first_seq, last_seq): one unit of work for each section that no other is below, up to the next of them; input doc_id, section_id, parent_section, seq."""
    leaves = sections.join(sections.select("doc_id", c("parent_section").alias("section_id")).where("section_id is not null").distinct(), ["doc_id", "section_id"], "left_anti")
    leaves = leaves.groupBy("doc_id", "section_id").agg(F.min("seq").alias("first_seq"))
    ends = sections.groupBy("doc_id").agg(F.max("seq").alias("end"))
    upto = F.lead("first_seq").over(W.partitionBy("doc_id").orderBy("first_seq", "section_id"))
    return leaves.withColumn("next", upto).join(ends, "doc_id").select("doc_id", "section_id", "first_seq", F.greatest(c("first_seq"), F.coalesce(c("next") - 1, c("end"))).alias("last_seq"))


def known_by_key(rows: DataFrame) -> DataFrame:
    """(table_type_id, alias, canonical_leaf_id): labels without an identity that differ from a resolved one of their type only by footnotes, case or blanks.

    Input: table_type_id, label, canonical_leaf_id. A key that stands for several identities of a type gives no alias.
    """
    keyed = rows.where("table_type_id is not null").withColumn("key", label_key(c("label"))).where("key <> ''")
    resolved = keyed.where("canonical_leaf_id <> ''").groupBy("table_type_id", "key").agg(F.min("canonical_leaf_id").alias("leaf"), F.max("canonical_leaf_id").alias("last")).where("leaf = last")
    labels = keyed.groupBy("table_type_id", "key", "label").agg(F.max(F.coalesce(c("canonical_leaf_id") != "", F.lit(False))).alias("resolved")).where("not resolved")
    return labels.join(resolved, ["table_type_id", "key"]).select("table_type_id", c("label").alias("alias"), c("leaf").alias("canonical_leaf_id"))


def repaired_headings(tables: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, columns, rows): tables whose columns are headed by single letters, with the labels of their first rows in place of the letters.

    A reader that cannot place stacked headings names the columns A, B, C and leaves the headings as rows without values on
    top. Only a table all of whose columns are such letters, and which has as many such rows on top, is changed: those rows go.
    """
    filled = lambda r: F.exists(r["values"], lambda v: F.coalesce(F.trim(v["value"]) != "", F.lit(False)))
    n = F.size("columns")
    letters = (n > 0) & F.forall("columns", lambda x: F.coalesce(F.trim(x["leaf"]).rlike("^[A-Za-z]$"), F.lit(False)))
    top = F.slice("rows", F.lit(1), F.greatest(n, F.lit(0)))
    ready = F.coalesce(letters & (F.size("rows") > n) & F.forall(top, lambda r: ~F.coalesce(filled(r), F.lit(False)) & (F.coalesce(F.trim(r["label"]), F.lit("")) != "")), F.lit(False))
    headed = F.zip_with("columns", top, lambda x, r: x.withField("leaf", r["label"]))
    rest = F.slice("rows", n + 1, F.greatest(F.size("rows"), F.lit(1)))
    return tables.select(*keys, F.when(ready, headed).otherwise(c("columns")).alias("columns"), F.when(ready, rest).otherwise(c("rows")).alias("rows"))


def display_name(title: Column) -> Column:
    """A title as it is shown: blanks squeezed, one wholly in capitals as a sentence."""
    t = squeeze(plain(title))
    return F.when((t == F.upper(t)) & t.rlike(r"\p{L}{4}"), F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 20)))).otherwise(t)


def typed_text(text: Column) -> Column:
    """What a printed token is when it is typed in: ``empty``, ``number``, ``period`` or ``text``."""
    t = plain(F.coalesce(text, F.lit("")))
    period = F.coalesce(mere_period(read_period(t)["rest"]), F.lit(False))
    return F.when(t == "", "empty").when(cell_number(t).isNotNull(), "number").when(period, "period").otherwise("text")


def stage_states(events: DataFrame, by: str, stages: list[str]) -> DataFrame:
    """(by, stage, state): how far each one is: ``done`` up to the furthest stage reached, ``skipped`` for those before it that never came, ``next``, ``pending``.

    Input: by, event_type. Events of no declared stage count for none.
    """
    known = F.array(*[F.lit(s) for s in stages])
    place = F.array_position(known, c("event_type")).cast("int")
    reached = events.withColumn("place", place).groupBy(by).agg(F.max("place").alias("far"), F.collect_set(F.when(c("place") > 0, c("event_type"))).alias("seen"))
    rows = reached.select(by, "far", "seen", F.posexplode(known).alias("at", "stage")).withColumn("at", c("at") + 1)
    state = F.when(F.array_contains("seen", c("stage")), "done").when(c("at") < c("far"), "skipped").when(c("at") == c("far") + 1, "next").otherwise("pending")
    return rows.select(by, "stage", state.alias("state"))
