"""Row and column identity from a curated list: tables located by content, contests decided, columns with a veto."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.text import label_key

c = F.col
LEAST_MATCHES, LEAST_SHARE, VETO_SHARE = 2, 0.5, 0.5


def norm_path(path: Column) -> Column:
    """A "a::b::c" path with each part in its key form."""
    return F.array_join(F.transform(F.split(path, "::"), lambda x: F.lower(F.trim(F.regexp_replace(x, r"\s+", " ")))), "::")


def path_variants(path: Column) -> Column:
    """The path itself and, if it has ancestors, the path without the outermost one."""
    parts = F.split(path, "::")
    inner = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(2), F.size(parts) - 1), "::"))
    return F.array_distinct(F.array_compact(F.array(path, inner)))


def first_entries(master: DataFrame) -> DataFrame:
    """The list with its first entry for each (bank, type, path); input bank, table_type_id, line_ordinal, canonical_leaf_id, full_path, source_family."""
    keyed = master.withColumn("path", norm_path(c("full_path")))
    return keyed.groupBy("bank", "table_type_id", "path").agg(F.min_by(F.struct("canonical_leaf_id", "line_ordinal", "source_family"), F.struct(c("line_ordinal").isNull(), "line_ordinal", "canonical_leaf_id")).alias("e")).select("bank", "table_type_id", "path", "e.*")


def locate(tables: DataFrame, paths: DataFrame, master: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(doc_id, table_id, bank, table_type_id, matched, declared, share): table types each table may be.

    ``tables``: doc_id, table_id, bank, family (null: any); ``paths``: doc_id, table_id, path; ``aliases``: bank,
    table_type_id, alias path, path. A table of the type's kind of filing must print two of the type's leaves and half
    of those declared; renamed leaves count as found but not as declared. The list is an inverted index by path, so
    only tables that print one of a type's leaves meet it.
    """
    entries = first_entries(master)
    declared = entries.groupBy("bank", "table_type_id").agg(F.count_distinct("path").alias("declared"), F.collect_set("source_family").alias("families"))
    index = entries.select("bank", "table_type_id", "path")
    if aliases is not None:
        index = index.unionByName(aliases.select("bank", "table_type_id", norm_path(c("alias")).alias("path"))).distinct()
    printed = paths.select("doc_id", "table_id", F.explode(path_variants(norm_path(c("path")))).alias("path")).distinct()
    hits = printed.join(tables, ["doc_id", "table_id"]).join(index, ["bank", "path"]).groupBy("doc_id", "table_id", "bank", "family", "table_type_id").agg(F.count("*").alias("matched"))
    hits = hits.join(declared, ["bank", "table_type_id"])
    kin = (F.size("families") == 0) | c("family").isNull() | F.array_contains("families", c("family"))
    return hits.where(kin & (c("matched") >= LEAST_MATCHES) & (c("matched") >= LEAST_SHARE * c("declared"))).select("doc_id", "table_id", "bank", "table_type_id", "matched", "declared", (c("matched") / c("declared")).alias("share"))


def one_type(hits: DataFrame) -> DataFrame:
    """Contests decided: of two types that claim a table the one with the larger share, then more matches, then the smaller id.

    Tables that more than two types claim keep them all (one exhibit may hold several types); a type that would lose
    its last table keeps its best one.
    """
    claims = W.partitionBy("doc_id", "table_id")
    rank = F.row_number().over(claims.orderBy(c("share").desc(), c("matched").desc(), "table_type_id"))
    rows = hits.withColumns({"claims": F.count("*").over(claims), "rank": rank})
    rows = rows.withColumn("kept", (c("rank") == 1) | (c("claims") > 2))
    kind = W.partitionBy("bank", "table_type_id")
    best = F.row_number().over(kind.orderBy(c("share").desc(), c("matched").desc(), "doc_id", "table_id"))
    rows = rows.withColumns({"any": F.max("kept").over(kind), "best": best})
    return rows.where(c("kept") | (~c("any") & (c("best") == 1))).select("doc_id", "table_id", "bank", "table_type_id", "matched", "declared", "share")


def stamp_rows(rows: DataFrame, located: DataFrame, master: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(doc_id, table_id, row_id, table_type_id, canonical_leaf_id, how): identities of rows, copied from the list.

    ``rows``: doc_id, table_id, row_id, path. Tried in order: the path as it is, a curated rename, the path without its
    outermost part. Rows that nothing in the list names have none.
    """
    entries = first_entries(master).select("bank", "table_type_id", "path", "canonical_leaf_id")
    printed = rows.join(located.select("doc_id", "table_id", "bank", "table_type_id"), ["doc_id", "table_id"]).select("*", F.posexplode(path_variants(norm_path(c("path")))).alias("variant", "p"))
    tries = printed.join(entries.withColumnRenamed("path", "p"), ["bank", "table_type_id", "p"]).withColumn("rank", c("variant") * 2)
    if aliases is not None:
        renamed = aliases.select("bank", "table_type_id", norm_path(c("alias")).alias("p"), norm_path(c("path")).alias("path2")).join(entries.withColumnRenamed("path", "path2"), ["bank", "table_type_id", "path2"]).drop("path2")
        tries = tries.unionByName(printed.join(renamed, ["bank", "table_type_id", "p"]).withColumn("rank", c("variant") * 2 + 1))
    best = F.min_by(F.struct("table_type_id", "canonical_leaf_id", "rank"), F.struct("rank", "table_type_id", "canonical_leaf_id")).alias("b")
    how = F.when(c("b.rank") == 0, "path").when(c("b.rank") == 1, "alias").otherwise("variant")
    return tries.groupBy("doc_id", "table_id", "row_id").agg(best).select("doc_id", "table_id", "row_id", "b.table_type_id", "b.canonical_leaf_id", how.alias("how"))


def resolve_columns(columns: DataFrame, members: DataFrame) -> DataFrame:
    """(doc_id, table_id, col_id, canonical_col_id, vetoed): column identities; tables that print less than half of a type's columns veto the type.

    ``columns``: doc_id, table_id, table_type_id, bank, col_id, path; ``members``: bank, table_type_id, canonical_col_id, full_path.
    Types without declared columns neither stamp nor veto.
    """
    want = members.select("bank", "table_type_id", norm_path(c("full_path")).alias("p"), "canonical_col_id").groupBy("bank", "table_type_id", "p").agg(F.min("canonical_col_id").alias("canonical_col_id"))
    size = want.groupBy("bank", "table_type_id").agg(F.count("*").alias("declared"))
    got = columns.withColumn("p", norm_path(c("path"))).join(want, ["bank", "table_type_id", "p"], "left").join(size, ["bank", "table_type_id"])
    share = got.groupBy("doc_id", "table_id", "table_type_id").agg((F.count_distinct("canonical_col_id") / F.max("declared")).alias("share"))
    return got.join(share, ["doc_id", "table_id", "table_type_id"]).select("doc_id", "table_id", "table_type_id", "col_id", F.when(c("share") >= VETO_SHARE, c("canonical_col_id")).alias("canonical_col_id"), (c("share") < VETO_SHARE).alias("vetoed"))


def exhibit_type(tables: DataFrame, registry: DataFrame) -> DataFrame:
    """(doc_id, table_id, table_type_id): types by caption; section and title together beat the section, that the title; a bank's entry beats ``*`` at its level.

    ``tables``: doc_id, table_id, bank, section, title; ``registry``: bank, alias, table_type_id (aliases in key form).
    """
    s, t = label_key(c("section")), label_key(c("title"))
    asks = tables.select("doc_id", "table_id", "bank", F.posexplode(F.array(F.concat(s, F.lit("::"), t), s, t)).alias("level", "alias")).where("alias is not null and alias <> ''")
    named = asks.join(registry.withColumnRenamed("bank", "of"), "alias").where((c("of") == c("bank")) | (c("of") == "*"))
    return named.groupBy("doc_id", "table_id").agg(F.min_by("table_type_id", F.struct("level", c("of") == "*", "table_type_id")).alias("table_type_id"))


def unknown_stamps(stamped: DataFrame, master: DataFrame) -> DataFrame:
    """Stamped identities that the list does not have: must be empty."""
    return stamped.where("canonical_leaf_id is not null").join(master.select("canonical_leaf_id").distinct(), "canonical_leaf_id", "left_anti")
