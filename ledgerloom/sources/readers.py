"""Sources: extraction units as JSON, tables of contents, tolerant CSV lists, HTML tables, artefact roots."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.nested import flatten

c = F.col
TOC = "sections array<struct<id:string, title:string, page:int, level:int, parent_id:string>>"
META = "document string, bank string, doc_date string, unit_id string, section_ids array<string>, section_titles array<string>, pages array<int>, type string, n_tables int, n_rows int"
GEOMETRY = "geometry struct<source:string, tables:array<struct<rows:array<struct<line_id:int, indent:double, label_clean:string>>, title_clean:string, col_labels_clean:array<string>, all_rows_matched:boolean>>>"


def read_units(spark: SparkSession, path: str) -> DataFrame:
    """(unit_id, path, payload): one row a parsed.json, the unit named by its folder; cells may be plain strings in old files."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="parsed.json").select(F.col("_metadata.file_path").alias("path"), c("value").alias("payload"))
    return files.withColumn("unit_id", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)).select("unit_id", "path", "payload")


def units_from_audit(spark: SparkSession, path: str) -> DataFrame:
    """Units fit to be rebuilt: both files, a section, readable JSON and at least one table; in order of their names."""
    units = read_units(spark, path)
    flat = flatten(units.select("unit_id", "payload"))
    filled = flat.where("rel = 'table'").groupBy("unit_id").agg(F.count("*").alias("tables"))
    meta = spark.read.schema(META).json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="meta.json").withColumn("unit_id", F.regexp_extract(c("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    meta = meta.where(F.size("section_ids") > 0).select("unit_id", "document", F.element_at("section_ids", 1).alias("section_id"), "pages")
    return units.join(filled, "unit_id").join(meta, "unit_id").orderBy("unit_id")


def read_geometry(spark: SparkSession, path: str) -> DataFrame:
    """(unit_id, table_no, row_no, line_id, indent, label_clean) of the side-car; units without one give no rows."""
    raw = spark.read.schema(GEOMETRY).json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="parsed.json").withColumn("unit_id", F.regexp_extract(c("_metadata.file_path"), r"([^/]+)/[^/]+$", 1))
    tables = raw.select("unit_id", F.posexplode("geometry.tables").alias("table_no", "t"))
    return tables.select("unit_id", "table_no", F.posexplode("t.rows").alias("row_no", "r")).select("unit_id", "table_no", "row_no", "r.*")


def read_toc(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, section_id, section_title, page, section_level, parent_section, seq) from JSON tables of contents."""
    raw = spark.read.schema(TOC).json(path, multiLine=True, recursiveFileLookup=True, pathGlobFilter="*.json").withColumn("doc_id", F.regexp_extract(c("_metadata.file_path"), r"([^/]+)\.json$", 1))
    return raw.select("doc_id", F.posexplode("sections").alias("at", "s")).select("doc_id", c("s.id").alias("section_id"), c("s.title").alias("section_title"), c("s.page").alias("page"), c("s.level").alias("section_level"), c("s.parent_id").alias("parent_section"), (c("at") + 1).alias("seq"))


def read_list(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A curated CSV list: byte order mark and leading blank lines passed over, the first other line is the heading.

    Only ``columns`` come out, in that order, with ``file`` and ``line``; a column the file lacks is null.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import csv
        import io

        for pdf in frames:
            out = []
            for name, text in zip(pdf["file"], pdf["value"]):
                reader = csv.DictReader(io.StringIO((text or "").lstrip("\ufeff \t\r\n")))
                for line, row in enumerate(reader, 1):
                    if any(isinstance(v, str) and v.strip() for v in row.values()):
                        row = {str(k).strip(): v for k, v in row.items() if k}
                        out.append((name, line, *[(row.get(x) or "").strip() or None for x in columns]))
            yield pd.DataFrame(out, columns=["file", "line", *columns])

    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("line", T.IntegerType()), *[T.StructField(x, T.StringType()) for x in columns]])
    files = spark.read.text(path, wholetext=True).select(c("_metadata.file_path").alias("file"), "value")
    return files.mapInPandas(run, schema)


ANCHOR_COLUMNS = ["bank", "concept", "section", "row_order", "table_type_id", "canonical_leaf_id", "sign", "canonical_col_id", "row_dim_key", "filter_by"]
#: What the files of an anchor set are called behind its name: plain anchors, and members of sums. Fixed values.
ANCHOR_FILES = ("_anchors.csv", "_formulaanchors.csv")


def _anchor_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all anchor files under ``path``, with the set they belong to and whether they are of its formula file."""
    found = None
    for formula, suffix in enumerate(ANCHOR_FILES):
        lines = read_list(spark, f"{path}/*{suffix}", ANCHOR_COLUMNS) if _any(spark, f"{path}/*{suffix}") else None
        if lines is not None:
            name = F.regexp_extract("file", rf"([^/]+){suffix}$", 1)
            lines = lines.select(*ANCHOR_COLUMNS, name.alias("anchor_set"), F.lit(bool(formula)).alias("formula"), "line")
            found = lines if found is None else found.unionByName(lines)
    if found is None:
        kinds = ", ".join(f"{x} string" for x in ANCHOR_COLUMNS)
        found = spark.createDataFrame([], f"{kinds}, anchor_set string, formula boolean, line int")
    return found


def _any(spark: SparkSession, pattern: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at))


def read_anchors(spark: SparkSession, path: str, anchor_set: str | None = None) -> DataFrame:
    """Anchors as compose_items reads them, and their place in the grid; of one set, as sets are never mixed, or of all.

    Columns: anchor_set, bank, concept, section, row_order, table_type_id, canonical_leaf_id, sign, member_ordinal,
    canonical_col_id, row_dim_key, filter_by. The plain file's members come before the formula file's; a line without a bank or
    concept is none; a missing sign is 1; the first row order and the first section of a concept hold for all its members.
    """
    rows = _anchor_lines(spark, path).where("bank is not null and concept is not null")
    if anchor_set is not None:
        rows = rows.where(c("anchor_set") == anchor_set)
    one = ["anchor_set", "bank", "concept"]
    order = W.partitionBy(*one).orderBy("formula", "line")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return rows.select(
        *one, F.first("section", True).over(whole).alias("section"), F.first(c("row_order").try_cast("int"), True).over(whole).alias("row_order"), "table_type_id", "canonical_leaf_id",
        F.coalesce(c("sign").try_cast("int"), F.lit(1)).alias("sign"), F.row_number().over(order).alias("member_ordinal"), "canonical_col_id", "row_dim_key", "filter_by",
    )


def anchor_sets(spark: SparkSession, path: str) -> DataFrame:
    """(anchor_set, anchors, members, orphan): the sets there are; a formula file without its plain one is an orphan."""
    lines = _anchor_lines(spark, path)
    sums = lines.groupBy("anchor_set").agg(F.count(F.when(~c("formula"), 1)).alias("anchors"), F.count(F.when(c("formula"), 1)).alias("members"))
    return sums.withColumn("orphan", (c("anchors") == 0) & (c("members") > 0))


def anchor_declarations(spark: SparkSession, path: str) -> DataFrame:
    """(bank, table_type_id, canonical_leaf_id, anchor_set, concept): every declared address once, as first declared by set, file and line."""
    rows = _anchor_lines(spark, path).where("bank is not null and table_type_id is not null and canonical_leaf_id is not null")
    first = F.min(F.struct("anchor_set", "formula", "line", "concept")).alias("f")
    return rows.groupBy("bank", "table_type_id", "canonical_leaf_id").agg(first).select("bank", "table_type_id", "canonical_leaf_id", "f.anchor_set", "f.concept")


def rebuildable(sections: DataFrame, units: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(doc_id): filings with a table of contents and cached units, of those whose id contains any of ``names``."""
    found = sections.select("doc_id").distinct().join(units.select("doc_id").distinct(), "doc_id", "left_semi")
    for i, name in enumerate(names or []):
        hit = F.lower("doc_id").contains(name.lower())
        wanted = hit if i == 0 else wanted | hit
    return found.where(wanted) if names else found


def richest_root(roots: DataFrame) -> DataFrame:
    """Of several artefact roots of a document (doc_id, path, n_geometry, n_units) the richest."""
    order = W.partitionBy("doc_id").orderBy(c("n_geometry").desc(), c("n_units").desc(), "path")
    return roots.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")


class _Tables(HTMLParser):
    """Cells of all tables of a page, spans laid out on the grid."""

    def __init__(self):
        super().__init__()
        self.rows: list[tuple[int, int, int, str, bool, str | None, str | None]] = []
        self.depth, self.table, self.row, self.col = 0, -1, -1, 0
        self.taken: dict[tuple[int, int], bool] = {}
        self.cell: dict | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self._close()
            self.depth += 1
            self.table, self.row, self.taken = self.table + 1, -1, {}
        elif tag == "tr" and self.depth:
            self._close()
            self.row, self.col = self.row + 1, 0
        elif tag in ("td", "th") and self.depth:
            self._close()
            span = lambda k: max(1, min(1000, int(a[k]))) if (a.get(k) or "").isdigit() else 1
            self.cell = {"text": [], "head": tag == "th", "w": span("colspan"), "h": span("rowspan"), "kind": a.get("data-kind"), "sign": a.get("data-sign")}

    def handle_data(self, data):
        if self.cell is not None:
            self.cell["text"].append(data)

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self._close()
        if tag == "table":
            self.depth = max(0, self.depth - 1)

    def _close(self):
        if self.cell is None:
            return
        cell, self.cell = self.cell, None
        while (self.row, self.col) in self.taken:
            self.col += 1
        text = " ".join("".join(cell["text"]).split())
        for y in range(cell["h"]):
            for x in range(cell["w"]):
                self.taken[self.row + y, self.col + x] = True
                self.rows.append((self.table, self.row + y, self.col + x, text, cell["head"], cell["kind"], cell["sign"]))
        self.col += cell["w"]


def html_tables(pages: DataFrame) -> DataFrame:
    """(page_id, table_no, row_no, col_no, text, is_head, kind, sign): the cells of all HTML tables, spanned ones at each place they cover.

    Input (page_id, html). Pages without tables and null pages give no rows; broken markup is read as far as it goes.
    """
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for page, html in zip(pdf["page_id"], pdf["html"]):
                if isinstance(html, str) and "<table" in html.lower():
                    parser = _Tables()
                    parser.feed(html)
                    parser.close()
                    out += [(page, *r) for r in parser.rows]
            yield pd.DataFrame(out, columns=["page_id", "table_no", "row_no", "col_no", "text", "is_head", "kind", "sign"])

    return pages.select("page_id", "html").mapInPandas(run, f"page_id {kind}, table_no int, row_no int, col_no int, text string, is_head boolean, kind string, sign string")
