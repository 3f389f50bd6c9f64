"""Column expressions on printed cell values: state, number, page ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import plain

#: A printed number: digits with grouping commas, a sign or brackets, per cent or dollar signs around it. Fixed value.
NUMBER = r"^\(*\s*(?:S\$)?\s*[-+]?(?:S\$)?(?:\d[\d,]*\.?\d*|\.\d+)(?:[eE][-+]?\d+)?\s*%?\s*\)*$"


def cell_state(raw: Column) -> Column:
    """empty, null (a dash), suppressed (#), zero (exactly 0) or reported."""
    t = F.trim(F.coalesce(raw, F.lit("")))
    return F.when(t == "", "empty").when(t.isin("-", "–", "—"), "null").when(t == "#", "suppressed").when(t == "0", "zero").otherwise("reported")


def cell_number(raw: Column) -> Column:
    """The number of a reported or zero cell, brackets negative; null where the text is no plain number ("12d", "nan", "AAA")."""
    t = F.trim(raw)
    bare = F.regexp_replace(t, r"[(),%\s]|S\$", "")
    number = F.when(t.rlike(NUMBER), bare.try_cast("double"))
    return F.when(t.startswith("(") & t.endswith(")"), -number).otherwise(number)


def page_token(text: Column) -> Column:
    """A number as printed on a page, currency signs, footnote marks and brackets off; null for other words."""
    t = F.regexp_replace(F.regexp_replace(plain(text), r"[¹²³⁰-⁹*†‡^]+", ""), r"^(\(?)(?:S\$|US\$|\$|RM|HK\$)", "$1")
    return cell_number(t)


def expand_pages(ranges: Column) -> Column:
    """"3,5-7" as a sorted array of pages, of at most six digits; turned ranges are read the right way, other words skipped."""
    parts = F.transform(F.split(F.regexp_replace(ranges, r"[–—]", "-"), ","), lambda x: F.trim(x))
    good = F.filter(parts, lambda x: x.rlike(r"^\d{1,6}(\s*-\s*\d{1,6})?$"))
    ends = F.transform(good, lambda x: F.transform(F.split(x, "-"), lambda y: F.trim(y).cast("int")))
    return F.array_sort(F.array_distinct(F.flatten(F.transform(ends, lambda e: F.sequence(F.array_min(e), F.array_max(e))))))
