"""Column expressions that read units: which unit a cell, label, heading or title states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import FOOTNOTE, lookup, plain, squeeze

#: Spellings of scales and plain units, blanks, quotes and brackets left out. Fixed values.
_SCALES = {
    "thousand": ("k", "000", "000s", "thousand", "thousands", "thou"),
    "million": ("m", "mn", "mil", "mio", "million", "millions"),
    "billion": ("b", "bn", "bil", "billion", "billions"),
}
_MONEY = ("s$", "sgd", "us$", "$", "dollar", "dollars")
_PEOPLE = ("person", "persons", "fte", "ftes", "headcount", "staff", "people", "employees")
_PLAIN = {
    "percent": ("percent", "pct", "%", "percentage"),
    "bp": ("basispoint", "basispoints", "bp", "bps"),
    "fraction": ("fraction", "decimal", "asadecimal", "proportion"),
    "day": ("day", "days", "d"),
    "week": ("week", "weeks", "wk", "wks"),
    "hour": ("hour", "hours", "hr", "hrs", "h"),
    "person": _PEOPLE,
    "multiple": ("x", "times"),
}
#: Factor that takes a value to the common unit of its kind: S$ million, per cent, days, persons. Fixed values.
UNITS = {"percent": 1.0, "bp": 0.01, "fraction": 100.0, "day": 1.0, "week": 7.0, "hour": 1 / 24, "person": 1.0, "thousand_persons": 1000.0, "multiple": 1.0, "dollar": 1e-6, "thousand": 1e-3, "million": 1.0, "billion": 1e3}
KINDS = {"percent": "ratio", "bp": "ratio", "fraction": "ratio", "day": "duration", "week": "duration", "hour": "duration", "person": "staff", "thousand_persons": "staff", "multiple": "multiple", "dollar": "amount", "thousand": "amount", "million": "amount", "billion": "amount"}

#: Code by spelling, built by rule: plain units; money; money with a scale on either side; thousands of people.
SPELLINGS: dict[str, str] = {w: code for code, words in _PLAIN.items() for w in words}
SPELLINGS |= {f"{whole}{m}": "dollar" for m in _MONEY for whole in ("", "whole")}
SPELLINGS |= {x: code for code, words in _SCALES.items() for w in words for m in _MONEY for x in (f"{m}{w}", f"{w}{m}", f"{w}of{m}")}
SPELLINGS |= {f"{w}{p}": "thousand_persons" for w in _SCALES["thousand"] for p in _PEOPLE}
#: Beside a number a scale may stand alone; then it is one of money.
CELL_SPELLINGS = SPELLINGS | {w: code for code, words in _SCALES.items() for w in words}

_NUMBER = r"\d[\d,]*(?:\.\d+)?|\.\d+"
_CURRENCY = r"s\$|sgd|us\$|\$"
#: Any text that may be a unit phrase; the spelling table decides.
_WORDS = r"(?:as\s+a\s+|whole\s+)?(?:thousands?|millions?|billions?|basis|per|'?000s?|(?:s|us)?\$|sgd)?(?:\s*of)?\s*[a-z$%'0]*(?:\(s\))?"
_TAIL = rf"(?:{FOOTNOTE})*\s*$"


def _coded(spelling: Column, table: dict[str, str]) -> Column:
    """The code of a spelling; most texts have none and skip the table, being null or empty."""
    return lookup(table, F.nullif(spelling, F.lit("")))


def _bare(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"^\(?in\s+|[\s'’()\[\]]+", "")


def unit_code(c: Column) -> Column:
    """Code of the unit that a unit field names, or null."""
    return _coded(_bare(plain(c)), SPELLINGS)


def _ending(c: Column, lead: str) -> Column:
    hit = F.regexp_extract(squeeze(plain(c)), rf"(?i)(?:{lead})({_WORDS})\s*[)\]]?{_TAIL}", 1)
    return _coded(_bare(hit), SPELLINGS)


def _may(c: Column, marks: str) -> Column:
    """Whether a text has one of the marks a unit needs, or a character that may be such a mark in another form."""
    return c.rlike(rf"{marks}|[^\x20-\x7e]")


def unit_of_label(c: Column) -> Column:
    """Unit at the end of a row label ("Credit cost, bps", "Branch staff (FTE) ²") or a title.

    A unit counts only behind a comma, a dash, an opening bracket or the word "in"; so a rate in an
    item's name ("4.1% perpetual notes") or a plain last word ("... within one year") states none.
    """
    return F.when(_may(c, r"[,(\[-]|(?i: in )"), _ending(c, r"(?:,|[(\[]|\s[-–—])\s*(?:in\s+)?|\sin\s+"))


def unit_of_heading(c: Column) -> Column:
    """Unit at the end of a column heading, where a blank alone may come before it ("4Q19 S$m", "+/(-) %")."""
    return _ending(c, r"^|(?:,|[(\[]|\s[-–—]|\s)\s*(?:in\s+)?")


def unit_of_cell(c: Column) -> Column:
    """Unit printed beside the number itself ("S$80.6bn", "18.97 per cent", "0.34 weeks"), or null."""
    t = F.regexp_replace(F.lower(squeeze(plain(c))), rf"(?i){FOOTNOTE}+\s*$", "")
    parts = rf"^[-(–—]*\s*({_CURRENCY})?\s*[-(–—]?\s*(?:{_NUMBER})\s*\)?\s*([a-z%$' ]*?(?:\(s\))?)\s*\)?$"
    unit = F.regexp_extract(F.regexp_replace(t, parts, "$1$2"), r"^(?:[a-z%$ ']|'?000)[a-z%$ '()]*$", 0)
    return F.when(_may(c, "[A-Za-z%$']"), _coded(_bare(unit), CELL_SPELLINGS))


def factor(code: Column) -> Column:
    """What a value in that unit is multiplied by to come out in the common unit of its kind."""
    return lookup(UNITS, code)


def kind(code: Column) -> Column:
    """amount, ratio, duration, staff or multiple."""
    return lookup(KINDS, code)


def stated_unit(cell: str = "value_raw", row_unit: str = "row_unit", row_label: str = "row_leaf_label", col_unit: str = "col_unit", col_label: str = "col_leaf_label", table_unit: str = "table_unit", table_title: str = "table_title") -> Column:
    """Code of the unit that counts: the cell's own, the row's if per cent, the column's, the row's, the table's.

    Row, column and table state a unit in their unit field or, where that is null, in their label or title. A place is
    read only if none before it states a unit, the row once.
    """
    c = F.col
    row = F.when(c(row_unit).isNotNull(), unit_code(c(row_unit))).otherwise(unit_of_label(c(row_label)))
    col = F.when(c(col_unit).isNotNull(), unit_code(c(col_unit))).otherwise(unit_of_heading(c(col_label)))
    whole = F.when(c(table_unit).isNotNull(), unit_code(c(table_unit))).otherwise(unit_of_label(c(table_title)))
    return F.coalesce(unit_of_cell(c(cell)), F.transform(F.array(row), lambda r: F.coalesce(F.when(r == "percent", r), col, r, whole))[0])


def with_stated_unit(df: DataFrame, out: str = "unit_code", **fields: str) -> DataFrame:
    """The frame with ``stated_unit``. To filter by it, stage the frame first: a pushed-down filter reads it again for each mention."""
    return df.withColumn(out, stated_unit(**fields))
