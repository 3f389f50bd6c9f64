"""Column expressions on text: plain form, footnotes, slugs, label keys. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that cannot be seen. Fixed values.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u200e\u200f\u2060\ufeff"
#: Spaces other than U+0020. Fixed values.
SPACES = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
#: Hyphens that stand for "-". Fixed values.
HYPHENS = "\u2010\u2011\u2212\ufe63"
#: The full-width block maps onto ASCII by a constant offset.
WIDE = "".join(chr(0xFF01 + i) for i in range(94))
NARROW = "".join(chr(0x21 + i) for i in range(94))

#: A footnote mark at the end of a label: (1), (note 7), /a, a raised figure, a star, "– restated".
FOOTNOTE = r"(?:\s*(?:\((?:note\s*\d{1,3}|\d{1,2}|[a-c]|restated|unaudited|continued|cont'd)\)|/[a-z0-9]\b|[¹²³⁰-⁹*†‡]|[–—-]\s+(?:restated|see\s+note(?:\s+\d+)?)))"


def lookup(table: dict[str, str | float | int], key: Column) -> Column:
    """The table's entry for a key, null without one; the table is one literal, parsed once."""
    quoted = lambda x: "'" + x.replace("'", "\\'") + "'" if isinstance(x, str) else f"{x!r}D" if isinstance(x, float) else str(x)
    return F.expr("map(" + ", ".join(f"{quoted(k)}, {quoted(v)}" for k, v in table.items()) + ")")[key]


def plain(c: Column) -> Column:
    """Text with full-width forms narrowed, odd spaces and hyphens plain, invisible characters gone, ends trimmed."""
    there = WIDE + SPACES + HYPHENS
    here = NARROW + " " * len(SPACES) + "-" * len(HYPHENS)
    return F.trim(F.translate(c, there + INVISIBLE, here))


def squeeze(c: Column) -> Column:
    """White space runs as one blank, ends trimmed."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def strip_footnotes(c: Column) -> Column:
    """The label without the footnote marks at its end, however many; a label of marks only stays."""
    bare = F.trim(F.regexp_replace(c, "(?i)" + FOOTNOTE + r"+\s*$", ""))
    return F.when(bare == "", F.trim(c)).otherwise(bare)


def slug(c: Column) -> Column:
    """Lower-case letters and digits joined by underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def label_key(c: Column) -> Column:
    """The key labels are compared by: plain, lower case, footnotes gone, one blank between words."""
    return F.lower(squeeze(strip_footnotes(plain(c))))


def no_value(c: Column) -> Column:
    """Text, with empty and blank text as null."""
    return F.when(F.trim(c) == "", None).otherwise(c)
