"""Column expressions on labels, captions and document names: identity segments, leaf ids, families, safe cleanings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.periods import let, mere_period, read_period
from ledgerloom.functions.text import plain, strip_footnotes

#: Words of a filing's name that do not tell its kind: small words, and how it was prepared. Fixed values.
SMALL_WORDS = ["and", "for", "of", "the"]
PREPARED = ["audited", "condensed", "interim", "report", "unaudited"]
#: Figures raised above the line, which only ever number footnotes.
RAISED = "⁰¹²³⁴⁵⁶⁷⁸⁹"
_STRINGS = "array<string>"


def _words(text: Column) -> Column:
    """Runs of letters and figures of any script, lower case; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(?U)[\p{Alnum}\p{M}]+"), 0)


def segment(label: Column, is_data: bool = True) -> Column:
    """A label as one part of an identity: its words joined by underscores, "&" read as "and".

    Footnote marks go, also a figure glued to the last word; of data labels a year at the end goes too, unless it is all there is.
    """
    bare = strip_footnotes(plain(F.translate(label, RAISED, "")))
    words = _words(F.replace(bare, F.lit("&"), F.lit(" and ")))

    def joined(parts: Column) -> Column:
        last = F.try_element_at(parts, F.lit(-1))
        year = (F.size(parts) > 1) & last.rlike("^(?:19|20)[0-9]{2}$") if is_data else F.lit(False)
        note = F.regexp_replace(last, r"(?<=\p{L})[0-9]{1,2}$", "")
        number = (F.size(parts) > 1) & last.rlike("^[0-9]{1,2}$")
        return F.when(F.size(parts) == 0, parts).when(year | number, F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(F.concat(F.slice(parts, F.lit(1), F.size(parts) - 1), F.array(note)))

    return F.when(label.isNotNull(), F.array_join(let(words, joined), "_"))


def _is_mark(word: Column) -> Column:
    """Whether a word says that a caption goes on from the page before."""
    return F.regexp_replace(F.lower(word), r"[^a-z]", "").isin("cont", "contd", "continued")


def _panels(caption: Column) -> Column:
    """A caption's parts between dashes, with neither its number nor marks of continuation, nor parts that are only a period."""
    words = F.filter(F.split(F.trim(caption), r"\s+"), lambda w: ~_is_mark(w) & (w != ""))
    numbered = F.get(words, F.lit(0)).rlike(r"^[0-9]+(?:\.[0-9]+)*\.?$") & (F.size(words) > 1)
    body = F.array_join(F.when(numbered, F.slice(words, F.lit(2), F.size(words))).otherwise(words), " ")
    dated = lambda part: F.coalesce(mere_period(read_period(part, True)["rest"]), F.lit(False))
    parts = F.filter(F.transform(F.split(body, r"[—–]| - "), lambda x: F.trim(x)), lambda x: x != "")
    return F.filter(parts, lambda x, i: (i == 0) | ~dated(x))


def caption_key(caption: Column) -> Column:
    """A caption as a key: the segments of its panels; numbering, marks of continuation and periods gone."""
    return segment(F.array_join(_panels(caption), " "), is_data=False)


def caption_parts(caption: Column) -> Column:
    """struct(base, breakdown): "Loans — by industry" is the exhibit Loans broken down by industry.

    The breakdown is the last panel if it is not the only one and has the word "by" in it.
    """

    def split(panels: Column) -> Column:
        last = F.try_element_at(panels, F.lit(-1))
        cut = (F.size(panels) > 1) & F.array_contains(_words(last), "by")
        base = F.when(cut, F.slice(panels, F.lit(1), F.size(panels) - 1)).otherwise(panels)
        return F.struct(F.array_join(base, " — ").alias("base"), F.when(cut, last).alias("breakdown"))

    return let(_panels(caption), split)


def caption_variants(caption: Column) -> Column:
    """What a caption may be listed under, from the fullest form to the barest, each once.

    As printed; its first line; that without marks of continuation; its panels without those that are periods; the first
    panel; the first panel without a word in front that says how the figures were prepared.
    """
    line = F.trim(F.substring_index(caption, "\n", 1))
    unmarked = F.array_join(F.filter(F.split(line, r"\s+"), lambda w: ~_is_mark(w)), " ")
    panels = _panels(line)
    first = F.coalesce(F.get(panels, F.lit(0)), F.lit(""))
    opening = F.lower(F.substring_index(first, " ", 1))
    unqualified = F.when(opening.isin(*PREPARED) & first.contains(" "), F.trim(F.regexp_replace(first, r"^\S+\s", ""))).otherwise(first)
    return F.array_distinct(F.filter(F.array(F.trim(caption), line, unmarked, F.array_join(panels, " — "), first, unqualified), lambda x: x != ""))


def leaf_id(ancestors: Column, label: Column) -> Column:
    """Identity of a row below its ancestors' segments: "::" between parts, equal neighbours once; "of which" is a part of its own."""
    memo = F.coalesce(F.slice(_words(label), 1, 2) == F.array(F.lit("of"), F.lit("which")), F.lit(False))
    item = segment(F.when(memo, F.regexp_replace(label, r"^[^:]*?\b[wW][hH][iI][cC][hH]\b\s*:?", "")).otherwise(label))
    chain = F.concat(F.coalesce(ancestors, F.array().cast(_STRINGS)), F.when(memo, F.array(F.lit("of_which"))).otherwise(F.array().cast(_STRINGS)), F.array(item))
    kept = F.filter(chain, lambda x: F.coalesce(x, F.lit("")) != "")
    return F.array_join(let(kept, lambda parts: F.filter(parts, lambda x, i: (i == 0) | (x != F.get(parts, i - 1)))), "::")


def family(name: Column) -> Column:
    """A kind of filing as a key: its words without small ones and without how it was prepared."""
    return F.array_join(F.filter(_words(F.translate(name, "_", " ")), lambda w: ~w.isin(*SMALL_WORDS, *PREPARED)), "_")


def filing_family(doc_id: Column) -> Column:
    """The kind of a filing from its id (house_period_kind): what stands behind the part that is a period; null where nothing does."""
    parts = F.split(F.lower(doc_id), "_")
    dated = F.transform(parts, lambda p: F.coalesce(p.rlike("^(?:[1-4]q|[12]h|fy|9m)[0-9]{2,4}$"), F.lit(False)))
    at = F.array_position(dated, True).cast("int")
    return F.nullif(family(F.array_join(F.slice(parts, at + 1, F.greatest(F.size(parts) - at, F.lit(0))), " ")), F.lit(""))


def safe_clean(printed: Column, cleaned: Column) -> Column:
    """The cleaned label if its letters and figures are those of the printed one in order, some left out; else the printed one."""
    bare = lambda x: F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"(?U)[^\w]|_", "")
    letters = F.filter(F.split(bare(cleaned), ""), lambda x: x != "")
    start = F.struct(bare(printed).alias("rest"), F.lit(True).alias("ok"))

    def step(acc: Column, x: Column) -> Column:
        at = F.instr(acc["rest"], x)
        return F.struct(F.when(at > 0, F.substring(acc["rest"], at + 1, F.lit(1 << 20))).otherwise("").alias("rest"), (acc["ok"] & (at > 0)).alias("ok"))

    fits = F.aggregate(letters, start, step, lambda acc: acc["ok"])
    return F.when(F.coalesce(F.trim(cleaned), F.lit("")) == "", printed).when(fits, cleaned).otherwise(printed)


def house_of(name: Column, houses: dict[str, str], other: str = "Other") -> Column:
    """The short name of an institution: the first of ``houses`` (pattern -> name) that its name contains, else ``other``."""
    out = F.lit(other)
    for pattern, short in reversed(list(houses.items())):
        out = F.when(F.lower(name).contains(pattern.lower()), F.lit(short)).otherwise(out)
    return out
