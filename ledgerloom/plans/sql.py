"""Pieces of DuckDB SQL that the oracles share: the library's text, value, unit and period rules, written once more for the other engine."""

from __future__ import annotations

from ledgerloom.functions import units as U
from ledgerloom.functions.periods import BESIDE, MONTHS, UNIT_TOKENS
from ledgerloom.functions.text import FOOTNOTE, HYPHENS, INVISIBLE, NARROW, SPACES, WIDE


def quoted(x: str) -> str:
    return x.replace("'", "''")


def plain(x: str) -> str:
    there, here = SPACES + WIDE + HYPHENS + INVISIBLE, " " * len(SPACES) + NARROW + "-" * len(HYPHENS)
    return f"trim(translate({x}, '{quoted(there)}', '{quoted(here)}'))"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def strip_footnotes(x: str) -> str:
    bare = f"trim(regexp_replace({x}, '{quoted(FOOTNOTE)}+\\s*$', '', 'i'))"
    return f"CASE WHEN {bare} = '' THEN trim({x}) ELSE {bare} END"


def label_key(x: str) -> str:
    return f"lower({squeeze(strip_footnotes(plain(x)))})"


def segments(source: str, x: str, is_data: bool = True) -> str:
    """CTEs w and g: the source with the words of a label, then with its ``segment``."""
    dropped = "(19|20)[0-9][0-9]|[0-9][0-9]?" if is_data else "[0-9][0-9]?"
    bare = strip_footnotes(plain(f"translate({x}, '⁰¹²³⁴⁵⁶⁷⁸⁹', '')"))
    words = f"regexp_extract_all(lower(replace({bare}, '&', ' and ')), '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Nl}}]+')"
    return f"""w AS (SELECT *, {words} AS words FROM {source}),
g AS (SELECT * EXCLUDE (words), CASE WHEN len(words) > 1 AND regexp_full_match(words[-1], '{dropped}') THEN array_to_string(words[:-2], '_') WHEN len(words) > 0 THEN array_to_string(list_append(words[:-2], regexp_replace(words[-1], '([\\p{{L}}])[0-9]{{1,2}}$', '\\1')), '_') ELSE '' END AS segment FROM w)"""


# --- values ---------------------------------------------------------------------------------------------------------------


def state(x: str) -> str:
    return f"CASE WHEN trim(coalesce({x}, '')) = '' THEN 'empty' WHEN trim({x}) IN ('-', '–', '—') THEN 'null' WHEN trim({x}) = '#' THEN 'suppressed' WHEN trim({x}) = '0' THEN 'zero' ELSE 'reported' END"


def number(x: str) -> str:
    form = r"\(*\s*(S\$)?\s*[-+]?(S\$)?([0-9][0-9,]*\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*%?\s*\)*"
    return f"CASE WHEN regexp_full_match(trim({x}), '{form}') THEN (CASE WHEN trim({x}) LIKE '(%)' THEN -1 ELSE 1 END) * try_cast(regexp_replace(replace({x}, 'S$', ''), '[(),%\\s]', '', 'g') AS DOUBLE) END"


# --- units: the CTEs of SPELT stand first in a query ---------------------------------------------------------------------------

SPELT = ", ".join(
    f"{name}(k, code) AS (VALUES {', '.join(f'({chr(39)}{quoted(k)}{chr(39)}, {chr(39)}{v}{chr(39)})' for k, v in table.items())})" for name, table in (("spelt", U.SPELLINGS), ("spelt_cell", U.CELL_SPELLINGS))
) + f", factors(code, factor) AS (VALUES {', '.join(f'({chr(39)}{k}{chr(39)}, {v!r}::DOUBLE)' for k, v in U.UNITS.items())})"


def _coded(x: str, table: str = "spelt") -> str:
    bare = f"regexp_replace(lower({x}), '^\\(?in\\s+|[\\s''’()\\[\\]]+', '', 'g')"
    return f"(SELECT code FROM {table} WHERE k = nullif({bare}, ''))"


def unit_code(x: str) -> str:
    return _coded(plain(x))


def _ending(x: str, lead: str) -> str:
    pattern = quoted(rf"(?i)(?:{lead})({U._WORDS})\s*[)\]]?{U._TAIL}")
    return _coded(f"regexp_extract({squeeze(plain(x))}, '{pattern}', 1)")


def unit_of_label(x: str) -> str:
    return _ending(x, r"(?:,|[(\[]|\s[-–—])\s*(?:in\s+)?|\sin\s+")


def unit_of_heading(x: str) -> str:
    return _ending(x, r"^|(?:,|[(\[]|\s[-–—]|\s)\s*(?:in\s+)?")


def unit_of_cell(x: str) -> str:
    text = f"regexp_replace(lower({squeeze(plain(x))}), '(?i){quoted(FOOTNOTE)}+\\s*$', '')"
    parts = quoted(rf"^[-(–—]*\s*({U._CURRENCY})?\s*[-(–—]?\s*(?:{U._NUMBER})\s*\)?\s*([a-z%$' ]*?(?:\(s\))?)\s*\)?$")
    only = quoted(r"^(?:[a-z%$ ']|'?000)[a-z%$ '()]*$")
    return _coded(f"regexp_extract(regexp_replace({text}, '{parts}', '\\1\\2'), '{only}')", "spelt_cell")


# --- periods -----------------------------------------------------------------------------------------------------------------

_TOKENS = r"[a-z]+|[0-9]+|[^\sa-z0-9]"
_MONTH = "(" + "|".join(m[:n] for m in MONTHS for n in range(len(m), 2, -1)) + ")"
_Y = r"'?([0-9]{4}|[0-9]{2})\b"
_DATE = rf"\b[0-9]{{1,2}}\s*{_MONTH}\s*[0-9]{{4}}\b"
_RULES = [
    ("date", _DATE), ("half", rf"\b([12]\s*(st|nd)?|first|second)\s*(half|h)\s*\.?\s*{_Y}"), ("quarter", rf"\b([1-4]\s*(st|nd|rd|th)?|first|second|third|fourth)\s*(quarter|qtr|q)\s*\.?\s*{_Y}"),
    ("quarter", rf"\bq\s*[1-4]\s*{_Y}"), ("half", rf"\bh\s*[12]\s*{_Y}"), ("nine", rf"\b((nine|9)\s*(months|month|mths|mth|mos|mo|m)|ytd)\s*{_Y}"), ("year", rf"\b(fy|((full|financial)\s*)?year)\s*{_Y}"),
]
_COLUMN = [("month", rf"\b{_MONTH}\s*[-/]?\s*{_Y}"), ("bare", r"\b[0-9]{4}\b")]
_CAPTION = [("bare", r"[—–:|-]\s*(19|20)[0-9]{2}$")]


def period(source: str, x: str, out: str, column: bool) -> str:
    """CTEs {out}0, {out}1 and {out}: the source with fin, span and rest of the period that ``x`` states."""
    text = f"lower({plain(x)})"
    if column:
        text = f"regexp_replace({text}, '[¹²³⁰-⁹]+|\\s*\\(([0-9]+|[a-z])\\)', '', 'g')"
    text = f"regexp_replace({text}, '[''’]([0-9])', '\\1', 'g')"
    rules = [(kind, quoted(p)) for kind, p in _RULES + (_COLUMN if column else _CAPTION)]
    which = " ".join(f"WHEN regexp_matches(t, '{p}') THEN {i}" for i, (_, p) in enumerate(rules))
    hit = " ".join(f"WHEN {i} THEN regexp_extract(t, '{p}')" for i, (_, p) in enumerate(rules))
    kind = " ".join(f"WHEN {i} THEN '{k}'" for i, (k, _) in enumerate(rules))
    figures = "regexp_extract(hit, '([0-9]{4}|[0-9]{2})$')"
    year = f"CASE WHEN length({figures}) = 2 THEN 2000 + {figures}::INT ELSE {figures}::INT END"
    nth = "coalesce(try_cast(nullif(regexp_extract(hit, '^[qh]?\\s*([1-4])', 1), '') AS INT), CASE left(hit, 2) WHEN 'fi' THEN 1 WHEN 'se' THEN 2 WHEN 'th' THEN 3 WHEN 'fo' THEN 4 END)"
    month = " ".join(f"WHEN '{m[:3]}' THEN {i}" for i, m in enumerate(MONTHS, 1))
    named = f"CASE left(regexp_extract(hit, '[a-z]+'), 3) {month} END"
    closing = lambda m: f"last_day(make_date({year}, {m}, 1))"
    before = "left(t, greatest(strpos(t, hit) - 1, 0))"
    dated = f"CASE WHEN regexp_matches({before}, '\\b(q|qtr|quarter)\\b') THEN ceil(mon / 3.0)::INT || 'Q' WHEN regexp_matches({before}, '\\b(nine|9)\\s*(months?|mths?|mos?|m)\\b|\\bytd\\b') THEN '9M' WHEN regexp_matches({before}, '\\b(half|h)\\b') THEN CASE WHEN mon <= 6 THEN '1H' ELSE '2H' END WHEN regexp_matches({before}, '\\b(full|financial)\\s+year\\b|\\byear\\s+ended\\b') THEN 'FY' ELSE 'as_at' END"
    return f"""{out}0 AS (SELECT *, {text} AS t FROM {source}), {out}1 AS (SELECT *, CASE {which} END AS rule FROM {out}0), {out}2 AS (SELECT *, CASE rule {hit} END AS hit, CASE rule {kind} END AS kind FROM {out}1),
{out}3 AS (SELECT *, CASE WHEN kind IN ('date', 'month') THEN {named} END AS mon, CASE WHEN kind IN ('half', 'quarter') THEN {nth} END AS nth FROM {out}2),
{out} AS (SELECT * EXCLUDE (t, rule, hit, kind, mon, nth), CASE kind WHEN 'date' THEN try_cast({year} || '-' || mon || '-' || regexp_extract(hit, '^[0-9]+') AS DATE) WHEN 'half' THEN {closing("6 * nth")} WHEN 'quarter' THEN {closing("3 * nth")} WHEN 'nine' THEN {closing("9")} WHEN 'month' THEN {closing("mon")} WHEN 'year' THEN {closing("12")} WHEN 'bare' THEN {closing("12")} END AS fin,
 CASE kind WHEN 'date' THEN {dated} WHEN 'half' THEN nth || 'H' WHEN 'quarter' THEN nth || 'Q' WHEN 'nine' THEN '9M' WHEN 'month' THEN 'as_at' WHEN 'year' THEN 'FY' WHEN 'bare' THEN 'FY' END AS span,
 CASE WHEN hit IS NOT NULL THEN array_to_string(list_concat(regexp_extract_all({before}, '{_TOKENS}'), regexp_extract_all(substr(t, strpos(t, hit) + length(hit)), '{_TOKENS}')), ' ') END AS rest FROM {out}3)"""


def mere_period(rest: str, units: bool = False) -> str:
    words = ", ".join(f"'{w}'" for w in sorted(BESIDE | (UNIT_TOKENS if units else set())))
    return f"coalesce(len(list_filter(string_split({rest}, ' '), lambda w: NOT (w IN ({words}) OR NOT regexp_matches(w, '[a-z0-9$%]')))) = 0, false)"


def starts(span: str, fin: str) -> str:
    return f"CASE WHEN {span} IN ('FY', '1H', '9M', '1Q') THEN make_date(year({fin}), 1, 1) WHEN {span} IN ('2H', '3Q') THEN make_date(year({fin}), 7, 1) WHEN {span} = '2Q' THEN make_date(year({fin}), 4, 1) WHEN {span} = '4Q' THEN make_date(year({fin}), 10, 1) END"


def clamped(label: str, fin: str, span: str, reported: str) -> tuple[str, str]:
    """End and span of clamp_year."""
    ahead = f"coalesce(regexp_full_match(trim({label}), '[0-9]{{4}}') AND {fin} > {reported}, false)"
    so_far = f"coalesce(CASE WHEN {reported} = last_day({reported}) THEN CASE month({reported}) WHEN 3 THEN '1Q' WHEN 6 THEN '1H' WHEN 9 THEN '9M' WHEN 12 THEN 'FY' END END, {span})"
    return f"CASE WHEN {ahead} THEN {reported} ELSE {fin} END", f"CASE WHEN {ahead} THEN {so_far} ELSE {span} END"
