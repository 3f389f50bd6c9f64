"""Column expressions on reporting periods: reading printed ones, labelling stored ones, spans and bases.

Reading is a small grammar over tokens. A text becomes words, figures and signs; every token has a class of one letter;
a period is the first of the sequences in ``RULES`` that the string of classes holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import lookup, plain, squeeze

MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
#: Spans that name a window, in the order columns of one closing date stand in: discrete, nine months, full year. Fixed values.
SPAN_RANK = {"1Q": 0, "2Q": 0, "3Q": 0, "4Q": 0, "1H": 0, "2H": 0, "9M": 1, "FY": 2}
#: First month of the window that a span covers, calendar year. Fixed values.
SPAN_MONTH = {"FY": 1, "1H": 1, "9M": 1, "2H": 7, "1Q": 1, "2Q": 4, "3Q": 7, "4Q": 10}
#: Spans that one view of the periods shows together, in the order of preference. Fixed values.
BASES = {"fy": ["FY"], "half": ["1H", "2H"], "quarter_cum": ["1Q", "2Q", "3Q", "9M"], "quarter": ["1Q", "2Q", "3Q", "4Q"], "as_at": ["as_at"]}
#: Words that leave a text a mere period when they stand beside one. Fixed values.
BESIDE = {"as", "at", "of", "on", "for", "the", "in", "and", "period", "year", "half", "quarter", "full", "financial", "months", "ended", "ending", "fair", "value"}
#: Units that may also stand there, as tokens. Fixed values.
UNIT_TOKENS = {"s", "$", "sgd", "m", "mn", "mil", "million", "000", "k", "b", "bn", "%"}

#: Classes of words: ordinals (o first and second, p the next two), q quarter, h half, n months, k nine, t year to date,
#: f fiscal year, y year, w what may come before "year", e ended, s the end of a printed ordinal, m a month.
CLASSES = {
    "first": "o", "second": "o", "third": "p", "fourth": "p", "q": "q", "qtr": "q", "quarter": "q", "h": "h", "half": "h",
    "month": "n", "months": "n", "mth": "n", "mths": "n", "mo": "n", "mos": "n", "m": "n", "nine": "k", "ytd": "t", "fy": "f", "year": "y",
    "full": "w", "financial": "w", "ended": "e", "st": "s", "nd": "s", "rd": "s", "th": "s",
}
CLASSES |= {month[:n]: "m" for month in MONTHS for n in range(3, len(month) + 1)}
_ORDER = {"first": 1, "second": 2, "third": 3, "fourth": 4}
#: What a window that ends on a date is called in the words before the date: by classes, the span by the date's month.
_WINDOWS = [("q", lambda month: F.concat(F.ceil(month / 3).cast("string"), F.lit("Q"))), ("[kv]n|t", lambda month: F.lit("9M")), ("h", lambda month: F.when(month <= 6, "1H").otherwise("2H")), ("wy|ye", lambda month: F.lit("FY"))]


def let(value: Column, use) -> Column:
    """``use`` of a column that is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def tokens(text: Column) -> Column:
    """Words, figures and signs of a lower-case text; an apostrophe in front of figures is dropped."""
    return F.regexp_extract_all(F.regexp_replace(text, r"['’](?=[0-9])", ""), F.lit(r"[a-z]+|[0-9]+|[^\sa-z0-9]"), 0)


def _class(token: Column) -> Column:
    """The token's class; figures: u 1 and 2, r 3 and 4, v 9, g other single ones, d two, Y a year of 19xx or 20xx, Z other four."""
    figures = F.when(token.isin("1", "2"), "u").when(token.isin("3", "4"), "r").when(token == "9", "v").when(F.length(token) == 1, "g").when(F.length(token) == 2, "d")
    figures = figures.when((F.length(token) == 4) & token.rlike("^(?:19|20)"), "Y").when(F.length(token) == 4, "Z").otherwise("x")
    signs = F.when(token.isin("-", "–", "—"), "-").when(token.isin("/", ".", ":", "|"), token).otherwise("x")
    return F.when(token.rlike("^[0-9]"), figures).when(token.rlike("^[a-z]"), F.coalesce(lookup(CLASSES, token), F.lit("x"))).otherwise(signs)


def _number(token: Column) -> Column:
    return F.coalesce(lookup(_ORDER, token), token.try_cast("int"))


def _year(token: Column) -> Column:
    return F.when(F.length(token) == 2, token.try_cast("int") + 2000).otherwise(token.try_cast("int"))


def _month(token: Column) -> Column:
    return lookup({m[:3]: i for i, m in enumerate(MONTHS, 1)}, F.substring(token, 1, 3))


def _closing(year: Column, month: Column) -> Column:
    """Last day of a month, null if there is no such month."""
    return F.last_day(F.try_make_timestamp(year, month, F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date"))


def _dated(day: Column, month: Column, year: Column) -> Column:
    return F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)).cast("date")


#: (classes, end, span) in the order in which they are tried; ``at(i)`` is the match's i-th token (-1 the last), ``before`` the
#: classes in front of it. Behind a dash or colon at a caption's end a year may stand alone, in a column heading anywhere.
_ANY_YEAR = "[YZd]"
RULES = [
    ("[urvgd]m[YZ]", lambda at: _dated(at(0).try_cast("int"), _month(at(1)), _year(at(2))), None),
    (rf"(?:us?|o)h\.?{_ANY_YEAR}", lambda at: _closing(_year(at(-1)), 6 * _number(at(0))), lambda at: F.concat(_number(at(0)).cast("string"), F.lit("H"))),
    (rf"(?:[ur]s?|[op])q\.?{_ANY_YEAR}", lambda at: _closing(_year(at(-1)), 3 * _number(at(0))), lambda at: F.concat(_number(at(0)).cast("string"), F.lit("Q"))),
    (rf"q[ur]{_ANY_YEAR}", lambda at: _closing(_year(at(-1)), 3 * _number(at(1))), lambda at: F.concat(at(1), F.lit("Q"))),
    (rf"hu{_ANY_YEAR}", lambda at: _closing(_year(at(-1)), 6 * _number(at(1))), lambda at: F.concat(at(1), F.lit("H"))),
    (rf"(?:[kv]n|t){_ANY_YEAR}", lambda at: _closing(_year(at(-1)), F.lit(9)), lambda at: F.lit("9M")),
    (rf"(?:f|w?y){_ANY_YEAR}", lambda at: _closing(_year(at(-1)), F.lit(12)), lambda at: F.lit("FY")),
]
IN_COLUMNS = [
    (rf"m[-/]?{_ANY_YEAR}", lambda at: _closing(_year(at(-1)), _month(at(0))), lambda at: F.lit("as_at")),
    ("[YZ]", lambda at: _closing(_year(at(0)), F.lit(12)), lambda at: F.lit("FY")),
]
IN_CAPTIONS = [("[-:|]Y$", lambda at: _closing(_year(at(1)), F.lit(12)), lambda at: F.lit("FY"))]


def read_period(c: Column, column: bool = False) -> Column:
    """struct(end, span, start, rest) of the first period a text states, or null.

    Tried in order: a date with its month written out, half, quarter ("2Q25", "Q2 2025"), nine months, year; in column headings also
    month and year, and a bare year; elsewhere a year that is the whole caption behind the last dash. A date is a
    point in time (as_at) unless the words before it name a window that ends there. ``rest`` has the tokens beside it.
    """
    t = F.lower(plain(c))
    if column:
        t = F.regexp_replace(t, r"[¹²³⁰-⁹]+|\s*\((?:\d+|[a-z])\)", "")
    found = let(tokens(t), lambda words: let(F.array_join(F.transform(words, _class), ""), lambda code: _first(words, code, RULES + (IN_COLUMNS if column else IN_CAPTIONS))))
    found = F.when(c.rlike(r"[0-9\uff10-\uff19]"), found)  # every rule has figures in it
    return let(found, lambda m: F.when(m.isNotNull(), F.struct(m["end"].alias("end"), m["span"].alias("span"), span_start(m["span"], m["end"]).alias("start"), m["rest"].alias("rest"))))


def _first(words: Column, code: Column, rules: list) -> Column:
    def made(pattern: str, end, span) -> Column:
        place, size = F.regexp_instr(code, F.lit(pattern)) - 1, F.length(F.regexp_extract(code, pattern, 0))
        at = lambda i: F.get(words, place + (i if i >= 0 else size + i))
        named = span(at) if span else _window(F.substring(code, F.lit(1), place), _month(at(1)))
        rest = F.concat(F.slice(words, F.lit(1), place), F.slice(words, place + size + 1, F.size(words)))
        return F.when(code.rlike(pattern), F.struct(end(at).alias("end"), named.alias("span"), F.array_join(rest, " ").alias("rest")))

    return F.coalesce(*[made(*rule) for rule in rules])


def _window(before: Column, month: Column) -> Column:
    out = F.lit("as_at")
    for classes, span in reversed(_WINDOWS):
        out = F.when(before.rlike(classes), span(month)).otherwise(out)
    return out


def mere_period(rest: Column, units: bool = False) -> Column:
    """Whether a text is nothing but its period, by what read_period leaves of it; null stays null."""
    words = sorted(BESIDE | (UNIT_TOKENS if units else set()))
    return F.forall(F.split(rest, " "), lambda w: w.isin(*words) | ~w.rlike("[a-z0-9$%]"))


def span_start(span: Column, end: Column) -> Column:
    """First day of the window that a span ending at ``end`` covers; null for points in time."""
    months = F.create_map(*[F.lit(x) for item in SPAN_MONTH.items() for x in item])
    return F.when(months[span].isNotNull(), F.make_date(F.year(end), months[span], F.lit(1)))


def is_flow(span: Column) -> Column:
    """Whether the span names a window."""
    return F.coalesce(F.trim(span).isin(list(SPAN_RANK)), F.lit(False))


def span_rank(span: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for item in SPAN_RANK.items() for x in item])
    return F.coalesce(ranks[F.trim(span)], F.lit(3))


def period_label(period: Column, span: Column) -> Column:
    """"1H26" for windows, "31-Dec-25" for points in time and unknown spans, "" without a period."""
    dated = F.date_format(period, "dd-MMM-yy")
    return F.coalesce(F.when(is_flow(span), F.concat(F.trim(span), F.date_format(period, "yy"))).otherwise(dated), F.lit(""))


def clamp_year(label: Column, end: Column, span: Column, reported: Column) -> Column:
    """struct(end, span): a heading of a mere year that is not over when the report closes stands for the year so far."""
    ahead = F.coalesce((F.length(F.trim(label)) == 4) & F.trim(label).try_cast("int").isNotNull() & (end > reported), F.lit(False))
    quarters = F.when((reported == F.last_day(reported)) & (F.month(reported) % 3 == 0), (F.month(reported) / 3).cast("int"))
    so_far = F.coalesce(F.get(F.array(*[F.lit(x) for x in ("1Q", "1H", "9M", "FY")]), quarters - 1), span)
    return F.struct(F.when(ahead, reported).otherwise(end).alias("end"), F.when(ahead, so_far).otherwise(span).alias("span"))
