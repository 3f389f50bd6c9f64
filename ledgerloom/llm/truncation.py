"""Texts cut off before their end, found as strict prefixes of longer copies, sentence by sentence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.runtime import stage

#: Where a text is cut into sentences and lines; blanks around them go afterwards.
BREAK = r"(?<=[.!?。！？])(?:\s+|(?<=[。！？]))|\n"
BLANKS = " \t\n\x0b\f\r"
#: The patterns below are of texts read from their end, so that they look at a whole text and cost only what stands there.
#: What a cut leaves behind at the end of a text: an ellipsis; half a character, an opened bracket or tag. Fixed values.
ELLIPSIS = r"^\s*+(?:\.\.\.|…|\]\.\.\.\[|\]…\[)"
BROKEN = r"^\s*+[�<\[{&\\]++"
#: A closing stop that ends a text; one behind a figure may also be a decimal point and is looked at closely.
STOPPED = r"^\s*+[\"')”’»\]）]*+(?:\.(?![\d.])|[!?。！？])"
#: The last sentence: up to the first place that is one of BREAK.
LAST = r"^[\s\S]+?(?=\s+[.!?。！？]|\s*\n|[。！？]|\z)"
#: What is left out at the end of sentences.
STOPS = BLANKS + ".!?。！？…"
#: Lengths by which strings are put next to their possible prefixes; shorter tails are looked up directly.
LEVELS = (12, 24, 48, 96, 192, 384, 768, 1536)


def mask(c: Column) -> Column:
    """Figures as 0, stops at the end gone: the form in which sentences are compared."""
    return F.rtrim(F.regexp_replace(F.btrim(c, F.lit(BLANKS)), r"\d[\d.,]*", "0"), F.lit(STOPS))


def last_word(c: Column) -> Column:
    """The last word and whatever blanks follow it."""
    return F.reverse(F.regexp_extract(F.reverse(c), r"^\s*+\S*+", 0))


def shape(c: Column) -> Column:
    """The same behind a tab stop, but in the last word every digit is a 0 of its own, so that a cut figure is shorter than a whole one."""
    last = last_word(c)
    body = F.substring(c, F.lit(1), F.length(c) - F.length(last))
    return F.concat(F.lit("\t"), F.regexp_replace(body, r"\d[\d.,]*", "0"), F.rtrim(F.regexp_replace(last, r"\d", "0"), F.lit(STOPS)))


def row_label(c: Column) -> Column:
    """What stands before the first tab stop of a table's row, figures as 0; null for other sentences."""
    return F.when(c.contains("\t"), F.trim(F.substring_index(F.translate(c, "123456789", "000000000"), "\t", 1)))


def _tails(documents: DataFrame) -> DataFrame:
    """One narrow row for each text that may be cut: its last sentence masked, and the marks at its end."""
    c = F.col
    rows = documents.select("doc_id", "source", F.reverse("text").alias("r")).where(c("r").rlike(r"\S"))
    rows = rows.select("doc_id", "source", c("r").rlike(ELLIPSIS).alias("ellipsis"), c("r").rlike(BROKEN).alias("broken"), c("r").rlike(STOPPED).alias("stopped"), "r")
    rows = rows.where("ellipsis or broken or not stopped")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(c("r"), ELLIPSIS, ""), BROKEN, ""), r"^\s++", "")
    rows = rows.select("doc_id", "source", "ellipsis", "broken", F.reverse(F.regexp_extract(bare, LAST, 0)).alias("last"))
    return rows.select("doc_id", "source", "ellipsis", "broken", mask(c("last")).alias("tail"), F.when(last_word(c("last")).rlike(r"\d"), shape(c("last"))).alias("figure"), row_label(c("last")).alias("row_label"))


def _sentences(documents: DataFrame) -> DataFrame:
    """Distinct sentences of all texts, every digit a 0, with how often more text follows them and how often none does."""
    parts = F.split(F.regexp_replace("text", "[1-9]", "0"), BREAK)
    parts = F.filter(F.transform(parts, lambda x: F.btrim(x, F.lit(BLANKS))), lambda x: x != "")
    # the list is named twice, so it is bound once: a projection of its own would be merged and computed twice
    marked = F.transform(F.array(parts), lambda p: F.transform(p, lambda x, i: F.struct(x.alias("part"), (i < F.size(p) - 1).cast("long").alias("inner"))))[0]
    rows = documents.select(F.explode(marked).alias("s")).select("s.*")
    return rows.groupBy("part").agg(F.sum("inner").alias("inner"), F.sum(1 - F.col("inner")).alias("final"))


def _keys(sentences: DataFrame) -> DataFrame:
    """The forms in which sentences are compared (key), with how often more text follows them."""
    c = F.col
    figure = last_word(c("part")).contains("0")
    forms = F.when(figure, F.array(mask(c("part")), shape(c("part")))).otherwise(F.array(mask(c("part"))))
    return sentences.select(F.explode(forms).alias("key"), "inner").where("key <> ''").groupBy("key").agg(F.sum("inner").alias("inner"))


def strict_prefixes(asked: DataFrame, keys: DataFrame) -> DataFrame:
    """The values of ``asked`` (key) that are strict prefixes of some value of ``keys`` (key), each once.

    Values are sorted beside each other: if any value has q as a strict prefix, the next larger value has. Sorting
    runs within groups of equal fixed-length prefix, one level for each doubling of the length, and in a level keys
    are cut to twice its length, so that a hot prefix keeps only its distinct continuations.
    """
    c = F.col
    asked = asked.select("key").where("key <> ''").distinct()
    low = LEVELS[0]
    short = keys.where(F.length("key") > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.least(F.lit(low - 1), F.length("key") - 1)), lambda n: F.substring("key", 1, n))).alias("key")).distinct()
    found = asked.where(F.length("key") < low).join(short, "key", "left_semi")
    level = F.lit(low)
    for n in LEVELS[1:]:
        level = F.when(F.length("key") >= n, F.lit(n)).otherwise(level)
    mine = asked.where(F.length("key") >= low).select(level.alias("level"), "key", F.lit(True).alias("asks"))
    top = LEVELS[-1]
    wide = lambda n: c("key") if n == top else F.substring("key", 1, 2 * n)
    reach = F.array_compact(F.array(*[F.when(F.length("key") > n, F.struct(F.lit(n).alias("level"), wide(n).alias("key"))) for n in LEVELS]))
    theirs = keys.select(F.explode(reach).alias("x")).select("x.level", "x.key").distinct().withColumn("asks", F.lit(False))
    both = mine.unionByName(theirs).withColumn("head", F.expr("substring(key, 1, level)"))
    beside = W.partitionBy("level", "head").orderBy("key", "asks")
    both = both.withColumn("next", F.lead("key").over(beside))
    return found.unionByName(both.where(c("asks") & c("next").startswith(c("key")) & (F.length("next") > F.length("key"))).select("key"))


def _continued(asked: DataFrame, keys: DataFrame) -> DataFrame:
    """The values of ``asked`` whose last words are followed by more in some sentence, each once.

    For tails whose whole beginning is in no other text: the last three whole words (of three-word tails, two) must be known, and the last
    (perhaps cut) word must begin the next one there and not be its sentence's end.
    """
    c = F.col
    words = F.split(F.trim("key"), r"\s+")
    mine = asked.where(~c("key").startswith("\t")).select("key", words.alias("w")).where(F.size("w") >= 3)
    mine = mine.select("key", F.array_join(F.expr("slice(w, greatest(1, size(w) - 3), least(3, size(w) - 1))"), " ").alias("three"), F.element_at("w", -1).alias("part"))
    theirs = keys.where(~c("key").startswith("\t")).select(words.alias("w")).where(F.size("w") >= 3)

    def spots(n: int) -> Column:
        """Runs of n words and the word behind them."""
        found = F.transform(F.sequence(F.lit(1), F.size("w") - n), lambda i: F.struct(F.array_join(F.slice(c("w"), i, F.lit(n)), " ").alias("three"), F.element_at("w", i + n).alias("word"), (i + n < F.size("w")).alias("more")))
        return F.when(F.size("w") > n, found)

    theirs = theirs.select(F.explode(F.flatten(F.array_compact(F.array(spots(3), spots(2))))).alias("s")).select("s.*")
    theirs = theirs.join(mine.select("three").distinct(), "three", "left_semi").groupBy("three", "word").agg(F.max("more").alias("more"))
    hit = mine.join(theirs, "three").where(c("word").startswith(c("part")) & ((F.length("word") > F.length("part")) | c("more")))
    return hit.select("key").distinct()


def find_truncated(documents: DataFrame, rare_end: float = 0.2) -> DataFrame:
    """(doc_id, source, evidence) of the texts that were cut off; input doc_id, source, text. Null and blank texts are none.

    A text without a closing stop is truncated if its last sentence (figures masked) is a strict prefix of a longer
    one elsewhere (``prefix``) and is not itself a sentence that others follow elsewhere; if it is one, but its closing
    figure is there always longer (``figure``); if a cut left half a character or an opened bracket or tag (``mark``);
    if its last words go on in other sentences (``words``); or if it is
    a table whose last row is one that tables do not end with (``table``; at most ``rare_end`` of that row's places
    are last ones). Whole texts that merely lack the stop, stand-alone closing lines and texts that end in a stop
    are not. Every text is read whole and every sentence of every text is compared; repeated rows stay; null doc_id
    and source stay; an empty table gives an empty result; other columns are ignored.
    """
    c = F.col
    whole = documents.select("doc_id", "source", "text")
    tails = stage(_tails(whole))
    sentences = stage(_sentences(whole))
    keys = stage(_keys(sentences))
    asked = tails.select("tail").unionByName(tails.select(c("figure").alias("tail"))).where("tail <> ''").distinct().select(c("tail").alias("key"))
    longer = strict_prefixes(asked, keys).withColumn("longer", F.lit(True))
    whole_ones = keys.where("inner > 0").select("key", F.lit(True).alias("complete"))
    known = stage(asked.join(longer, "key", "left").join(whole_ones, "key", "left").select("key", F.coalesce("longer", F.lit(False)).alias("longer"), F.coalesce("complete", F.lit(False)).alias("complete")))
    rows = tails.join(known.select(c("key").alias("tail"), "longer", "complete"), "tail", "left")
    rows = rows.join(known.select(c("key").alias("figure"), c("longer").alias("longer_figure"), c("complete").alias("complete_figure")), "figure", "left")
    ends = sentences.select(row_label(c("part")).alias("row_label"), "inner", "final").where("row_label is not null").groupBy("row_label").agg(F.sum("inner").alias("row_inner"), F.sum("final").alias("row_final"))
    rows = rows.join(ends, "row_label", "left")
    yes = lambda x: F.coalesce(x, F.lit(False))
    evidence = (
        F.when(c("broken"), "mark")
        .when(yes(c("longer")) & ~yes(c("complete")), "prefix")
        .when(yes(c("longer_figure")) & ~yes(c("complete_figure")) & yes(c("complete")), "figure")
        .when(yes(c("row_final") <= rare_end * (c("row_final") + c("row_inner"))) & (c("row_inner") >= 2), "table")
    )
    rows = stage(rows.select("doc_id", "source", "tail", yes(c("complete")).alias("complete"), evidence.alias("evidence")))
    open_ends = rows.where("evidence is null and not complete")
    words = _continued(open_ends.select(c("tail").alias("key")).distinct(), keys).select(c("key").alias("tail"), F.lit("words").alias("words"))
    judged = rows.join(words, "tail", "left").select("doc_id", "source", F.coalesce("evidence", F.when(~c("complete"), c("words"))).alias("evidence"))
    cut_off = judged.where("evidence is not null").select("doc_id", "source", "evidence")
    return cut_off


def truncation_rates(documents: DataFrame, truncated: DataFrame) -> DataFrame:
    """For each source the number of documents, of texts, of truncated ones, and the rate among texts; null is a source."""
    c = F.col
    every = documents.groupBy("source").agg(F.count("*").alias("documents"), F.sum(F.coalesce(c("text").rlike(r"\S"), F.lit(False)).cast("long")).alias("texts"))
    bad = truncated.groupBy(c("source").alias("s")).agg(F.count("*").alias("n"))
    out = every.join(bad, c("source").eqNullSafe(c("s")), "left")
    return out.select("source", "documents", "texts", F.coalesce("n", F.lit(0)).alias("truncated"), F.when(c("texts") > 0, F.coalesce("n", F.lit(0)) / c("texts")).alias("rate"))
