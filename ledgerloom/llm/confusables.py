"""Visually identical texts: skeletons by a look-alike table, canonical forms, and the disguised texts named."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.runtime import small_side, stage

#: Signs that stand for a plain one. Fixed values.
SIGNS = {"‐": "-", "‑": "-", "−": "-", "﹣": "-", "⁄": "/", "∕": "/", "․": ".", "‚": ","}
#: Letters that print like a Latin one although the public relation keeps them apart. Fixed values.
BESIDE = {"κ": "k"}
#: Compatibility forms that are print of their own: raised and lowered figures, fractions, trade marks.
KEPT = {"<super>", "<sub>", "<fraction>"}
#: Phonetic letters are of the Latin script, but of no language's words.
PHONETIC = {*range(0x250, 0x2B0), *range(0x1D00, 0x1DC0)}

_WORD = regex.compile(r"[\p{L}\p{M}]+")
_FOREIGN = regex.compile(r"(?V1)[[\p{L}--[\p{Latin}\p{Common}\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]]\u0250-\u02AF\u1D00-\u1DBF]")
_LATIN = regex.compile(r"(?V1)[\p{Latin}--[\u0250-\u02AF\u1D00-\u1DBF]]")
_EAST = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}]")
_RELATION: dict[str, str] = {}


def relation(spark: SparkSession) -> dict[str, str]:
    """The public look-alike relation of Unicode (character -> prototype), as the ICU library that Spark carries has it.

    Asked for once, all letters, figures and signs in one text, but the ideographs and syllables, which are their own prototypes.
    """
    if not _RELATION:
        plain = lambda i: not (0x3400 <= i < 0xA000 or 0xAC00 <= i < 0xD7B0)
        chars = [chr(i) for i in range(0x21, 0x1FFFF) if plain(i) and unicodedata.category(chr(i))[0] in "LNPS"]
        found = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build().getSkeleton("\n".join(chars)).split("\n")
        _RELATION.update({a: b for a, b in zip(chars, found) if unicodedata.normalize("NFD", a) != b})
    return _RELATION


class _Lazy(dict):
    """A table for str.translate that works its entries out when they are first asked for."""

    def __init__(self, entry: Callable[[str], str | None]):
        self.entry = entry

    def __missing__(self, code: int) -> str | None:
        self[code] = found = self.entry(chr(code))
        return found


def _decomposed(ch: str) -> str | None:
    if ch.isascii():
        return ch
    kind = unicodedata.category(ch)
    if kind in ("Cf", "Zs"):
        return None if kind == "Cf" else " "
    way = unicodedata.decomposition(ch)
    tag = way.split(" ", 1)[0] if way.startswith("<") else ""
    return ch if not tag or tag in KEPT or ch in "™℠" else unicodedata.normalize("NFKD", ch)


_FORMS = _Lazy(_decomposed)


def decompose(text: str) -> str:
    """Canonical and, but for raised figures, fractions and their like, compatibility decomposition; unseen characters gone."""
    return unicodedata.normalize("NFD", text).translate(_FORMS)


class Confusables:
    """Skeletons and consistent forms by a look-alike relation (character -> prototype)."""

    def __init__(self, prototypes: dict[str, str]):
        self.prototypes = {ord(a): b for a, b in prototypes.items()}
        self.signs = {ord(a): b for a, b in SIGNS.items()}
        # the plain letter a foreign one stands for: of its prototype and, as prototypes are one for I and l, of its case
        plain: dict[tuple[str, str], str] = {}
        for ch in map(chr, range(0x7E, 0x20, -1)):
            plain[prototypes.get(ch, ch), unicodedata.category(ch)] = ch
        foreign = {ch for ch in prototypes if not ch.isascii() and (_FOREIGN.match(ch) or ord(ch) in PHONETIC)}
        self.letters = {ord(ch): plain[key] for ch in foreign if (key := (prototypes[ch], unicodedata.category(ch))) in plain and plain[key].isalpha()}
        self.letters |= {ord(a): b for a, b in BESIDE.items()}

    def skeleton(self, text: str) -> str:
        """Decompose, put the prototype for every character that has one, decompose again."""
        return decompose(decompose(text).translate(self.prototypes))

    def ascii_skeleton(self, text: Column) -> Column:
        """The same for plain ASCII, which needs no decomposing, inside the JVM."""
        short = {chr(a): b for a, b in self.prototypes.items() if a < 128 and len(b) == 1}
        out = F.translate(text, "".join(short), "".join(short.values()))
        for a, b in self.prototypes.items():
            if a < 128 and len(b) > 1:
                out = F.replace(out, F.lit(chr(a)), F.lit(b))
        return out

    def latin(self, text: str) -> str:
        """The text decomposed, with plain letters and signs for all that look like them."""
        return decompose(text).translate(self.letters).translate(self.signs)

    def _plain_word(self, match) -> str:
        """A word that mixes Latin with look-alikes, in Latin; a word wholly of another script stays."""
        word = match.group()
        return word.translate(self.letters) if _FOREIGN.search(word) and _LATIN.search(word) else word

    def canonical(self, text: str) -> str:
        """The one consistent form: composed, plain spaces and hyphens, nothing unseen, words in one script."""
        return unicodedata.normalize("NFC", _WORD.sub(self._plain_word, decompose(text).translate(self.signs)))

    def foreign_words(self, text: str) -> int:
        """Words wholly of look-alikes of another script: disguises if the same text also exists in plain letters."""
        return sum(1 for w in _WORD.findall(decompose(text)) if _FOREIGN.search(w) and not _LATIN.search(w) and all(ord(ch) in self.letters or unicodedata.combining(ch) for ch in w))

    def disguise(self, text: str) -> bool:
        """Whether the text differs from its consistent form; wide forms beside East Asian text do not count."""
        if _EAST.search(text):
            east = "".join(unicodedata.normalize("NFKC", ch) if unicodedata.east_asian_width(ch) == "F" else ch for ch in text)
            return self.canonical(text) != unicodedata.normalize("NFC", east) or text != unicodedata.normalize("NFC", text)
        return self.canonical(text) != text

    def forms(self, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, tuple] = {}
        for pdf in frames:
            out = []
            for text in pdf["text"]:
                form = known.get(text)
                if form is None:
                    form = (self.skeleton(text), self.canonical(text), self.disguise(text), self.foreign_words(text))
                    if len(known) < 50_000:
                        known[text] = form
                out.append(form)
            forms = pd.DataFrame(out, columns=["skeleton", "canonical", "disguised", "foreign"])
            yield pd.concat([pdf.reset_index(drop=True), forms], axis=1)


def confusables(spark: SparkSession) -> Confusables:
    return Confusables(relation(spark))


def text_forms(texts: DataFrame) -> DataFrame:
    """Texts (column ``text``, other columns kept) with skeleton, canonical form, whether they differ from it, and foreign words.

    Plain ASCII is its own form and never leaves the JVM; null and empty text have themselves as form and skeleton.
    """
    by = confusables(texts.sparkSession)
    ascii_only = F.coalesce(~F.col("text").rlike(r"[^\x00-\x7f]"), F.lit(True))
    same = texts.where(ascii_only).withColumns({"skeleton": by.ascii_skeleton(F.col("text")), "canonical": F.col("text"), "disguised": F.lit(False), "foreign": F.lit(0)})
    kinds = {"skeleton": "string", "canonical": "string", "disguised": "boolean", "foreign": "int"}
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema), *(f"{k} {v}" for k, v in kinds.items())])
    other = texts.where(~ascii_only).mapInPandas(by.forms, schema)
    return same.unionByName(other)


def groups(texts: DataFrame) -> DataFrame:
    """Distinct texts grouped by equal skeleton: skeleton, canonical form of the plainest, number of texts and of records.

    The plainest text is the one with the fewest words of another script, then one that is no disguise, then the
    smallest. Groups are aggregates (counts and a minimum), so no group is ever held as a list.
    """
    forms = text_forms(texts.where("text is not null").groupBy("text").agg(F.count("*").alias("records")))
    plainest = F.min(F.struct("foreign", "disguised", "canonical", "text"))
    return forms.groupBy("skeleton").agg(plainest.alias("p"), F.count("*").alias("texts"), F.sum("records").alias("records"), F.sum(F.col("disguised").cast("int")).alias("disguised")).select(
        "skeleton", F.col("p.canonical").alias("canonical"), F.col("p.foreign").alias("foreign"), "texts", "records", "disguised"
    )


def disguised(records: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the records whose text is a disguise, each key once; input keys and ``text``.

    Texts of equal skeleton are one class, to which the consistent form of each of its texts belongs too, whether or not it
    is printed anywhere. A text is a disguise if its class holds a plainer one: with fewer words wholly of look-alikes of
    another script or, of as many, without a character that cannot be seen or stands for another (wide forms, odd spaces,
    ligatures, loose accents, soft and hard hyphens, look-alike letters in a word that mixes scripts). So composed accents,
    dashes, raised figures and words of another script are none, but for words of look-alikes that are also printed plainly.
    Null and empty texts are none.
    """
    c, by = F.col, confusables(records.sparkSession)
    ascii_only = ~c("text").rlike(r"[^\x00-\x7f]")
    rank = 2 * c("foreign") + c("disguised").cast("int")
    forms = stage(text_forms(records.select(*keys, "text").where(~ascii_only)).select(*keys, "skeleton", "foreign", rank.alias("rank")))
    mine = forms.where("rank > 0")
    # plainer texts are looked for only where the consistent form is not the plainest already
    asked = small_side(mine.where("foreign > 0").select("skeleton").distinct())
    plain = records.where(ascii_only).select(by.ascii_skeleton(c("text")).alias("skeleton"), F.lit(0).alias("least"))
    printed = plain.unionByName(forms.select("skeleton", c("rank").alias("least"))).join(asked, "skeleton", "left_semi")
    built = mine.select("skeleton", (2 * c("foreign")).alias("least"))
    least = printed.unionByName(built).groupBy("skeleton").agg(F.min("least").alias("least"))
    return mine.join(least, "skeleton").where("rank > least").select(*keys).distinct()
