"""Free-entered labels mapped to a reference list: an automaton for mentions, token-set similarity for the rest."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.confusables import Confusables, confusables
from ledgerloom.runtime import BROADCAST_ROWS, is_small, parallelism, stage


@dataclass(frozen=True)
class MapRule:
    """Thresholds of the similarity: share of the words' weight that must agree, and the weight of small words."""

    least: float = 0.6
    small_weight: float = 0.25


#: Small words that labels drop and gain. Fixed values.
SMALL = {"of", "and", "to", "on", "by", "for", "from", "in", "at", "a", "with", "des", "de", "la"}
#: What people put around a label: it says nothing about what is meant. Fixed values.
NOISE = {"the", "group", "groups", "restated", "unaudited"}

_BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_MARKS = re.compile(r"^\s*o\s*/\s*w\b|/\s*\d+\s*$|\*+")


def words_of(text: str, by: Confusables) -> list[str]:
    """The words of a label: one script, lower case, accents and brackets and footnote marks gone, noise words gone."""
    plain = text.lower() if text.isascii() else "".join(ch for ch in by.latin(text) if not 0x300 <= ord(ch) < 0x370).lower()
    bare = _MARKS.sub(" ", _BRACKETS.sub(" ", plain))
    bare = re.sub(r"\ba/c(s?)\b", r"account\1", bare)
    words = re.findall(r"[a-z0-9]+|[^\W_]+", bare)
    return [w for w in words if w not in NOISE] or words


def edits(a: str, b: str, most: int) -> int:
    """Edit distance with swaps of neighbours, up to ``most`` (then most + 1)."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            cost = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y))
            if before is not None and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            row.append(cost)
        before, last = last, row
        if min(row) > most:
            return most + 1
    return last[-1]


def alike(a: str, b: str) -> float:
    """How much word ``a`` as entered may stand for word ``b`` of the list: 1 equal, 0 not at all."""
    if a == b:
        return 1.0
    if a.isdigit() or b.isdigit():
        return 0.0
    if a.rstrip("s") == b.rstrip("s") and min(len(a), len(b)) > 2:
        return 0.97
    short = a[:-1] if a.endswith("s") and len(a) > 3 else a
    score = 0.0
    for x in {a, short}:
        if 2 <= len(x) < len(b) and x[0] == b[0] and len(b) >= 4:
            letters = iter(b)
            if b.startswith(x):
                score = max(score, 0.92 if len(x) > 2 else 0.8)
            elif len(x) >= 3 and all(ch in letters for ch in x) and (len(x) >= 0.6 * len(b) or not set(x[1:]) & set("aeiou")):
                score = max(score, 0.88)
        longest = max(len(x), len(b))
        most = 0 if longest < 3 else 1 if longest < 6 else 2
        d = edits(x, b, most) if most else 1
        if d <= most:
            score = max(score, 0.94 - 0.07 * d if longest >= 4 else 0.75)
    return score


def deletions(word: str, most: int) -> set[str]:
    """The word with up to ``most`` letters left out; two words within that many edits of each other share one such form."""
    found = front = {word}
    for _ in range(most):
        front = {w[:i] + w[i + 1 :] for w in front for i in range(len(w))}
        found = found | front
    return found


def edits_allowed(longest: int) -> int:
    return 0 if longest < 3 else 1 if longest < 6 else 2


class WordIndex:
    """Words of the list, asked for all that ``alike`` gives more than 0, without looking at the others."""

    def __init__(self, words: set[str]):
        self.sorted = sorted(words)
        self.longest = max(map(len, words), default=0)
        self.stems, self.opening, self.short = defaultdict(list), defaultdict(list), defaultdict(list)
        for w in self.sorted:
            self.stems[w.rstrip("s")].append(w)
            self.opening[w[0]].append((w, set(w)))
            for form in deletions(w, edits_allowed(len(w) + 2)):
                self.short[form].append(w)
        self.memo: dict[str, dict[str, float]] = {}

    def near(self, word: str) -> dict[str, float]:
        got = self.memo.get(word)
        if got is None:
            if len(self.memo) > 200_000:
                self.memo.clear()
            got = self.memo[word] = {v: score for v in sorted(self._candidates(word)) if (score := alike(word, v)) > 0}
        return got

    def _candidates(self, word: str) -> set[str]:
        out = set(self.stems.get(word.rstrip("s"), ()))
        if len(word) > self.longest + 2:
            return out
        for x in {word, word[:-1] if word.endswith("s") and len(word) > 3 else word}:
            for form in deletions(x, edits_allowed(max(len(x), len(x) + 2))):
                out.update(self.short.get(form, ()))
            at = bisect_left(self.sorted, x)
            while at < len(self.sorted) and self.sorted[at].startswith(x):
                out.add(self.sorted[at])
                at += 1
            if len(x) >= 3:
                letters = set(x)
                out.update(w for w, has in self.opening.get(x[0], ()) if len(w) > len(x) and letters <= has)
        return out


class GluedIndex:
    """Whole entries without blanks, asked for those within an eighth of their length of edits of a text.

    An entry is cut into twice as many pieces as edits are allowed, and one more: an edit, or a swap of neighbours, touches
    at most two, so one piece stands unchanged in the text, moved by no more places than edits.
    """

    def __init__(self, wholes: list[str]):
        self.pieces, self.lengths = defaultdict(set), set()
        for i, whole in enumerate(wholes):
            if len(whole) >= 6:
                self.lengths.add(len(whole))
                for k, (a, b) in enumerate(self._cuts(len(whole))):
                    self.pieces[len(whole), k, whole[a:b]].add(i)

    @staticmethod
    def allowed(length: int) -> int:
        return max(1, length // 8)

    @classmethod
    def _cuts(cls, length: int) -> list[tuple[int, int]]:
        n = 2 * cls.allowed(length) + 1
        edges = [length * k // n for k in range(n + 1)]
        return list(zip(edges, edges[1:]))

    def near(self, text: str) -> set[int]:
        out: set[int] = set()
        for length in self.lengths:
            most = self.allowed(length)
            if abs(length - len(text)) <= most:
                for k, (a, b) in enumerate(self._cuts(length)):
                    for move in range(-most, most + 1):
                        if a + move >= 0:
                            out |= self.pieces.get((length, k, text[a + move : b + move]), set())
        return out


class Matcher:
    """The reference list or a block of it, ready to be asked; entries are (scope, label, concept)."""

    def __init__(self, entries: list[tuple[str, str, str]], rule: MapRule, by: Confusables):
        import ahocorasick

        self.rule, self.by = rule, by
        known = {(scope, tuple(words_of(label or "", by)), concept) for scope, label, concept in entries if concept is not None}
        self.entries = sorted(e for e in known if e[1] and e[0] is not None)
        self.automaton = ahocorasick.Automaton()
        named = defaultdict(list)
        for i, (_, words, _) in enumerate(self.entries):
            named[" " + " ".join(words) + " "].append(i)
        for name, at in named.items():
            self.automaton.add_word(name, (len(name), at))
        if named:
            self.automaton.make_automaton()
        self.having = defaultdict(list)
        for i, (_, words, _) in enumerate(self.entries):
            for w in {*words, *(x + y for x, y in zip(words, words[1:]))}:  # neighbours also as one glued word
                self.having[w].append(i)
        self.words = WordIndex(set(self.having))
        self.glued = GluedIndex(["".join(e[1]) for e in self.entries])

    def _weight(self, word: str) -> float:
        return self.rule.small_weight if word in SMALL or len(word) == 1 else 1.0

    def mentions(self, scope: str | None, words: list[str]) -> list[tuple]:
        """Whole-word mentions: (-length, first word, words, of any scope, scope, concept, whether only small words are left)."""
        text, out = " " + " ".join(words) + " ", []
        for end, (length, at) in self.automaton.iter(text) if self.entries else ():
            fits = [self.entries[i] for i in at if scope is None or self.entries[i][0] in (scope, "*")]
            if fits:
                named, _, concept = min(fits, key=lambda e: (e[0] == "*", e))
                first = text[: end - length + 1].count(" ")
                n = text[end - length + 2 : end].count(" ") + 1
                rest = all(w in SMALL for w in words[:first] + words[first + n :])
                out.append((-length, first, n, named == "*", named, concept, rest))
        return out

    def _similarity(self, words: list[str], i: int, near: dict[str, dict[str, float]]) -> float:
        """Weighted share of both word sets that agree, each word used once; glued words are compared whole."""
        there = self.entries[i][1]
        pieces = [(y, (b,)) for b, y in enumerate(there)] + [(x + y, (b, b + 1)) for b, (x, y) in enumerate(zip(there, there[1:]))]
        pairs = sorted(((s, a, at) for a, x in enumerate(words) for y, at in pieces if (s := near[x].get(y, 0.0)) > 0), key=lambda p: (-p[0], p[1], p[2]))
        used_a, used_b, agreed = set(), set(), 0.0
        for s, a, at in pairs:
            if a not in used_a and not used_b & set(at):
                used_a.add(a)
                used_b |= set(at)
                agreed += s * (max(self._weight(words[a]), sum(self._weight(there[b]) for b in at) if len(at) > 1 else 0) + sum(self._weight(there[b]) for b in at)) / 2
        glue = sum(self._weight(there[b]) for b in used_b)
        loose = sum(self._weight(w) for a, w in enumerate(words) if a not in used_a)
        total = glue + loose + sum(map(self._weight, there))
        score = 2 * agreed / total if total else 0.0
        glued, whole = "".join(words), "".join(there)
        most = GluedIndex.allowed(len(whole))
        if len(whole) >= 6 and score < 0.99 and abs(len(glued) - len(whole)) <= most:
            d = edits(glued, whole, most)
            if d <= most:
                score = max(score, 1 - d / len(whole) * 1.2)
        return score

    def similar(self, scope: str | None, words: list[str]) -> tuple[float, bool, str] | None:
        """(-score, of any scope, concept) of the most similar entry, the smaller concept of equal ones; None if none has anything in common."""
        near = {w: self.words.near(w) for w in set(words)}
        candidates = {i for w in near for v in near[w] for i in self.having[v]} | self.glued.near("".join(words))
        fits = (i for i in candidates if scope is None or self.entries[i][0] in (scope, "*"))
        return min(((-round(self._similarity(words, i, near), 6), self.entries[i][0] == "*", self.entries[i][2]) for i in fits), default=None)

    def asked(self, label: str | None) -> list[str]:
        """The words of a label that can be asked for: none where no word has a letter."""
        words = words_of(label, self.by) if isinstance(label, str) else []
        return words if any(ch.isalpha() for w in words for ch in w) else []


#: Labels that a task gets at a time with a block of the list, about.
LABELS_AT_A_TIME = 20_000


def _ask(labels: DataFrame, entries: DataFrame, blocks: int, rule: MapRule, answer: Callable, fields: str) -> DataFrame:
    """Each label against each block of the list: rows (scope, label, fields) of ``answer(matcher, scope, words)``.

    Both sides meet by (share of the labels, block), so a task holds one block and one share and the driver none.
    """
    shares = max(parallelism(labels.sparkSession), -(-labels.count() // LABELS_AT_A_TIME))
    mine = labels.withColumns({"share": F.pmod(F.xxhash64("scope", "label"), F.lit(shares)).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    theirs = entries.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))
    names, by = [f.split()[0] for f in fields.split(", ")], confusables(labels.sparkSession)

    def run(asks: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asks):
            matcher = Matcher(list(known[["scope", "label", "concept"]].itertuples(index=False, name=None)), rule, by)
            for scope, label in zip(asks["scope"], asks["label"]):
                words = matcher.asked(label)
                for row in answer(matcher, scope, words) if words else ():
                    out.append((scope, label, *row))
        return pd.DataFrame(out, columns=["scope", "label", *names])

    return mine.groupBy("share", "block").cogroup(theirs.groupBy("share", "block")).applyInPandas(run, f"scope string, label string, {fields}")


def map_labels(labels: DataFrame, reference: DataFrame, rule: MapRule = MapRule(), block: int = BROADCAST_ROWS) -> DataFrame:
    """``labels`` (scope, label, other columns) with concept ('' if none is meant), score and how.

    ``reference`` is (scope, label, concept); an entry counts for the labels of its scope, entries of scope ``*``
    for all, and all entries for labels of null scope. First the automaton: the longest mention decides if no other lies
    beside it and nothing but small words is left over. The other labels go to the most similar entry, if it is similar
    enough, equal ones by the smaller concept. The list is read in blocks of about ``block`` entries, and mentions and scores
    of all blocks are put together before anything is decided, so the answer is the same for any block. Null and empty
    labels and those without a letter are ''; repeated rows stay; an empty list maps everything to ''. Each label is asked
    once however many rows have it.
    """
    c, keys = F.col, ["scope", "label"]
    entries = reference.where("concept is not null").select(*keys, "concept").distinct()
    blocks = max(1, -(-entries.count() // block))
    entries = entries.withColumn("block", F.pmod(F.xxhash64(*keys, "concept"), F.lit(blocks)).cast("int"))
    asked = stage(labels.select(*keys).where("label is not null").distinct())
    hits = _ask(asked, entries, blocks, rule, lambda m, scope, words: m.mentions(scope, words), "longest long, first long, n long, wild boolean, named string, concept string, rest boolean")
    order = F.struct("longest", "first", "n", "wild", "named", "concept", "rest")
    longest = hits.groupBy(*keys).agg(F.min(order).alias("b"), F.max("first").alias("last"), F.min(c("first") + c("n")).alias("ends"))
    alone = c("b.rest") & (c("last") < c("b.first") + c("b.n")) & (c("ends") > c("b.first"))
    mentioned = stage(longest.where(alone).select(*keys, "b.concept", F.lit(1.0).alias("score"), F.lit("mention").alias("how")))
    open_ = stage(asked.join(mentioned.select(*[c(k).alias(f"m_{k}") for k in keys]), c("scope").eqNullSafe(c("m_scope")) & (c("label") == c("m_label")), "left_anti"))
    scored = _ask(open_, entries, blocks, rule, lambda m, scope, words: filter(None, [m.similar(scope, words)]), "less double, wild boolean, concept string")
    best = scored.groupBy(*keys).agg(F.min(F.struct("less", "wild", "concept")).alias("b")).select(*keys, c("b.concept").alias("near"), (-c("b.less")).alias("score"))
    enough = c("score") >= rule.least
    similar = best.select(*keys, F.when(enough, c("near")).otherwise("").alias("concept"), "score", F.when(enough, "similar").otherwise("none").alias("how"))
    answers = stage(mentioned.unionByName(similar))
    # a hot label is split over several keys where the answers are too many to be sent everywhere
    ways = 1 if is_small(answers) else 16
    right = answers.select(*[c(k).alias(f"a_{k}") for k in keys], "concept", "score", "how", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))).alias("a_way"))
    way = F.pmod(F.xxhash64(*labels.columns), F.lit(ways)).cast("int")
    same = c("scope").eqNullSafe(c("a_scope")) & (c("label") == c("a_label")) & (way == c("a_way"))
    joined = labels.join(F.broadcast(right) if ways == 1 else right, same, "left")
    return joined.select(*labels.columns, F.coalesce("concept", F.lit("")).alias("concept"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("how", F.lit("none")).alias("how"))
