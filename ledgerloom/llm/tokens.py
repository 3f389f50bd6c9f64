"""Token ids of a whole corpus: halves encoded recursively and joined where the tokens provably agree."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Folder of the public tokenizers' files; a parameter everywhere it is used.
TOKENIZERS = os.environ.get("LEDGERLOOM_TOKENIZERS", "/opt/tokenizers")
#: How byte_bpe_50k cuts text into words before merging bytes: contractions, letters, figures, signs, blanks. Fixed value.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of up to so many characters are leaves of the tree and are encoded at once.
LEAF_CHARS = 4_096
#: Characters past a word's end that may decide where it ends ("'" before "re"), and one to spare.
LOOK = 3


@dataclass
class Span:
    """A stretch of text: its ids, where its words start, and how many ids come before each word."""

    text: str
    ids: list[int] = field(default_factory=list)
    starts: list[int] = field(default_factory=list)
    before: list[int] = field(default_factory=list)


class Encoder:
    """byte_bpe_50k without special tokens; the ids equal those of one pass over the whole text.

    Words are read from left to right by a pattern that never looks back and at most ``LOOK`` characters ahead,
    and each word is encoded by itself. So (1) the words of a left half that end ``LOOK`` before its end are
    final, and (2) once a reading of the joined text starts a word where the right half started one, all later
    words are those of the right half. ``join`` re-reads from the first word that is not final, in windows that
    double until (2) holds.
    """

    def __init__(self, folder: str = TOKENIZERS, name: str = "byte_bpe_50k", leaf: int = LEAF_CHARS):
        import tiktoken

        with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bpe = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words = regex.compile(PATTERN.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.leaf = max(2, leaf)
        self.memo: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        ids = self.memo.get(word)
        if ids is None:
            ids = self.bpe._encode_single_piece(word.encode())
            if len(self.memo) < 200_000 and len(word) < 40:
                self.memo[word] = ids
        return ids

    def _read(self, text: str, words: list[str], starts: list[int]) -> Span:
        span = Span(text, starts=starts)
        for word in words:
            span.before.append(len(span.ids))
            span.ids += self._word(word)
        return span

    def _leaf(self, text: str) -> Span:
        found = [(m.group(), m.start()) for m in self.words.finditer(text)]
        span = self._read(text, [w for w, _ in found], [s for _, s in found])
        if span.ids != self.bpe.encode_ordinary(text):  # the two pattern engines know different characters
            raise UnicodeError("words read differently")
        return span

    def join(self, left: Span, right: Span) -> Span:
        """The span of both texts; only the words around the seam are encoded again."""
        if not left.starts or not right.starts:
            return right if not left.starts else left
        n, k = len(left.text), len(left.starts)
        ends = left.starts[1:] + [n]
        while k and ends[k - 1] > n - LOOK:
            k -= 1
        anchor = left.starts[k] if k < len(left.starts) else n
        place = {s: i for i, s in enumerate(right.starts)}
        reach = 64
        while True:
            whole = reach >= len(right.text)
            window = left.text[anchor:] + right.text[:reach]
            words, starts, meet = [], [], None
            for m in self.words.finditer(window):
                s = m.start() - (n - anchor)
                if s >= 0 and s in place:
                    meet = place[s]
                    break
                if not whole and m.end() > len(window) - LOOK:
                    break
                words.append(m.group())
                starts.append(anchor + m.start())
            else:
                meet = len(right.starts) if whole else None
            if meet is not None:
                break
            reach *= 2
        seam = self._read(window, words, starts)
        head = left.ids[: left.before[k]] if k < len(left.starts) else left.ids
        out = Span(left.text + right.text, head + seam.ids, left.starts[:k] + starts, left.before[:k] + [len(head) + b for b in seam.before])
        first = right.before[meet] if meet < len(right.starts) else len(right.ids)
        shift = len(out.ids) - first
        out.ids += right.ids[first:]
        out.starts += [n + s for s in right.starts[meet:]]
        out.before += [b + shift for b in right.before[meet:]]
        return out

    def _tree(self, text: str) -> Span:
        if len(text) <= self.leaf:
            return self._leaf(text)
        half = len(text) // 2
        return self.join(self._tree(text[:half]), self._tree(text[half:]))

    def encode(self, text: str | None) -> list[int]:
        """The text's ids; none for empty and null texts."""
        if not text:
            return []
        if len(text) <= self.leaf:
            return self.bpe.encode_ordinary(text)
        try:
            return self._tree(text).ids
        except UnicodeError:
            return self.bpe.encode_ordinary(text)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: concatenation up the tree."""
        return self.bpe.decode(list(ids))


def encode_corpus(documents: DataFrame, folder: str = TOKENIZERS, leaf: int = LEAF_CHARS) -> DataFrame:
    """(doc_id, ids) of every row: the ids of its text by byte_bpe_50k, no special tokens.

    Empty and null texts have an empty list; blank texts the ids of their blanks; a null doc_id stays null and
    repeated rows stay; an empty table gives an empty result; other columns are ignored. Nothing is shuffled.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(folder, leaf=leaf)
        for pdf in frames:
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "ids": [encoder.encode(t if isinstance(t, str) else None) for t in pdf["text"]]})

    return documents.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, ids array<int>")


def count_tokens(documents: DataFrame, keep: list[str], folder: str = TOKENIZERS, leaf: int = LEAF_CHARS) -> DataFrame:
    """``keep`` and ``tokens``, the number of ids of each row's text; the ids never leave their task."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(folder, leaf=leaf)
        for pdf in frames:
            yield pdf[keep].assign(tokens=[len(encoder.encode(t if isinstance(t, str) else None)) for t in pdf["text"]])

    return documents.select(*keep, "text").mapInPandas(run, f"{kinds}, tokens long")
