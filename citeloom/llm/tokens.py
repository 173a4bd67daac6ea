"""Encoding with a public byte-level BPE (problems 7 and 8).

Bytes are mapped to Latin-1 so that an Aho-Corasick automaton over strings can find the longest
vocabulary matches of a piece. The greedy chain of longest matches is the exact result whenever
each pair of neighbours is compatible, that is, whenever merging would never join across their
border; compatibility is memoised. Where a pair is not, the encoder backtracks over shorter
matches. The work is linear in the length of a piece, whatever the piece.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Where the vocabulary files lie; a parameter of every operator here.
TOKENIZERS = "/opt/tokenizers"
#: Pieces remembered by a worker.
MEMO = 300_000
#: Fixed value: the split pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Encodes text by the ranks and merges of one vocabulary."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
        letter = _byte_letters()
        word = lambda s: bytes(letter[c] for c in s).decode("latin-1")
        self.ids = {word(s): i for s, i in model["vocab"].items() if all(c in letter for c in s)}
        self.split = regex.compile(PATTERN)
        self.merged: dict[tuple[int, int], int] = {}
        self.halves: dict[int, tuple[int, int]] = {i: (i, i) for i in self.ids.values()}
        self.rank: dict[int, int] = {i: -1 for i in self.ids.values()}
        for rank, merge in enumerate(model["merges"]):
            left, right = (word(s) for s in (merge.split(" ") if isinstance(merge, str) else merge))
            i, j, k = self.ids[left], self.ids[right], self.ids[left + right]
            if self.rank[k] < 0:
                self.rank[k], self.halves[k] = rank, (i, j)
            self.merged[i, j] = rank
        self.words = {i: s for s, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for s, i in self.ids.items():
            self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, tuple[int, ...]] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging leaves the border between two neighbouring tokens alone."""
        key = left, right
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) > 4 * MEMO:
                self.pairs.clear()
            known = self.pairs[key] = self._compatible(left, right)
        return known

    def _compatible(self, left: int, right: int) -> bool:
        # Undo merges on both sides of the border, the latest first. A merge across the border that
        # ranks before the earliest merge undone so far would have been taken instead.
        rank, limit = self.rank, 1 << 60
        while True:
            if self.merged.get((left, right), limit) < limit:
                return False
            a, b = rank[left], rank[right]
            if a < 0 and b < 0:
                return True
            # Of two equal ranks merging takes the left one first, so the right one is undone first
            # and a merge across of that very rank would still win over it.
            if a > b:
                limit, left = a, self.halves[left][1]
            else:
                limit, right = b + 1, self.halves[right][0]

    def _longest(self, text: str, at: int) -> int:
        """The longest token that starts at a place."""
        end = at + self.automaton.longest_prefix(text[at : at + self.longest])
        while (i := self.ids.get(text[at:end])) is None:
            end -= 1
        return i

    def _next_shorter(self, token: int) -> int | None:
        if token not in self.shorter:
            s = self.words[token]
            self.shorter[token] = next((self.ids[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in self.ids), None)
        return self.shorter[token]

    def _backtrack(self, text: str) -> list[int]:
        out: list[int] = []
        open_ends = bytearray(b"\1" * (len(text) + 1))
        at, token = 0, self._longest(text, 0)
        while at < len(text):
            while token is not None:
                end = at + len(self.words[token])
                if open_ends[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self._next_shorter(token)
            if token is not None:
                out.append(token)
                at = end
                token = self._longest(text, at) if at < len(text) else None
            else:  # no way on from here: close this place and shorten the token before
                open_ends[at] = 0
                token = out.pop()
                at -= len(self.words[token])
        return out

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece of the split pattern."""
        if (known := self.memo.get(text)) is None:
            raw = text.encode("utf-8", "replace").decode("latin-1")
            if (whole := self.ids.get(raw)) is not None:
                known = (whole,)
            else:
                chain = [i for _, i in self.automaton.iter_long(raw)]
                ok = all(map(self.compatible, chain, chain[1:])) and sum(len(self.words[i]) for i in chain) == len(raw)
                known = tuple(chain) if ok else tuple(self._backtrack(raw))
            if len(text) <= 64:
                if len(self.memo) > MEMO:
                    self.memo.clear()
                self.memo[text] = known
        return known

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        for piece in self.split.findall(text):
            out.extend(self.piece(piece))
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_ids(text: str | Column, tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> Column:
    """Ids of a text, without special tokens; null and empty texts give an empty array.

    Strings that spell a special token are ordinary text. Texts of any length are encoded whole.
    """
    path = f"{tokenizers}/{name}.json"

    @F.pandas_udf(ArrayType(IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for batch in batches:
            yield pd.Series([np.asarray(e.encode(t), dtype=np.int32) for t in batch])

    return ids(F.col(text) if isinstance(text, str) else text)


def token_count(text: str | Column, tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> Column:
    """Number of tokens of a text (bigint); 0 for null and empty texts."""
    path = f"{tokenizers}/{name}.json"

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        e = encoder(path)
        for batch in batches:
            yield pd.Series([sum(len(e.piece(p)) for p in e.split.findall(t)) if t else 0 for t in batch], dtype="int64")

    return count(F.col(text) if isinstance(text, str) else text)


def encode_documents(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS) -> DataFrame:
    """(doc_id, ids) of every row; repeated rows stay repeated, an empty table gives no rows."""
    return documents.select(F.col(doc_id).alias("doc_id"), token_ids(text, tokenizers).alias("ids"))


def reference_ranks(tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> dict[bytes, int]:
    """Ranks of the ``.tiktoken`` file of a vocabulary, for cross-checks."""
    lines = Path(f"{tokenizers}/{name}.tiktoken").read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
