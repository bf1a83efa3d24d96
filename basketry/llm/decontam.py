"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item of n words may differ from a passage by k = n // `WORDS_PER_EDIT` edits (a
word changed, put in or left out).  It is split into k + 1 pieces, of which at least one
must then be in the passage as it is; each exact hit of a piece is verified with Myers'
bit-parallel edit distance around it.  Words are runs of letters and digits in lower case, so
punctuation and white space make no difference.

The benchmark is the query set: it is read in blocks of `BLOCK_WORDS` words, each broadcast
and matched against all documents, so neither it nor the documents are ever whole in one
place.  Null and empty texts and items match nothing; texts are searched whole; repeated
rows and repeated items are reported one by one; of a text's passages for an item the one
with the fewest edits, then the first, is returned.  `matches` is a column function, so
other columns do not matter.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS_PER_EDIT = 8
BLOCK_WORDS = 2_000_000
ANCHOR_BITS = 20
TOKEN = re.compile(r"[^\W_]+")
MATCHES = "array<struct<item_id: long, distance: int, end_word: int>>"


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def pieces(n: int) -> list[tuple[int, int]]:
    """Start and end of the error-budget-plus-one pieces of n words."""
    count = n // WORDS_PER_EDIT + 1
    return [(n * k // count, n * (k + 1) // count) for k in range(count)]


def myers(pattern: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of the pattern to a piece of the text, and where that piece ends first."""
    places: dict[int, int] = defaultdict(int)
    for k, word in enumerate(pattern):
        places[word] |= 1 << k
    size = len(pattern)
    full, high = (1 << size) - 1, 1 << (size - 1)
    plus, minus, score = full, 0, size
    best, end = size, 0
    for k, word in enumerate(text):
        equal = places.get(word, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        score += bool(up & high) - bool(down & high)
        up = up << 1 & full
        plus = (down << 1 & full) | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, k + 1
    return best, end


class Numbers(dict):
    """Number of each word of the items; 0 for any other."""

    def __missing__(self, word: str) -> int:
        return 0


@dataclass
class Block:
    """Items of one block, prepared for the search."""

    numbers: Numbers = field(default_factory=Numbers)
    items: list[tuple[int, list[int]]] = field(default_factory=list)
    found: dict[tuple[int, ...], list[tuple[int, int]]] = field(default_factory=lambda: defaultdict(list))

    def add(self, item_id: int, words: list[str]) -> None:
        for word in words:
            self.numbers.setdefault(word, len(self.numbers) + 1)
        numbered = [self.numbers[word] for word in words]
        self.items.append((item_id, numbered))
        for start, end in pieces(len(words)):
            self.found[tuple(numbered[start:end])].append((len(self.items) - 1, start))

    def anchors(self) -> tuple[np.ndarray, dict[int, list[int]]]:
        """Marks of each piece's first words, and the piece lengths behind them."""
        marks, lengths = np.zeros(1 << ANCHOR_BITS, bool), defaultdict(set)
        for piece in self.found:
            first = int(_anchor(np.array(piece[:3] + (0,) * (3 - len(piece)), np.uint64))[0]) if len(piece) >= 3 else None
            if first is not None:
                marks[first] = True
                lengths[first].add(len(piece))
        return marks, {k: sorted(v) for k, v in lengths.items()}


def _anchor(words: np.ndarray) -> np.ndarray:
    """Hash of every three words in a row."""
    mixed = (words[:-2] * np.uint64(0x9E3779B97F4A7C15) + words[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
             + words[2:] * np.uint64(0x165667B19E3779F9))
    return (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - ANCHOR_BITS)


class Search:
    """Finds the items of a block in texts."""

    def __init__(self, block: Block):
        self.block = block
        self.marks, self.lengths = block.anchors()
        self.short = [piece for piece in block.found if len(piece) < 3]

    def starts(self, words: np.ndarray) -> Iterator[tuple[int, tuple[int, ...]]]:
        """Places and pieces of the exact hits."""
        if len(words) >= 3:
            hashes = _anchor(words.astype(np.uint64))
            for at in np.flatnonzero(self.marks[hashes] & (words[:-2] > 0)):
                for length in self.lengths[int(hashes[at])]:
                    piece = tuple(words[at:at + length].tolist())
                    if piece in self.block.found:
                        yield int(at), piece
        for piece in self.short:
            hits = words[:len(words) - len(piece) + 1] == piece[0]
            for k, word in enumerate(piece[1:], 1):
                hits &= words[k:len(words) - len(piece) + 1 + k] == word
            for at in np.flatnonzero(hits):
                yield int(at), piece

    def matches(self, text: str | None) -> list[dict]:
        numbers = self.block.numbers
        listed = tokens(text)
        words = np.fromiter((numbers[word] for word in listed), np.int64, len(listed))
        best: dict[int, tuple[int, int]] = {}
        seen: set[tuple[int, int]] = set()
        for at, piece in self.starts(words):
            for item, offset in self.block.found[piece]:
                begin = at - offset
                if (item, begin) in seen:
                    continue
                seen.add((item, begin))
                pattern = self.block.items[item][1]
                budget = len(pattern) // WORDS_PER_EDIT
                low = max(0, begin - budget)
                distance, end = myers(pattern, words[low:begin + len(pattern) + budget].tolist())
                if distance <= budget:
                    best[item] = min(best.get(item, (distance, low + end)), (distance, low + end))
        return [{"item_id": self.block.items[item][0], "distance": d, "end_word": e} for item, (d, e) in sorted(best.items())]


def blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
           block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The items in blocks, each small enough to broadcast; items without id or words are left out."""
    block, size = Block(), 0
    rows = benchmark.select(F.col(item_id).alias("id"), F.col(text).alias("text")).where("id is not null and text is not null")
    for row in rows.toLocalIterator():
        words = tokens(row["text"])
        if not words:
            continue
        if size and size + len(words) > block_words:
            yield block
            block, size = Block(), 0
        block.add(row["id"], words)
        size += len(words)
    if size:
        yield block


def matches(text: Column, benchmark: DataFrame, **how) -> Column:
    """The benchmark passages in a text: array of (item_id, distance, end_word), by block and item."""
    context = benchmark.sparkSession.sparkContext

    def searched(block: Block) -> Column:
        shared = context.broadcast(block)

        @F.pandas_udf(MATCHES)
        def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            search = Search(shared.value)
            for batch in batches:
                yield pd.Series([search.matches(text) for text in batch])

        return find(text)

    found = [searched(block) for block in blocks(benchmark, **how)]
    if not found:
        return F.array().cast(MATCHES)
    return reduce(lambda a, b: F.concat(a, b), found)
