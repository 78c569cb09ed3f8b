"""Benchmark decontamination by pigeonhole edit matching.

An item may be off by a budget of k edits, a share of its length. It is split into k + 1 pieces, of
which one must then be intact. An Aho-Corasick automaton finds intact pieces in one pass over a
text. Pieces are joined into groups of two, four and so on: of an item within its budget, some
intact piece lies only in groups of p pieces with fewer than p edits, so a hit is checked in its pair
first and in larger groups after that. What is left fixes a window for the whole item. Groups and
windows are measured with Myers' bit-parallel distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.llm.common import batch, workers_import

#: Edits allowed per character of an item.
ERROR_RATE = 0.12
#: Characters of items in one automaton; more items mean more passes over the documents.
BLOCK_CHARS = 1_000_000

#: Items of fewer characters, which have no edits, are found as whole words only.
SHORT = 9

Item = tuple[int | None, str]
Match = tuple[int | None, int, int, int]


def normalised(text: str | None) -> str:
    """Lower case, with runs of white space as one space."""
    return " ".join(text.lower().split()) if text else ""


def budget(item: str, error_rate: float = ERROR_RATE) -> int:
    return int(len(item) * error_rate)


def cuts(item: str, errors: int) -> list[int]:
    """Bounds of `errors` + 1 consecutive pieces of nearly equal length."""
    return [len(item) * i // (errors + 1) for i in range(errors + 2)]


class Piece(NamedTuple):
    """A piece of an item: its place, the other piece of its pair, and the larger groups it is in."""

    item: int
    offset: int
    #: The pair's other piece, reversed if it comes before; None if the piece has no pair.
    other: str | None
    after: bool
    #: (offset, text, edits allowed) of each group, smallest first, without the pair and the item.
    groups: list[tuple[int, str, int]]


def pieces(number: int, item: str, errors: int) -> Iterator[tuple[str, Piece]]:
    """The `errors` + 1 pieces of an item, each with what is to be checked around a hit."""
    bounds, count = cuts(item, errors), errors + 1
    for at in range(count):
        low, high = bounds[at], bounds[at + 1]
        pair, groups = at ^ 1, []
        size = 4 if pair < count else 2
        while size < count:
            first = at // size * size
            last = min(first + size, count)
            if last - first > 1:
                groups.append((bounds[first], item[bounds[first] : bounds[last]], last - first - 1))
            size *= 2
        other = item[bounds[pair] : bounds[pair + 1]] if pair < count else None
        after = pair > at
        yield item[low:high], Piece(number, low, other if after or other is None else other[::-1], after, groups)


def begins(text: str, piece: str) -> bool:
    """Whether `text` begins with `piece`, up to one edit, which may be placed at the first difference."""
    if text.startswith(piece):
        return True
    size, at = len(piece), 0
    for a, b in zip(text, piece):
        if a != b:
            break
        at += 1
    rest = piece[at + 1 :]
    return text[at + 1 : size] == rest or text[at : size - 1] == rest or text[at + 1 : size + 1] == piece[at:]


def myers(pattern: str, text: str, limit: int) -> tuple[int, int] | None:
    """Least edit distance of `pattern` to any substring of `text`, and where that first ends.

    None if it is over `limit`. Python's integers carry the bit vectors of a whole pattern.
    """
    size = len(pattern)
    if not size:
        return (0, 0)
    where: dict[str, int] = {}
    for at, c in enumerate(pattern):
        where[c] = where.get(c, 0) | 1 << at
    full, last = (1 << size) - 1, 1 << (size - 1)
    up, down, distance = full, 0, size
    best = (size, 0) if size <= limit else None
    for end, c in enumerate(text, 1):
        same = where.get(c, 0)
        zero = (((same & up) + up) ^ up) | same | down
        right, left = down | (full & ~(zero | up)), up & zero
        if right & last:
            distance += 1
        elif left & last:
            distance -= 1
        right, left = right << 1 & full, left << 1 & full
        up, down = left | (full & ~(zero | right)), right & zero
        if distance <= limit and (best is None or distance < best[0]):
            best = (distance, end)
            if not distance:
                break
    return best


class Matcher:
    """Finds the items of one block in texts; those of fewer than `short` characters and no edits as whole words."""

    def __init__(self, items: list[Item], error_rate: float = ERROR_RATE, short: int = 0):
        self.short = short
        self.items = [(item_id, text, budget(text, error_rate)) for item_id, text in items if text]
        places: dict[str, list[Piece]] = {}
        for number, (_, text, errors) in enumerate(self.items):
            for piece, place in pieces(number, text, errors):
                places.setdefault(piece, []).append(place)
        self.automaton = ahocorasick.Automaton()
        for piece, found in places.items():
            self.automaton.add_word(piece, (len(piece), found))
        if places:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[Match]:
        """(item, least distance, start of its window, its end) of each item within its budget."""
        if not self.items or not text:
            return []
        exact: dict[int, int] = {}
        starts: dict[int, set[int]] = {}
        for end, (size, found) in self.automaton.iter(text):
            at = end + 1 - size
            for piece in found:
                if piece.item in exact:
                    continue
                start = at - piece.offset
                _, item, errors = self.items[piece.item]
                # The piece is the item, so short that it is no news within another word.
                if not errors and len(item) < self.short and not _whole_words(text, at, end + 1):
                    continue
                if start >= 0 and text.startswith(self.items[piece.item][1], start):
                    exact[piece.item] = start
                elif self._grows(text, at, end + 1, piece):
                    starts.setdefault(piece.item, set()).add(start)
        out = [(self.items[n][0], 0, start, start + len(self.items[n][1])) for n, start in exact.items()]
        for number in starts.keys() - exact.keys():
            item_id, pattern, errors = self.items[number]
            best = None
            for low, high in _runs(sorted(starts[number]), errors):
                low, high = max(0, low - errors), high + len(pattern) + errors
                near = myers(pattern, text[low:high], errors if best is None else best[0] - 1)
                if near:
                    best = (near[0], low, low + near[1])
            if best:
                out.append((item_id, *best))
        return out

    @staticmethod
    def _grows(text: str, at: int, end: int, piece: Piece) -> bool:
        """Whether all groups of a piece that is intact at text[at:end] are there within their edits."""
        if piece.other is not None:
            size = len(piece.other) + 1
            beside = text[end : end + size] if piece.after else text[max(0, at - size) : at][::-1]
            if not begins(beside, piece.other):
                return False
        for offset, group, errors in piece.groups:
            low = at - piece.offset + offset
            if myers(group, text[max(0, low - errors) : low + len(group) + errors], errors) is None:
                return False
        return True


def _whole_words(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] neither begins nor ends within a word."""
    begins = not (text[start].isalnum() and text[start - 1 : start].isalnum())
    return begins and not (text[end - 1].isalnum() and text[end : end + 1].isalnum())


def _runs(starts: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """Starts that lie within `gap` of each other share a window."""
    low = high = starts[0]
    for start in starts[1:]:
        if start - high > gap:
            yield low, high
            low = start
        high = start
    yield low, high


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[Item]]:
    """Normalised items of `benchmark` (item_id, text) in blocks of bounded size, without empty ones.

    The driver holds one partition of items and one block at a time.
    """
    block, size = [], 0
    for item_id, text in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        item = normalised(text)
        if not item:
            continue
        if block and size + len(item) > block_chars:
            yield block
            block, size = [], 0
        block.append((item_id, item))
        size += len(item)
    if block:
        yield block


RESULT = pa.schema([(c, pa.int64()) for c in ("doc_id", "item_id", "distance", "start", "end")])
SCHEMA = "doc_id long, item_id long, distance long, start long, end long"


def contaminations(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """(doc_id, item_id, distance, start, end) for each document and item that it holds.

    `distance` is the least edit distance of the item to a passage of the document, after both are
    lower-cased and white space is collapsed; start and end are the window that holds the passage,
    in code points of that form. An item too short for an edit is found as whole words only. Each block of items is matched against all documents in one pass
    without a shuffle, so very long documents and frequent passages stay within one row's work.
    Null and empty texts match nothing, null ids stay null, repeated rows of documents or items give
    repeated rows, and an empty table on either side gives none.
    """
    spark = docs.sparkSession
    workers_import(spark)
    found = spark.createDataFrame([], SCHEMA)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    for block in blocks(benchmark, block_chars):
        found = found.unionAll(slim.mapInArrow(_match_block(block, error_rate), SCHEMA))
    return found


def _match_block(block: list[Item], error_rate: float):
    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block, error_rate, SHORT)
        for part in batches:
            rows = [
                (doc_id, *match)
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)
                for match in matcher.matches(normalised(text))
            ]
            yield batch(RESULT, *(zip(*rows, strict=True) if rows else [[]] * len(RESULT)))

    return matched


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """`docs` without the documents that hold an item. All columns and all other rows stay, also
    those with a null text. It filters row by row, without a join."""
    workers_import(docs.sparkSession)
    for block in blocks(benchmark, block_chars):
        docs = docs.where(~_holds_any(block, error_rate)(F.col("text")))
    return docs


def _holds_any(block: list[Item], error_rate: float):
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block, error_rate, SHORT)
        for texts in batches:
            yield pd.Series([bool(matcher.matches(normalised(t))) for t in texts], dtype=bool)

    holds.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(holds, T.BooleanType())
