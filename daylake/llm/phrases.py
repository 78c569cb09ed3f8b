"""Substring dedup by repeated-phrase automata: every word in a run of `window` words that occurs again goes.

1. Documents are dealt into blocks of bounded size, each stored as one row.
2. Of the grams in a window, the one with the least hash is its anchor. Equal windows have equal anchors, so
   only windows whose anchor occurs twice can recur. A block sends each anchor once.
3. A block sends the hash of each such window once, with its first place. Those that occur twice anywhere are
   confirmed, and go back to their blocks.
4. Consecutive confirmed windows of a block are its recurring passages. A phrase is cut from them at so
   short a step that every window holds one whole. Aho-Corasick automata over the phrases, sharded by block
   and by passages within it, stream all documents of the block; each hit is extended word by word along
   its passage, and where `window` words agree, they are covered.

A passage consists of confirmed windows, so whatever agrees with it recurs; and each window that recurs lies
in a passage of its block, where a phrase of it is found. Results are therefore whole and exact but for
hashes of 128 bits, which name windows of the whole corpus; words are compared within a block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import compress
from math import isqrt

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daylake.llm.common import batch, stored, texts_as_bytes, workers_import

WINDOW = 35
#: Words of an anchor and of a phrase.
GRAM = 12
#: Text of a block, in bytes; a longer text is a block of its own.
BLOCK_BYTES = 4_000_000
#: Words of the passages in one automaton.
SHARD_WORDS = 500_000

DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])
BLOCKS = pa.schema([("block", pa.int64()), ("docs", pa.binary())])
ANCHORS = pa.schema([("anchor", pa.int64()), ("block", pa.int64()), ("n", pa.int32())])
WINDOWS = pa.schema(
    [("h1", pa.int64()), ("h2", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("n", pa.int32())]
)
KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
#: Odd factors of the two hashes.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def blocks_of(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """(block, docs): documents in order, as a compressed Arrow stream of about `size` bytes of text."""
    workers_import(docs.sparkSession)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[bytes] = []
        held = 0
        for rows in batches:
            for doc_id, text in zip(rows.column(0).to_pylist(), texts_as_bytes(rows.column(1)), strict=True):
                if held and held + len(text) > size:
                    yield batch(BLOCKS, [block], [_packed(ids, texts)])
                    block, ids, texts, held = block + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                held += len(text) + 1
        if ids:
            yield batch(BLOCKS, [block], [_packed(ids, texts)])

    return docs.mapInArrow(dealt, "block long, docs binary")


def _packed(ids: list, texts: list[bytes]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, DOCS, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch(DOCS, ids, texts))
    return sink.getvalue().to_pybytes()


class Block:
    """The words of a block's documents one after the other."""

    def __init__(self, packed: bytes):
        docs = pa.ipc.open_stream(packed).read_all()
        self.ids = docs.column(0).to_pylist()
        split = [text.split() for text in docs.column(1).to_pylist()]
        self.sizes = np.fromiter(map(len, split), np.int64, len(split))
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.words = [word for words in split for word in words]
        self.vocabulary = {word: n for n, word in enumerate(dict.fromkeys(self.words))}
        number = self.vocabulary.__getitem__
        self.numbers = np.fromiter(map(number, self.words), np.int32, len(self.words))

    def hashes(self) -> np.ndarray:
        """Two 64-bit hashes of each word, shaped (2, words)."""
        digest = xxhash.xxh3_128_digest
        joined = b"".join(map(digest, self.vocabulary))
        return np.frombuffer(joined, ">u8").astype(np.uint64).reshape(-1, 2).T[:, self.numbers]

    def whole(self, window: int) -> np.ndarray:
        """For each place at which a window may start, whether it ends within the document."""
        ends = np.repeat(self.starts[1:], self.sizes)
        return (np.arange(len(self.words)) + window <= ends)[: max(0, len(self.words) - window + 1)]


def spans_hashed(words: np.ndarray, length: int, factor: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of every run of `length` words: runs of doubled length are put together."""
    total, done, size, power = np.zeros(max(0, len(words) - length + 1), np.uint64), 0, 1, words
    while True:
        if length & size:
            at = length - done - size
            total += power[at : at + len(total)] * np.uint64(pow(factor, done, 1 << 64))
            done += size
        if done == length:
            return total
        power = power[:-size] * np.uint64(pow(factor, size, 1 << 64)) + power[size:]
        size *= 2


def _sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """`choose` (minimum or maximum) over each `width` consecutive values."""
    done = 1
    while done * 2 <= width:
        values = choose(values[:-done], values[done:])
        done *= 2
    return choose(values[: len(values) - width + done], values[width - done :]) if done < width else values


def anchors(words: np.ndarray, whole: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor of each window, anchor of each of its distinct places); hashes of words are given.

    The anchor of a window that does not lie in one document is 0, which no other one is.
    """
    if not len(whole):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = spans_hashed(words, gram, FACTORS[0])
    grams ^= grams >> np.uint64(29)
    grams *= np.uint64(FACTORS[1])
    grams = grams ^ grams >> np.uint64(32) | np.uint64(1)
    wide = window - gram + 1
    of_window = np.where(whole, _sliding(grams, wide, np.minimum), np.uint64(0))
    edge = np.zeros(wide - 1, np.uint64)
    # A gram is an anchor if it is the least of any window around it.
    best = _sliding(np.concatenate([edge, of_window, edge]), wide, np.maximum)
    return of_window, grams[grams == best]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for rows in batches:
        for i in range(rows.num_rows):
            yield rows.column(0)[i].as_py(), Block(rows.column(1)[i].as_py()), *(c[i] for c in rows.columns[2:])


def _emit_anchors(window: int, gram: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block in _blocks(batches):
            found, n = np.unique(anchors(block.hashes()[0], block.whole(window), window, gram)[1], return_counts=True)
            yield batch(ANCHORS, found.view(np.int64), np.full(len(found), number), n.astype(np.int32))

    return emit


def _emit_windows(window: int, gram: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, block, shared in _blocks(batches):
            words = block.hashes()
            of_window, _ = anchors(words[0], block.whole(window), window, gram)
            recurring = np.array(shared.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64)
            place = np.flatnonzero(np.isin(of_window, recurring))
            h1, h2 = (spans_hashed(w, window, f)[place] for w, f in zip(words, FACTORS, strict=True))
            # Stable, so the first of equal windows is the first in the block.
            order = np.lexsort((h2, h1))
            h1, h2, place = h1[order], h2[order], place[order]
            new = np.ones(len(h1), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            first = np.flatnonzero(new)
            n = np.diff(np.concatenate([first, [len(h1)]]))
            yield batch(
                WINDOWS, h1[first].view(np.int64), h2[first].view(np.int64), np.full(len(first), number),
                place[first].astype(np.int32), n.astype(np.int32),
            )

    return emit


def passages(places: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of words that consecutive windows at sorted `places` make up."""
    if len(places):
        gap = np.flatnonzero(np.diff(places) > 1)
        starts, lasts = places[np.concatenate([[0], gap + 1])], places[np.concatenate([gap, [len(places) - 1]])]
        yield from zip(starts.tolist(), (lasts + window).tolist(), strict=True)


class PhraseAutomaton:
    """An Aho-Corasick automaton over phrases cut from passages.

    A word's number, below `numbers`, is written as two letters, its quotient and rest by the root of `numbers`:
    a state then has few branches to search, the first one above all.
    """

    def __init__(self, pieces: list[np.ndarray], numbers: int, window: int, gram: int):
        self.window, self.gram = window, gram
        # Marks are the numbers -1 and -2.
        self.base = isqrt(numbers + 2) + 1
        mark = np.array([-2], np.int32)
        self.text = np.concatenate([part for piece in pieces for part in (piece, mark)])
        written = self._written(self.text)
        places: dict[str, list[int]] = defaultdict(list)
        step, at = window - gram + 1, 0
        for piece in pieces:
            for place in range(at, at + len(piece) - gram + 1, step):
                places[written[2 * place : 2 * (place + gram)]].append(place)
            at += len(piece) + 1
        self.automaton = ahocorasick.Automaton()
        for phrase, found in places.items():
            self.automaton.add_word(phrase, found)
        self.automaton.make_automaton()

    def _written(self, numbers: np.ndarray) -> str:
        letters = np.stack(np.divmod(numbers + 2, self.base), axis=1) + 1
        return letters.astype("<u4").tobytes().decode("utf-32-le")

    def cover(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """(start, end) of the runs of `numbers` that agree with a passage in `window` words or more."""
        reached: dict[int, int] = {}
        for end, places in self.automaton.iter(self._written(numbers)):
            if not end % 2:
                continue  # a hit from the middle of one word to that of another
            start = end // 2 - self.gram + 1
            for place in places:
                # What is matched along one diagonal needs no second look.
                if reached.get(start - place, 0) > start:
                    continue
                ahead = _agreement(numbers[start:], self.text[place:])
                back = _agreement(numbers[:start][::-1], self.text[:place][::-1])
                reached[start - place] = start + ahead
                if back + ahead >= self.window:
                    yield start - back, start + ahead


def _agreement(one: np.ndarray, other: np.ndarray) -> int:
    """How many leading numbers are equal."""
    done, size, length = 0, 64, min(len(one), len(other))
    while done < length:
        differ = one[done : min(done + size, length)] != other[done : min(done + size, length)]
        if (first := int(differ.argmax())) or differ[0]:
            return done + first
        done, size = done + len(differ), size * 4
    return length


def covered(block: Block, places: np.ndarray, window: int, gram: int, shard: int = SHARD_WORDS) -> np.ndarray:
    """For each word of the block, whether a recurring window holds it. `places` are those of confirmed windows."""
    # A mark between documents keeps agreement from running on.
    ends = block.starts[1:]
    marked = np.insert(block.numbers, ends, -1)
    shift = np.repeat(np.arange(len(ends)), block.sizes)
    steps = np.zeros(len(marked) + 1, np.int64)
    pieces: list[np.ndarray] = []
    held = 0

    def stream() -> None:
        for start, end in PhraseAutomaton(pieces, len(block.vocabulary), window, gram).cover(marked):
            steps[start] += 1
            steps[end] -= 1

    for start, end in passages(places, window):
        # A passage longer than a shard is cut into pieces that share all but one word of a window.
        for at in range(start, end - window + 1, shard):
            piece = block.numbers[at : min(end, at + shard + window - 1)]
            if held and held + len(piece) > shard:
                stream()
                pieces, held = [], 0
            pieces.append(piece)
            held += len(piece)
    if pieces:
        stream()
    return np.cumsum(steps)[np.arange(len(block.numbers)) + shift] > 0


def _strip(window: int, gram: int):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, places in _blocks(batches):
            at = np.sort(np.array(places.values.to_numpy(zero_copy_only=False), np.int64)) if places.is_valid else []
            gone = covered(block, np.asarray(at, np.int64), window, gram)
            out = []
            for doc_id, start, end in zip(block.ids, block.starts[:-1].tolist(), block.starts[1:].tolist(), strict=True):
                lost, words = gone[start:end], block.words[start:end]
                removed = int(lost.sum())
                kept = compress(words, (~lost).tolist()) if removed else words
                out.append((doc_id, end - start, removed, b" ".join(kept).decode()))
            yield batch(KEPT, *zip(*out, strict=True))

    return strip


def _recurring(rows: DataFrame, *key: str) -> DataFrame:
    """Rows whose key occurs twice in all blocks together. A block brings a key once, so no key has more rows than there are blocks."""
    total = F.sum("n").over(Window.partitionBy(*key))
    return rows.withColumn("total", total).filter("total > 1")


def without_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    text: str = "text",
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per row: the words that no recurring window holds, joined by a space.

    Words are split at ASCII white space and kept as they are. A window is `window` words of one document; it
    recurs if its words also start anywhere else, also in the same document and overlapping it. All windows
    are judged on the input, and so both copies go. A null text has no words; repeated ids and rows are
    documents of their own; a null id stays null; an empty table gives no rows; other columns are not read.
    A task holds one block at a time.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram has between one word and those of a window")
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # Said once for both joins, so that they share one shuffle of the blocks.
    blocks = stored(blocks_of(slim, block_bytes), "phrases-blocks").filter("block IS NOT NULL")
    anchored = blocks.mapInArrow(_emit_anchors(window, gram), "anchor long, block long, n int")
    shared = _recurring(anchored, "anchor").groupBy("block").agg(F.collect_list("anchor").alias("anchors"))
    windows = blocks.join(shared, "block").mapInArrow(
        _emit_windows(window, gram), "h1 long, h2 long, block long, place int, n int"
    )
    confirmed = _recurring(windows, "h1", "h2").groupBy("block").agg(F.collect_list("place").alias("places"))
    return blocks.join(confirmed, "block", "left").mapInArrow(
        _strip(window, gram), "doc_id long, n_words long, n_removed long, kept string"
    )
