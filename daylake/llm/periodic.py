"""Periodic runs of words: seeds on diagonals, extended once.

A run of period q and length n agrees with itself, shifted by q, in n - q words: at least `shortest` - q and,
since it holds two periods, at least q. So a run with a lag below twice the least such overlap shares a gram of
that many words with itself at its lag, one with a longer lag a gram twice as long, and so on. For each
length in that doubling row, grams are indexed, pairs of their occurrences within one document and within
the lags of that row are enumerated, and each pair is extended to the right along its diagonal.

Two rules keep the pairs of a document few, whatever it holds. Occurrences at most half a gram apart lie
in one run of a shorter period, so pairs among them show no run of their own. Of other pairs only those
matter in which one side has no such occurrence before it, since every other one lies inside a stretch that
starts earlier. A table of how far each lag is covered keeps stretches from being extended again.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import batch, texts_as_bytes, workers_import

#: Least words of a run.
SHORTEST = 12
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


def planted_repeats(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """(a, p) for one document in ten: its words from place a on are to repeat with period p. A null id has none."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    a = h // 10 % n
    return a, 1 + (n - a) // (3 + h // 10 % 8)


class Names:
    """Numbers of grams: two places have the same number if their grams have the same words. By length, `shortest` / 2
    times a power of two and the steps down from there to one word."""

    def __init__(self, words: np.ndarray, gram: int):
        self.words, self.n = words, len(words)
        self.of = {1: words}
        self.gram(gram)

    def gram(self, length: int) -> np.ndarray:
        """The numbers of all grams of `length` words: those of its two halves put together."""
        if length not in self.of:
            half = (length + 1) // 2
            part = self.gram(half).astype(np.int64)
            count = max(0, self.n - length + 1)
            # Halves of odd lengths overlap by one word.
            both = part[:count] * (int(part.max(initial=0)) + 1) + part[length - half : length - half + count]
            self.of[length] = np.unique(both, return_inverse=True)[1].astype(np.int32)
        return self.of[length]

    def agreement(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many words agree from each place of `one` and `other` on; `one` < `other`."""
        done = np.zeros(len(one), np.int64)
        for length in sorted(self.of, reverse=True):
            names, going = self.of[length], np.arange(len(one))
            while len(going):
                going = going[other[going] + done[going] + length <= self.n]
                going = going[names[one[going] + done[going]] == names[other[going] + done[going]]]
                done[going] += length
        return done


def _pairs_near(names: np.ndarray, last: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of all pairs of equal grams with lags up to `last`."""
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rank in range(1, last + 1):
        lag = order[rank:] - order[:-rank]
        here = (sorted_names[rank:] == sorted_names[:-rank]) & (lag <= last)
        if not here.any():
            break
        places.append(order[:-rank][here])
        lags.append(lag[here])
    return np.concatenate(places), np.concatenate(lags)


def _pairs_beyond(names: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of the pairs that matter of equal grams, with lags from `gram` to below twice that."""
    order = np.argsort(names, kind="stable").astype(np.int64)
    key = names[order].astype(np.int64) * (3 * len(names) + 1) + order
    gap = np.diff(key, prepend=-gram)
    leads = gap > gram // 2
    chain = np.cumsum(leads)

    def partners(of: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of `of` with the ranks of each occurrence of the same gram that lies `low` to `high` after."""
        first = np.searchsorted(key, key[of] + low)
        n = np.searchsorted(key, key[of] + high, "right") - first
        mine = np.repeat(of, n)
        theirs = np.arange(len(mine)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        other = chain[mine] != chain[theirs]
        return mine[other], theirs[other]

    leading = np.flatnonzero(leads)
    a, b = partners(leading, gram, 2 * gram - 1)
    d, c = partners(leading, 1 - 2 * gram, -gram)
    c, d = c[~leads[c]], d[~leads[c]]
    left, right = np.concatenate([a, c]), np.concatenate([b, d])
    return order[left], order[right] - order[left]


def _stretches(names: Names, places: np.ndarray, lags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, lag, words that agree) of seeds, extended to the right; those that an earlier one covers are passed over."""
    width = names.n + 1
    seeds = np.unique(lags * width + places)
    table = np.unique(lags)
    reach = np.searchsorted(seeds, table * width)
    found = []
    while len(table):
        start = seeds[reach] - table * width
        agree = names.agreement(start, start + table)
        found.append((start, table, agree))
        # The furthest covered place of each lag, and the next seed beyond it.
        reach = np.searchsorted(seeds, table * width + start + np.maximum(agree, 1))
        more = reach < len(seeds)
        more[more] = seeds[reach[more]] // width == table[more]
        table, reach = table[more], reach[more]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p <= isqrt(n):
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def runs(words: list, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period.

    A run is a stretch of consecutive words, of its least period, that no neighbouring word extends keeping that
    period, and that holds two periods and `shortest` words (at least two).
    """
    n = len(words)
    if shortest < 2:
        raise ValueError("a run has two words at least")
    if n < shortest:
        return []
    number = {word: i for i, word in enumerate(dict.fromkeys(words))}.__getitem__
    # Lags below `near` overlap in `least` words at least; so does that lag itself.
    least = (shortest + 1) // 2
    names = Names(np.fromiter(map(number, words), np.int32, n), least)
    found = []
    gram = least
    while gram == least or gram <= n // 2:
        grams = names.gram(gram)
        if len(grams) == int(grams.max()) + 1:
            break  # every gram, and so every longer one, occurs once
        pairs = _pairs_near(grams, 2 * gram - 1) if gram == least else _pairs_beyond(grams, gram)
        start, lag, agree = _stretches(names, *pairs)
        long = agree >= np.maximum(lag, shortest - lag)
        for s, q, a in zip(start[long].tolist(), lag[long].tolist(), agree[long].tolist(), strict=True):
            whole = names.words[s : s + a + q]
            if not any(np.array_equal(whole[q // p :], whole[: -(q // p)]) for p in _prime_factors(q)):
                found.append((s, a + q, q))
        gram *= 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """Words without those that any run holds after its first period."""
    steps = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    return list(compress(words, (np.cumsum(steps[:-1]) == 0).tolist())) if found else words


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shortest: int = SHORTEST,
    repeats: Callable[[int | None, int], tuple[int, int] | None] | None = None,
) -> DataFrame:
    """(doc_id, runs, collapsed) per row: its runs by start and period, and its words without their repetitions.

    Words are split at ASCII white space and joined by one space. `repeats(doc_id, n)` may give (a, p): the n words
    are first changed so that those from place a on repeat the p words there. A null or empty text has no runs and
    an empty result; a null id stays null; repeated rows are documents of their own; an empty table gives no
    rows; other columns are not read. Work grows with n log n in the n words of a text, memory as well: some 4
    bytes a word for each doubling up to half of the text in which a gram still occurs twice.
    """
    workers_import(docs.sparkSession)

    def one(doc_id: int | None, text_: bytes) -> tuple:
        words = text_.split()
        if repeats is not None and (plan := repeats(doc_id, len(words))):
            a, p = plan
            words = words[:a] + (words[a : a + p] * ((len(words) - a) // p + 1))[: len(words) - a]
        found = runs(words, shortest)
        rows = [{"start": s, "length": n, "period": q} for s, n, q in found]
        return doc_id, rows, b" ".join(collapsed(words, found)).decode()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            # Few texts at a time, so that what is held besides the batch is small.
            for at in range(0, rows.num_rows, 256):
                some = rows.slice(at, 256)
                ids, texts = some.column(0).to_pylist(), texts_as_bytes(some.column(1))
                yield batch(FOUND, *zip(*map(one, ids, texts), strict=True))

    return docs.select(F.col(id_column).cast("long"), text).mapInArrow(
        search, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
