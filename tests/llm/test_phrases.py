"""Removal of recurring windows against a count of all windows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from daylake.llm import phrases, queries

SCHEMA = "doc_id long, text string, block int, docs string, place int, kept string, n int"


def plain_removed(texts, window):
    """(words, whether each is removed) of each text."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((words, gone))
    return out


def random_texts(rng, most=8):
    letters = [chr(97 + i) for i in range(rng.choice([1, 2, 4, 20]))]
    texts = []
    for _ in range(rng.randint(0, most)):
        words = [rng.choice(letters) for _ in range(rng.randint(0, 60))]
        if texts and rng.random() < 0.6 and (other := rng.choice(texts).split()):
            a = rng.randrange(len(other))
            words[len(words) // 2 : len(words) // 2] = other[a : a + rng.randint(0, 40)]
        texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("window, gram", [(5, 1), (5, 5), (8, 3), (13, 4), (35, 12)])
def test_core_equals_a_count_of_all_windows(window, gram):
    """The steps of each block as plain calls, with shards as small as can be."""
    rng = random.Random(window * 100 + gram)
    for _ in range(80):
        texts, blocks = random_texts(rng), []
        while sum(len(b.ids) for b in blocks) < len(texts):
            at, n = sum(len(b.ids) for b in blocks), rng.randint(1, 4)
            part = [t.encode() for t in texts[at : at + n]]
            blocks.append(phrases.Block(phrases._packed(list(range(len(part))), part)))
        anchored = [phrases.anchors(b.hashes()[0], b.whole(window), window, gram) for b in blocks]
        twice = [a for a, n in Counter(x for _, found in anchored for x in found.tolist()).items() if n > 1]
        keys, seen = [], Counter()
        for block, (of_window, _) in zip(blocks, anchored, strict=True):
            place = np.flatnonzero(np.isin(of_window, np.array(twice, np.uint64)))
            hashed = [phrases.spans_hashed(w, window, f)[place].tolist() for w, f in zip(block.hashes(), phrases.FACTORS)]
            keys.append(list(zip(place.tolist(), zip(*hashed))))
            seen.update(k for _, k in keys[-1])
        got = []
        for block, found in zip(blocks, keys, strict=True):
            first = {}
            for place, key in found:
                if seen[key] > 1:
                    first.setdefault(key, place)
            gone = phrases.covered(block, np.array(sorted(first.values()), np.int64), window, gram, rng.choice([7, 30, 1_000]))
            got += [gone[a:b].tolist() for a, b in zip(block.starts[:-1], block.starts[1:])]
        assert got == [gone for _, gone in plain_removed(texts, window)]


def test_hash_of_spans_is_the_plain_polynomial():
    words = np.random.default_rng(2).integers(0, 1 << 63, 90).astype(np.uint64)
    for length in (1, 2, 3, 12, 35, 64, 90):
        want = []
        for i in range(90 - length + 1):
            h = 0
            for x in words[i : i + length].tolist():
                h = (h * phrases.FACTORS[0] + x) % (1 << 64)
            want.append(h)
        assert phrases.spans_hashed(words, length, phrases.FACTORS[0]).tolist() == want
    assert len(phrases.spans_hashed(words, 91, 3)) == 0


@pytest.mark.parametrize("block_bytes", [1, 150, 4_000_000])
def test_operator_equals_a_count_of_all_windows(spark, block_bytes):
    rng = random.Random(block_bytes)
    texts = [t for _ in range(6) for t in random_texts(rng, 12)]
    df = spark.createDataFrame([(i, t, 1, "d", 2, "k", 3) for i, t in enumerate(texts)], SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in phrases.without_repeats(df, 8, gram=3, block_bytes=block_bytes).collect()}
    want = {
        i: (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
        for i, (words, gone) in enumerate(plain_removed(texts, 8))
    }
    assert got == want


def test_query_equals_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = {
        r.doc_id: (len(words), sum(gone), hashlib.sha256(" ".join(w for w, g in zip(words, gone) if not g).encode()).hexdigest())
        for r, (words, gone) in zip(docs, plain_removed([r.text for r in docs], 35), strict=True)
    }
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op13_substring_dedup(spark, small).collect()}
    assert got == want and sum(n > 0 for _, n, _ in got.values()) > 5


def test_awkward_rows(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, passage), (4, passage), (None, f"x {passage}\n y"), (None, None), (5, long), (6, "same " * 34), (7, "same\t" * 36), (8, "é" * 200_000)]
    df = spark.createDataFrame([(i, t, 1, "d", 2, "k", 3) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in phrases.without_repeats(df).collect()), key=repr)
    assert got == sorted(
        [(1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, ""), (4, 40, 40, ""), (4, 40, 40, ""), (None, 42, 40, "x y"), (None, 0, 0, ""),
         (5, 60_000, 60_000, ""), (6, 34, 0, "same " * 33 + "same"), (7, 36, 36, ""), (8, 1, 0, "é" * 200_000)],
        key=repr,
    )
    assert phrases.without_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        phrases.without_repeats(df, 5, gram=6)
