"""The language model's restaurants of preceding words, learned from the whole corpus."""

from __future__ import annotations

import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from daylake.llm import lm
from daylake.llm.common import batch, packed_numbers, stored_by, unpacked_numbers
from daylake.llm.pitmanyor import Keyed, draw_tables, draws_of_tables, mixed


def learned(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 != 2


def test_order_of_words_is_learned_from_other_texts(spark):
    rng = np.random.default_rng(1)
    names = [f"w{i}" for i in range(40)]
    # Each word is followed by one of two; all are about as frequent.
    rows, at = [], 0
    for doc_id in range(400):
        text = []
        for _ in range(30):
            text.append(names[at])
            at = (7 * at + 3 + int(rng.integers(0, 2))) % 40
        rows.append((doc_id, " ".join(text)))
    held = next(i for i in range(1_000, 2_000) if not learned(i))
    other = next(i for i in range(held + 1, 2_000) if not learned(i))
    like = [3]
    while len(like) < 30:
        like.append((7 * like[-1] + 3) % 40)
    unlike = [like[i] for i in rng.permutation(30)]
    rows += [(held, " ".join(names[i] for i in like)), (other, " ".join(names[i] for i in unlike))]
    got = {r.doc_id: r for r in lm.scored_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[held].base_score == pytest.approx(got[other].base_score)
    assert got[held].score > got[other].score + 5


def corpus(spark, *more):
    texts = ["a b a b a c", "b a", "a b c d", "d d d a", "c"] * 8
    train = [i for i in range(200) if learned(i)][: len(texts)]
    held = [i for i in range(200, 400) if not learned(i)]
    rows = [*zip(train, texts, strict=True), *zip(held, more, strict=False)]
    return texts, spark.createDataFrame(rows, "doc_id long, text string")


def test_tables_of_pairs_are_customers_of_words(spark, monkeypatch):
    texts, docs = corpus(spark, "a", "", "d x d")
    seen, real = [], lm._score_block
    monkeypatch.setattr(lm, "_score_block", lambda totals: seen.append(totals) or real(totals))
    result = lm.scored_documents(docs.repartition(3)).collect()
    tokens = Counter(w for t in texts for w in [*t.split(), ""])
    assert (seen[0].tokens, seen[0].types) == (sum(tokens.values()), 5)
    pairs = Counter(p for t in texts for p in zip(["", *t.split()], [*t.split(), ""], strict=True))
    assert len(pairs) <= seen[0].customers < sum(pairs.values())
    assert all(np.isfinite(r.score) and r.score < 0 for r in result) and len(result) == len(texts) + 3


def test_blocks_agree_on_counts_and_tables():
    hashes = {b"x": 11, b"y": -5, b"z": 2**40, b"": 3}

    def rows(block, texts, order, train):
        at = {w: i for i, w in enumerate(order)}
        ids = [np.array([at[w] for w in [*t.split(), b""]], "<u4").tobytes() for t in texts]
        n, k = len(ids), len(order)
        return pa.table(
            {
                "block": pa.array([block] * (n + k)),
                "train": pa.array([*train, *[None] * k]),
                "ids": pa.array([*ids, *[None] * k], pa.binary()),
                "local": pa.array([*[None] * n, *range(k)], pa.int64()),
                "key": pa.array([42] * n + [hashes[w] for w in order]),
            }
        )

    texts = [b"x y x y z", b"x y", b""], [b"y x y", b"z z z z"]
    train = [True, False, True], [True, True]
    blocks = [
        rows(0, texts[0], [b"x", b"y", b"z", b""], train[0]),
        rows(1, texts[1], [b"z", b"", b"y", b"x"], train[1]),
    ]
    want = Counter(
        p
        for some, used in zip(texts, train, strict=True)
        for t, u in zip(some, used, strict=True)
        if u
        for p in zip([b"", *t.split()], [*t.split(), b""], strict=True)
    )
    summed = lm._summed_pairs(pa.concat_tables(lm._sent_pairs(1)(b) for b in blocks))
    spoken = Counter()
    for of, order in ((0, [b"x", b"y", b"z", b""]), (1, [b"z", b"", b"y", b"x"])):
        block = lm._block(blocks[of])
        (counts,) = [unpacked_numbers(r["c"], "<i8") for r in summed.to_pylist() if r["of"] == of]
        for before, word, n in zip(block.before, block.word, counts, strict=True):
            assert n >> 1 == want[order[before], order[word]]
            if n & 1:
                spoken[order[before], order[word]] += n >> 1
        keys = mixed(*(np.array([hashes[order[i]] for i in x], np.int64).view(np.uint64) for x in (block.before, block.word)))
        assert (keys == block.key).all()
    assert +spoken == want
    assert sum(summed["once"].to_pylist()) == sum(n == 1 for n in want.values())
    assert sum(summed["twice"].to_pylist()) == sum(n == 2 for n in want.values())


def test_chances_after_a_word_sum_to_one(spark, monkeypatch):
    """They do if customers and tables of a preceding word are the sums over its pairs."""

    def pairs_of(totals):
        def rows(rows, told):
            block = lm._block(rows)
            _, _, c, t, (pairs,) = lm._told(len(rows) - len(block.docs), told)
            n, tables = (unpacked_numbers(pairs[x], "<i8") for x in "ct")
            size, u = len(n), block.before
            return pa.Table.from_batches([batch(lm.RESULT, u, [False] * size, block.word, n, tables, c[u], t[u])])

        return rows

    texts, docs = corpus(spark, "a a b b c c d d a d b d", "")
    monkeypatch.setattr(lm, "_score_block", pairs_of)
    rows = lm.scored_documents(docs.coalesce(1)).toDF("before", "held", "word", "n", "tables", "c", "t").collect()
    assert sum(r.n for r in rows) == sum(len(t.split()) + 1 for t in texts)
    assert any(r.n == 0 for r in rows) and any(r.tables < r.n for r in rows)
    for u in {r.before for r in rows}:
        some = [r for r in rows if r.before == u]
        assert {(r.c, r.t) for r in some} == {(sum(r.n for r in some), sum(r.tables for r in some))}
        assert all(min(r.n, 1) <= r.tables <= r.n for r in some)


def test_keyed_draws_follow_the_exact_chances():
    keys = np.random.default_rng(0).integers(0, 2**63, 40_000).astype(np.uint64)
    drawn = draw_tables(np.full(40_000, 3), np.full(40_000, 0.7), 0.5, Keyed(keys))
    stay = {1: 0.5 * 1.5, 2: 0.5 + 1.0, 3: 1.0}  # S(3, t) at a discount of a half
    weights = np.array([stay[t] * 0.7**t for t in (1, 2, 3)])
    assert np.bincount(drawn, minlength=4)[1:] / 40_000 == pytest.approx(weights / weights.sum(), abs=0.01)
    some = np.arange(0, 40_000, 7)
    assert (draw_tables(np.full(len(some), 3), np.full(len(some), 0.7), 0.5, Keyed(keys[some])) == drawn[some]).all()
    # Beyond the customers that are taken as a whole they agree with a generator's draws on the mean.
    many, alpha = np.full(4_000, 9_000), np.full(4_000, 2.0)
    late, drawn = (draw_tables(many, alpha, 0.5, rng) for rng in (Keyed(keys[:4_000]), np.random.default_rng(0)))
    assert late.mean() == pytest.approx(drawn.mean(), rel=0.02)


def test_numbers_are_packed_and_tables_are_read_by_key(spark):
    for values in (np.arange(300, dtype="<u4"), np.zeros(0, "<i8"), np.array([-2.5, 1e-9], "<f4"), np.array([2**63], "<u8")):
        assert (unpacked_numbers(packed_numbers(values), values.dtype.str) == values).all()
    kept = stored_by(spark.range(100).selectExpr("id % 7 as k", "id"), "k", "some-rows")
    counted = kept.groupBy("k").count()
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["count"] for r in counted.collect()) == [14] * 5 + [15] * 2


def test_blocks_hold_the_hashes_of_their_words_in_few_rows(monkeypatch):
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    texts = [None, "", " \n", "A b\x0bc\x0cÉ a", "\x1cx\x85y z\xa0 B ", "b b", "  lead  two "] + [f"w{i}" for i in range(30_000)]
    train = [i % 3 > 0 for i in range(len(texts))]
    split = [[*(t or "").encode().lower().split(), b""] for t in texts]
    rows = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text": texts, "train": train})
    for tokens, words, blocks in ((10**7, 10**7, 1), (1_000, 10**7, None), (10**7, 1_000, None)):
        monkeypatch.setattr(lm, "BLOCK_TOKENS", tokens)
        monkeypatch.setattr(lm, "BLOCK_WORDS", words)
        monkeypatch.setattr(lm, "BYTES_AT_ONCE", 20_000)
        out = pa.Table.from_batches(lm._code(iter([rows]))).to_pylist()
        dictionary = {(r["block"], r["local"]): r for r in out if r["word"] is not None}
        docs, keys = [r for r in out if r["ids"] is not None], [r for r in out if r["key"] is not None]
        assert len(docs) + len(keys) + len(dictionary) == len(out)
        found = {b for b, _ in dictionary}
        assert len(found) == blocks if blocks else len(found) > 1
        assert len(keys) <= len(dictionary) // 20_000 + len(found)
        counts = Counter()
        for r, used, want in zip(docs, train, split, strict=True):
            ids = [(r["block"], i) for i in np.frombuffer(r["ids"], "<u4").tolist()]
            assert [dictionary[i]["word"] for i in ids] == want
            counts.update(ids if used else [])
        assert all(r["n_train"] == counts[i] for i, r in dictionary.items())
        for r in keys:
            for at, key in enumerate(np.frombuffer(r["key"], "<u8").tolist(), r["local"]):
                assert key == xxhash.xxh64_intdigest(dictionary[r["block"], at]["word"], 42)


def test_draws_side_by_side_are_those_of_each_generator():
    rng = np.random.default_rng(2)
    c, alpha = rng.zipf(1.4, 5_000).clip(max=2_000) - rng.integers(0, 2, 5_000), 10.0 ** rng.uniform(-6, 2, 5_000)
    both = draws_of_tables(c, alpha, 0.6, [np.random.default_rng(k) for k in (4, 5)])
    for k, drawn in zip((4, 5), both, strict=True):
        assert (drawn == draw_tables(c, alpha, 0.6, np.random.default_rng(k))).all()
        assert (drawn <= c).all() and ((drawn > 0) == (c > 0)).all()
