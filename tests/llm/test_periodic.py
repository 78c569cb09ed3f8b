"""Periodic runs against a search of every lag."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest

from daylake.llm import periodic, queries

SCHEMA = "doc_id long, text string, runs int, collapsed string, start int"


def plain_runs(words, shortest=12):
    """Every maximal stretch of every lag, kept if no smaller lag holds in all of it."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            part = words[start : i + q]
            least = all(any(part[k] != part[k + r] for k in range(len(part) - r)) for r in range(1, q))
            if len(part) >= max(shortest, 2 * q) and least:
                found.append((start, len(part), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("shortest", [2, 3, 5, 8, 12])
def test_runs_equal_a_search_of_every_lag(shortest):
    rng = random.Random(shortest)
    for _ in range(250):
        n, kinds = rng.randint(0, 130), rng.choice([1, 2, 3, 6, 30])
        words = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randint(0, 3)):
            if n > 4:
                a, q = rng.randrange(n), rng.randint(1, n // 2)
                for i in range(a + q, min(n, a + rng.randint(0, n))):
                    words[i] = words[i - q]
        assert periodic.runs(words, shortest) == plain_runs(words, shortest)


def test_long_and_regular_texts():
    word, other = [1, 2], [1]
    while len(word) < 500:
        word, other = word + other, word
    assert periodic.runs(word) == plain_runs(word)
    thue = [bin(i).count("1") % 2 for i in range(512)]
    assert periodic.runs(thue) == plain_runs(thue)
    assert periodic.runs([7] * 60_000) == [(0, 60_000, 1)]
    broken = [7] * 30_000 + [8] + [7] * 30_000
    assert periodic.runs(broken) == [(0, 30_000, 1), (30_001, 30_000, 1)]
    assert periodic.runs(list(range(9)) * 5_000) == [(0, 45_000, 9)]


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)

    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], digest(listed), digest(kept))


def test_query_equals_plain_python(spark, small):
    got = {r.doc_id: tuple(r) for r in queries.op11_periodic_runs(spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    checked = [r for r in docs if len((r.text or "").split()) < 600 or zlib.crc32(str(r.doc_id).encode()) % 10 == 0]
    checked = [r for r in checked if len((r.text or "").split()) < 1_500]
    assert sum(got[r.doc_id][1] > 0 for r in checked) > 10
    for r in checked:
        assert got[r.doc_id] == plain_row(r.doc_id, r.text)


def test_awkward_rows(spark):
    line = "one two three four " * 6
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, line), (4, line), (None, line), (None, None), (5, "ein wort " * 20), (6, "x" * 300_000)]
    df = spark.createDataFrame([(i, t, 1, "c", 2) for i, t in rows], SCHEMA)
    got = sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(df).collect()), key=repr)
    four = [(0, 24, 4)]
    assert got == sorted(
        [(1, [], ""), (2, [], ""), (3, [], ""), (4, four, "one two three four"), (4, four, "one two three four"),
         (None, four, "one two three four"), (None, [], ""), (5, [(0, 20, 1)], "ein wort"), (6, [], "x" * 300_000)],
        key=repr,
    )
    assert periodic.periodic_runs(df.limit(0)).count() == 0
    assert periodic.periodic_runs(df, repeats=periodic.planted_repeats).count() == len(rows)


def test_plan_has_no_shuffle(spark, small):
    plan = queries.op11_periodic_runs(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("MapInArrow") == 1
