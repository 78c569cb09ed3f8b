"""The statistics of quality rules restated on whole texts."""

from __future__ import annotations

import re
from collections import Counter

from daylake.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    """(words, code points in them, symbols, repeated lines, words in repeated windows of three)."""
    words = WORD.findall(text or "")
    lines, seen, repeated = [x for x in (text or "").split("\n") if WORD.search(x)], set(), 0
    for line in lines:
        repeated += line in seen
        seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    inside = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(inside)


def test_counts_of_all_documents_equal_plain_python(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    got = queries.op6_quality_rules(spark, small).collect()
    assert len(got) == len(texts)
    for r in got:
        n, chars, symbols, lines, repeated = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, lines, repeated)
        failed = n < 50 or 100 * repeated > 50 * n
        assert r.base_failed is failed and not (failed and r.kept)
    assert 0 < sum(r.kept for r in got) < len(got)


def test_counts_of_odd_texts(spark):
    odd = ["", " \n ", "a b c a b c", "a\u00a0b a\u00a0b", "x\n\nx\nx ", "a a a a a", "# * $\t%&|<> \u00e9", "one\rtwo\x0bthree\x0cfour", "l\r\nl\r\nl"]
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judged(docs, labels).collect()}
    for i, text in enumerate(odd):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text), text
