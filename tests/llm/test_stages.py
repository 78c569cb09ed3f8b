"""Stages of the pipeline on awkward rows, empty tables and unlabelled ones; short benchmark items."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from daylake.llm import decontaminate, langid

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, component_id int, part int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Null and repeated ids, null, empty and long texts, repeated rows, columns with names used inside."""
    english = "the cat sat on the mat and looked at the dog " * 5
    german = "der Hund lief schnell durch den Wald und sah die Katze " * 5
    rows = [
        (1, None, "en"), (2, "", "de"), (3, " \n\t ", None), (4, english, "en"), (5, german, "de"), (None, english + "!", "en"),
        (None, None, None), (6, german + "x", "de"), (6, german + "x", "de"), (7, "12 34", "en"), (8, "word " * 30_000, None),
    ]
    return spark.createDataFrame([(i, t, lang, "s", None, "f", 1, 2) for i, t, lang in rows], SCHEMA)


def test_stages_define_what_becomes_of_awkward_rows(spark, small, awkward):
    docs = awkward
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small)
        assert kept.columns == awkward.columns
        docs = spark.createDataFrame(kept.collect(), awkward.schema)
        left[name] = sorted((r.doc_id or 0, len(r.text or "")) for r in docs.collect())
    # Texts without a letter go first; then copies, whose null id never stands for another.
    assert {i for i, _ in left["language_id"]} >= {4, 5, 6} and not {1, 2, 3, 7} & {i for i, _ in left["language_id"]}
    assert [i for i, _ in left["simhash_near_dedup"]].count(6) <= 1
    assert left["decontamination"] == left["simhash_near_dedup"]
    assert [i for i, _ in left["pii"]] == [i for i, _ in left["decontamination"]]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


def test_stages_on_an_empty_table(spark, small, awkward):
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, small).count() == 0


def test_without_labels_every_text_with_a_letter_stays(spark, awkward):
    unlabelled = spark.createDataFrame([(*r[:2], None, *r[3:]) for r in awkward.collect()], SCHEMA)
    model = langid.fit_model(langid.sample(unlabelled))
    assert model.languages == []
    kept = langid.accepted(unlabelled, model, 0.25)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 4, 5, 6, 6, 8]


def test_short_items_are_whole_words():
    matcher = decontaminate.Matcher([(1, "a"), (2, "cat"), (3, "c++"), (4, "is it")], short=decontaminate.SHORT)
    found = {text: {m[0] for m in matcher.matches(text)} for text in ("category", "a cat", "the cat.", "c++", "c++x", "this it", "is it?", "ccat cat")}
    assert found == {"category": set(), "a cat": {1, 2}, "the cat.": {2}, "c++": {3}, "c++x": {3}, "this it": set(), "is it?": {4}, "ccat cat": {2}}


def plain_distance(item, text):
    """Least edit distance of `item` to any substring of `text`, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def test_items_within_their_budget_equal_a_whole_table():
    rng, seen = random.Random(11), [0, 0]
    for _ in range(300):
        item = "".join(rng.choices("ab c", k=rng.randint(9, 40))).strip() or "abc abc abc"
        item = " ".join(item.split())
        changed = list(item)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(changed))
            changed[at : at + 1] = rng.choice([[], ["x"], [changed[at], "y"]]) or ["z"]
        text = " ".join(("".join(rng.choices("abc ", k=20)) + "".join(changed) + "".join(rng.choices("abc ", k=20))).split())
        errors = decontaminate.budget(item)
        if not errors:
            continue
        got = decontaminate.Matcher([(1, item)]).matches(text)
        want = plain_distance(item, text)
        assert [m[1] for m in got] == ([want] if want <= errors else [])
        seen[want <= errors] += 1
    assert min(seen) > 20
