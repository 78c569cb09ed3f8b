"""Schemas inferred a day at a time against one inference over all days."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daylake.operators import infer_items_schema
from daylake.sources.inferred import InferredSchemas, combined

DAYS = [dt.date(2020, 7, d) for d in range(18, 23)]


def random_value(rng, deep):
    kinds = ["int", "float", "text", "bool", "none"] + ["list", "dict"] * (deep > 0)
    kind = rng.choice(kinds)
    if kind == "list":
        return [random_value(rng, deep - 1) for _ in range(rng.randint(0, 3))]
    if kind == "dict":
        return {k: random_value(rng, deep - 1) for k in rng.sample("abcd", rng.randint(0, 3))}
    return {"int": rng.randint(-9, 10**9), "float": rng.choice([0.5, 12.25, 1e30]), "text": "x", "bool": True, "none": None}[kind]


@pytest.mark.parametrize("seed", range(4))
def test_days_together_give_the_schema_of_all_texts(spark, tmp_path, seed):
    rng = random.Random(seed)
    # Few fields, so that days agree in some and differ in others.
    rows = [
        (day, json.dumps([{"name": "i", "n": rng.randint(0, 9), "x": random_value(rng, 2)} for _ in range(rng.randint(0, 2))]))
        for day in DAYS for _ in range(4)
    ]
    docs = spark.createDataFrame([*rows, (DAYS[0], "not json"), (DAYS[1], None)], "day date, items string").cache()
    kept = InferredSchemas(spark, str(tmp_path / "s"))
    got = kept.schema(DAYS, lambda day: docs.filter(F.col("day") == F.lit(day)))
    assert got.simpleString() == infer_items_schema(docs).simpleString()
    assert set(kept.days()) == set(DAYS)
    docs.unpersist()


def test_a_second_run_reads_the_new_day_only(spark, tmp_path):
    asked, texts = [], {DAYS[0]: '[{"a": 1}]', DAYS[1]: '[{"b": "x"}]', DAYS[2]: '[{"a": 2.5}]'}

    def read(day):
        asked.append(day)
        return spark.createDataFrame([(texts[day],)], "items string")

    kept = InferredSchemas(spark, str(tmp_path))
    assert kept.schema(DAYS[:2], read).simpleString() == "array<struct<a:bigint,b:string>>"
    assert kept.schema(DAYS[:3], read).simpleString() == "array<struct<a:decimal(21,1),b:string>>" and asked == DAYS[:3]
    texts[DAYS[1]] = '[{"c": true}]'
    assert "c:boolean" in kept.schema(DAYS[:3], read, anew=[DAYS[1]]).simpleString() and asked[3:] == [DAYS[1]]
    # A day that is asked for alone is not mixed with others.
    assert kept.schema([DAYS[1]], read).simpleString() == "array<struct<c:boolean>>" and len(asked) == 4


def test_types_without_a_common_one_are_variants():
    text, number, nothing = T.StringType(), T.LongType(), T.NullType()
    assert combined(text, number) == T.VariantType() == combined(T.ArrayType(text), text)
    assert combined(nothing, text) == text == combined(text, nothing)
    assert combined(number, T.DoubleType()) == T.DoubleType() == combined(T.DecimalType(30, 20), number)
    assert combined(T.DecimalType(3, 1), T.DecimalType(4, 3)) == T.DecimalType(5, 3)
