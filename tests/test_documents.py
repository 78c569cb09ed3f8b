"""Items and garnishes of orders with one document and with several, shuffled only where they may repeat."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from compare import spark_rows
from daylake import operators as ops
from daylake.operators import nested


def random_docs(rng, orders, most):
    """Documents in which items, garnishes and whole texts repeat; some ids and texts are null or malformed."""

    def garnish():
        return {"externalId": rng.choice(["G1", "G2", None]), "quantity": rng.randint(1, 2)}

    def item():
        return {"name": rng.choice("ab"), "garnishItems": [garnish() for _ in range(rng.randint(0, 3))]}

    rows = []
    for order in range(orders):
        texts = [json.dumps([item() for _ in range(rng.randint(0, 3))]) for _ in range(rng.randint(1, most))]
        rows += [(None if order == 3 else f"o{order}", rng.choice(texts)) for _ in texts]
    return rows + [("null", None), ("null", None), ("bad", "[{"), ("twice", texts[0]), ("twice", texts[0])]


def plain_details(docs):
    """One shuffle of all items and of all garnishes, as whole structs."""
    items = ops.parse_items(docs).select("order_id", F.explode("items").alias("item")).dropDuplicates()
    ids = F.array_distinct("item.garnishItems.externalId")
    detail = items.withColumn("garnish_external_id", F.explode(ids)).select(
        "order_id", *nested._item_columns(), "garnish_external_id", F.col("item.garnishItems").alias("garnish_items")
    )
    garnishes = items.select("order_id", F.explode("item.garnishItems").alias("garnish"))
    return detail, garnishes.select("order_id", *nested._garnish_columns()).dropDuplicates()


def rows_of(df):
    return spark_rows(df.withColumn("garnish_items", F.to_json("garnish_items")) if "garnish_items" in df.columns else df)


@pytest.mark.parametrize("most", [1, 3])
@pytest.mark.parametrize("broadcast_ids", [1_000, 0])
def test_details_equal_a_distinct_of_everything(spark, most, broadcast_ids):
    docs = spark.createDataFrame(random_docs(random.Random(most), 40, most), "order_id string, items string").repartition(5)
    detail, garnishes = plain_details(docs)
    assert rows_of(ops.item_detail(docs, broadcast_ids=broadcast_ids)) == rows_of(detail)
    assert rows_of(ops.garnish_detail(docs, broadcast_ids=broadcast_ids)) == rows_of(garnishes)


def test_orders_with_one_document_are_not_shuffled(spark, tmp_path):
    docs = [(f"o{n}", json.dumps([{"name": "a", "garnishItems": [{"externalId": "G"}]}] * 3)) for n in range(50)]
    spark.createDataFrame(docs, "order_id string, items string").write.parquet(str(tmp_path / "one"))
    one = spark.read.parquet(str(tmp_path / "one"))
    for build in (ops.item_detail, ops.garnish_detail):
        for options in ({}, {"one_document_per_order": True}):
            got = build(one, **options)
            assert got.count() == 50
            assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
