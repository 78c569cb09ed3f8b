"""What is collected for learning is bounded by rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from daylake.llm import quality


def test_rows_of_one_id_are_picked_one_by_one(spark, monkeypatch):
    stats = spark.range(12_000).select(
        F.when(F.col("id") < 4_000, 7).otherwise(F.col("id")).alias("doc_id"),
        *[(F.col("id") % (n + 50)).alias(name) for n, name in enumerate(quality.COUNTS)],
    )
    stats = stats.union(stats)
    labels = spark.range(12_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    seen = []
    monkeypatch.setattr(quality, "learn_rules", lambda table, bad: seen.append(len(table)) or [])
    quality.train(stats, labels.union(labels), fit_rows=1_000)
    assert 800 < seen[0] < 1_200
