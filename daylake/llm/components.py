"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import stored


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node of `edges` (a, b): label is the least node that it reaches.

    Each round is one written table in the shared folder, so lineage stays short and a lost executor
    costs part of one round. Only a count and a checksum per round reach the driver. Loops, repeated
    and reversed edges are allowed; no edges give no rows.
    """
    links = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        name,
    )
    before = None
    while (now := _checksum(links)) != before:
        before = now
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        small = _star(large)
        links = stored(
            small.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
            .unionAll(small.select("a", F.col("least").alias("b")))
            .distinct(),
            name,
        )
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        roots.select("node", F.col("node").alias("label"))
    )


def _star(links: DataFrame) -> DataFrame:
    """Each link with the least node of a's neighbourhood. Minima are formed before the shuffle, and
    the join back is left to Spark, which splits the partitions of a hub."""
    least = links.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    return links.join(least, "a")


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
    ).first()
    return tuple(row)
