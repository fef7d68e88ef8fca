"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logilake.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a, b); a component is named after its smallest node.

    Alternating large-star and small-star rounds turn the edges into stars around the smallest nodes. A node's
    neighbours are never gathered: their minimum is aggregated and joined back, so a hub costs no more than its
    edges. Each round is written to the shared folder, which cuts the lineage.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Every edge now points to a smaller node: (a, b) with a > b.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("x"), "m", "a")
        # The node itself and its other smaller neighbours go to the smallest.
        moved = small.select(F.col("x").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        now = staged(moved.where("a <> b").distinct(), "edges")
    roots = now.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def _state(edges: DataFrame) -> tuple:
    """Differs when the edge set differs."""
    pair = F.xxhash64("a", "b")
    row = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(pair, F.lit(1 << 31))), F.bit_xor(pair)).first()
    return tuple(row)
