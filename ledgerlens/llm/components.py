"""Connected components by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.shared import measure


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); the component is its least node.

    Every node links its larger neighbours, then its smaller ones, to the least node it knows, until
    nothing changes; the rounds grow with the logarithm of the longest path. Only minima are
    aggregated, so the many neighbours of one node are combined before the shuffle and never gathered.
    Each round is written to the shared folder. Null nodes and loops are left out; no edges give no rows.
    """
    clean = edges.select("a", "b").where("a <> b")
    state = None
    while True:
        both = _both_ways(clean)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.distinct()
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        round_ = small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
        written = measure(
            round_, "components", rows=F.count(F.lit(1)), check=F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))
        )
        clean = written.table
        if written.measures == state:
            break
        state = written.measures
    leaves = clean.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = clean.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionAll(roots)
