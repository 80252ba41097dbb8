"""Connected components of a table of links, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridtide.session import stored


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Link a node's larger (or else its smaller) neighbours to the smallest node in reach of one step."""
    if larger:
        pairs = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    joined = pairs.join(least, "a")
    if larger:
        out = joined.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(least.select("a", F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node, component`: the smallest node reachable, for every node that has a link to another node.

    Alternating large-star and small-star steps; a node with very many links is summed up before it is shuffled and
    joined by a join that can be split. Each step is written to the shared folder. Null ends, links of a node to
    itself and repeated links change nothing; no links give an empty table.
    """
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (F.col(a) != F.col(b)).alias("link")).filter("link").select("a", "b").distinct()
    pairs, before = stored(pairs), None
    while True:
        pairs = stored(_star(_star(pairs, True), False))
        state = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
