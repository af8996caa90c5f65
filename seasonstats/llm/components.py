"""Connected components of links between numbered nodes, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonstats.sources.shared import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node of ``links`` (a, b): the least node that it can reach.

    Each round links every node's neighbours to the least one of them, first the greater neighbours, then the others
    (large star, small star), until nothing changes. Links per round never exceed those given.
    """
    links = materialize(links.where("a <> b").select("a", "b"), "links")
    before = None
    while True:
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = _star(both, larger=True)
        lower = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        links = materialize(_star(lower, larger=False), "links")
        # The stars are fixed once neither their number nor their sums change.
        now = links.agg(F.count(F.lit(1)), F.sum(F.col("b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    centres = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.unionByName(centres)


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Links (neighbour, least neighbour or the node itself) of each node; with ``larger`` for greater neighbours only."""
    # Stored, so that the join may split a node that very many links have.
    least = materialize(links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
    near = links.join(least, "a")
    if larger:
        found = near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        found = near.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return found.where("a <> b").distinct()
