"""Connected components of a link table by large-star and small-star rounds.

Each round is a few joins and partial aggregates over the links; its result is
written to the shared folder, which cuts lineage and survives lost executors.
A hub's links are joined on the hub (an inner join that adaptive execution
splits), never gathered in one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import stored


def _fingerprint(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return r.n, r.h


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id in ``links`` (columns a, b)."""
    e = stored(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        state = _fingerprint(e)
        if state == before:
            return e.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.col("b").alias("component")) \
                .unionByName(e.select(F.col("b").alias("id"), F.col("b").alias("component"))) \
                .groupBy("id").agg(F.min("component").alias("component"))
        before = state
        # large star: every larger neighbour of u moves to u's smallest neighbour
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        e = stored(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        # small star: u and its smaller neighbours move to the smallest of them
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "small-star")
