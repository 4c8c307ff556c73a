"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step replaces edges by edges to the smallest neighbour; only edges move between
executors, and nothing is gathered in the driver but one count and one checksum a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.storage import written


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges (a, b): component is its smallest
    reachable node. Loops, repeated and reversed edges are fine; nulls are left out."""
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .filter("u is not null and v is not null and u <> v").distinct()
    now = written(now, "edges")
    state = None
    for _ in range(max_rounds):
        # large star: each node's larger neighbours point to its smallest neighbour (or itself)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: each node and its smaller neighbours point to the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(down.select("u", F.col("m").alias("v")))
        now = written(small.filter("u <> v").distinct(), "edges")
        # a sum of hashes in decimals cannot overflow
        found = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (found.n, found.h) == state:
            break
        state = (found.n, found.h)
    else:
        raise RuntimeError(f"components not settled in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
