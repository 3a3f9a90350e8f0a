"""Connected components of an edge table, by alternating large and small stars.

Every round is two grouped minima (combined before the shuffle) and two joins,
and ends in a checkpoint.  Only two totals of a round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpoint


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge; ``root`` is the smallest node reachable.

    ``edges`` has ``src`` and ``dst`` (longs); loops and repeats are ignored, and
    nodes without an edge to another node are not returned.
    """
    e = edges.where(F.col("src") != F.col("dst")).select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()
    e = checkpoint(e)
    state = _state(e)
    while state[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "_u")
        small = large.join(least, F.col("u") == F.col("_u"))
        new = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = checkpoint(new.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct())
        before, state = state, _state(e)
        if state == before:
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
