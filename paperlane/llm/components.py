"""Connected components of a distributed edge list, by alternating large-star and small-star rounds.

Each round is written to the shared folder, so that lineage stays short and a lost executor repeats no round. The
links never come to the driver; only a count and a checksum do. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """From links (u, v), in any direction, repeats and loops allowed: (u, v) with v the least node that u > v reaches.

    Nodes that are least in their component, and nodes without links, have no row.
    """
    edges = written(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # a node that is least itself keeps its own links through the nodes above it, so none is lost
        large = large.filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
        small = large.join(least, F.col("u") == F.col("w"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        edges = written(small.filter("u <> v").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges
