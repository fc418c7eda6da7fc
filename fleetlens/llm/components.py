"""Connected components of a graph of links, as alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v longs) -> (node, root): the smallest node reachable, for every node of a link.

    Each round lets every node's larger neighbours, then its smaller ones and
    itself, point at its smallest neighbour (large star, small star).  The
    edges are written to the shared folder after every round; the driver sees
    a count and a checksum.  Edges of one node meet its minimum, which partial
    aggregation finds, in an inner join that Spark can split.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        edges = written(small, "links")
        after = _state(edges)
        if after == before:
            break
        before = after
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
