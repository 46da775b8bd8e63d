"""Connected components of a graph that is held as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) -> (node, component): the smallest node that can be reached, for every node of an edge that is not that node itself.

    Alternates the large-star and small-star steps: every node hands its larger
    (then smaller) neighbours to the smallest node it knows. Only minima are
    aggregated, so that a node with very many neighbours never gathers them. The
    edges of every round go to the shared checkpoint folder. Rounds go on until
    nothing changes; their number grows with the square of the logarithm of the
    nodes at most.
    """
    edges = cut(edges.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    last = None
    while True:
        # large star: neighbours above u are linked to the least of u and its neighbours
        around = _both_ways(edges)
        least = around.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        linked = around.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
        edges = linked.filter("src <> dst").distinct()
        # small star: neighbours below u and u itself are linked to the least of them
        least = edges.groupBy("src").agg(F.min("dst").alias("m"))
        joined = edges.join(least, "src")
        linked = joined.select(F.col("dst").alias("src"), F.col("m").alias("dst")).unionAll(least.select("src", F.col("m").alias("dst")))
        edges = cut(linked.filter("src <> dst").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
