"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import cut


def components(links: DataFrame) -> DataFrame:
    """``id, root``: every endpoint of ``links(a, b)`` with the least id that its links reach.

    Alternating star contraction: a large star hangs the greater neighbours of a node below its least neighbour, a small
    star does so with the lesser ones. The number of links never grows, the depth shrinks geometrically, and a node
    with very many links meets its own minimum by a partial aggregate and an equi join, whose skew AQE splits. Each
    round is written out; the driver sees one count and one checksum.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("w")).distinct())
    last = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "w").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == last:
            return edges.select(F.col("v").alias("id"), F.col("w").alias("root")).union(
                edges.select("w", "w").distinct())
        last, edges = seen, cut(_small_star(_large_star(edges)).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("w", "v"))
    least = both.groupBy(F.col("v").alias("n")).agg(F.min("w").alias("m"))
    return (both.join(least, F.col("v") == F.col("n")).where("w > v")
            .select(F.col("w").alias("v"), F.least("m", "n").alias("w")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("v").alias("n")).agg(F.min("w").alias("m"))
    return (edges.join(least, F.col("v") == F.col("n"))
            .select(F.inline(F.array(F.struct(F.col("v"), F.col("m").alias("w")),
                                     F.struct(F.col("w").alias("v"), F.col("m").alias("w"))))).where("v <> w"))
