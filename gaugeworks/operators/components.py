"""Connected components of a graph table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import cut


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Least node id of the component of each node. ``nodes(id)``, ``edges(a, b)``.

    ``id`` may be of any orderable type. Every round each node, and the node its label points to, takes the
    least label seen among its neighbours (labels of labels, so chains shorten geometrically). Two rounds are
    written out before the next two; only the question whether anything changed comes to the driver.
    """
    both = cut(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = nodes.select("id", F.col("id").alias("label"))
    while True:
        moved = cut(_round(both, _round(both, labels.withColumn("_was", F.col("label")))))
        labels = moved.select("id", "label")
        if moved.where(F.col("_was") != F.col("label")).isEmpty():
            return labels


def _round(both: DataFrame, labels: DataFrame) -> DataFrame:
    up = labels.select(F.col("id").alias("_p"), F.col("label").alias("_up"))
    stepped = labels.join(up, F.col("label") == F.col("_p")).drop("_p")
    near = (both.join(stepped.select("id", "_up"), F.col("b") == F.col("id"))
            .groupBy("a").agg(F.min("_up").alias("_m")))
    seen = stepped.join(near, F.col("id") == F.col("a"), "left")
    nothing = F.lit(None).cast(labels.schema["id"].dataType)
    offers = seen.select(F.inline(F.array(
        F.struct(F.col("id"), F.least("label", "_up", "_m").alias("_new"), F.col("_was")),
        F.struct(F.col("label").alias("id"), F.col("_m").alias("_new"), nothing.alias("_was")))))
    return offers.groupBy("id").agg(F.min("_new").alias("label"), F.max("_was").alias("_was"))
