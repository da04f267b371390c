"""Exact scoring of the two-layer risk network.

Nodes 5 (ddos) and 6 (overload) are the causes, 1 to 4 the observed health metrics with parents (5, 6), and
node 0 (crash) has the four metrics as parents. With all four metrics observed the marginals are exact sums
over the four cause states. As evidence has few distinct state tuples, all posteriors are worked out once from
the tables and looked up by an equi join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

EVIDENCE = ["s1", "s2", "s3", "s4"]


def cpt_from_tables(tables: DataFrame) -> DataFrame:
    """Long probability rows from ``(node, table)``, the table a map from ``own,parent,..`` to p."""
    keyed = tables.select("node", F.explode("table").alias("_k", "p"))
    parts = F.transform(F.split("_k", ","), lambda s: F.trim(s).cast("int"))
    return keyed.select(F.col("node").cast("int").alias("node"), parts[0].alias("state"),
                        F.slice(parts, F.lit(2), F.size(parts) - 1).alias("parents"),
                        F.col("p").cast("double").alias("p"))


def column_sums(cpt: DataFrame) -> DataFrame:
    return cpt.groupBy("node", "parents").agg(F.sum("p").alias("total"))


def bad_columns(cpt: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """Table columns that do not sum to 1."""
    return column_sums(cpt).where(F.abs(F.col("total") - 1.0) > tolerance)


def normalised(cpt: DataFrame) -> DataFrame:
    """Every column scaled to sum 1; a column of zeros becomes uniform."""
    w = Window.partitionBy("node", "parents")
    total, states = F.sum("p").over(w), F.count(F.lit(1)).over(w)
    return cpt.withColumn("p", F.when(total > 0, F.col("p") / total).otherwise(F.lit(1.0) / states))


def refuse_bad(cpt: DataFrame, tolerance: float = 1e-3) -> DataFrame:
    """The tables as they are, or an error if a column does not sum to 1."""
    if not bad_columns(cpt, tolerance).isEmpty():
        raise ValueError("a probability table column does not sum to 1")
    return cpt


def posteriors(cpt: DataFrame) -> DataFrame:
    """P(crash = 1), P(ddos = 1), P(overload = 1) for every tuple of the four metric states.

    The size depends only on the state counts of the network, never on data.
    """
    crash = (cpt.where((F.col("node") == 0) & (F.col("state") == 1))
             .select(*[F.col("parents")[i].alias(s) for i, s in enumerate(EVIDENCE)],
                     F.col("p").alias("p_crash")))
    joint = crash
    for i, s in enumerate(EVIDENCE):
        table = cpt.where(F.col("node") == i + 1).select(
            F.col("state").alias(s), F.col("parents")[0].alias("_a"), F.col("parents")[1].alias("_b"),
            F.col("p").alias(f"_l{i + 1}"))
        joint = joint.join(table, [s] if i == 0 else [s, "_a", "_b"])
    prior_a = cpt.where(F.col("node") == 5).select(F.col("state").alias("_a"), F.col("p").alias("_pa"))
    prior_b = cpt.where(F.col("node") == 6).select(F.col("state").alias("_b"), F.col("p").alias("_pb"))
    joint = joint.join(prior_a, "_a").join(prior_b, "_b").withColumn(
        "_w", F.col("_pa") * F.col("_pb") * F.col("_l1") * F.col("_l2") * F.col("_l3") * F.col("_l4"))
    total = F.sum("_w")
    return joint.groupBy(*EVIDENCE).agg(
        F.max("p_crash").alias("p_crash"),
        F.try_divide(F.sum(F.when(F.col("_a") == 1, F.col("_w")).otherwise(0.0)), total).alias("p_ddos"),
        F.try_divide(F.sum(F.when(F.col("_b") == 1, F.col("_w")).otherwise(0.0)), total).alias("p_overload"))


def score(evidence: DataFrame, cpt: DataFrame) -> DataFrame:
    """Marginals for rows with the states ``s1``..``s4``."""
    return evidence.join(posteriors(cpt), EVIDENCE, "left")
