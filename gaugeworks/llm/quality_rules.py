"""Quality rules with risk-controlled cutoffs.

A rule is a share computed from the counts of a text; a document breaks it where the share exceeds the cutoff of its
stratum. Cutoffs are chosen on labelled holdouts: for each rule and stratum the cutoffs of a fixed grid are tested from
the most lenient one downwards, and the last cutoff before the first failed test is taken. A test passes if the exact
binomial bound says that at most ``risk / rules`` of the good documents are rejected, at confidence
``1 - error / (rules * strata)``: fixed-sequence testing within a rule, Bonferroni across rules and strata. Strata whose
holdouts are too small to pass any test are pooled (by their size alone) and tested as one; if the pool is too small as
well, or a stratum has no labelled row, its documents are judged by the base rules alone. The bound of the pool holds for
its mix; so are therefore those of a pooled stratum whose own labelled good rows lose more than ``risk`` to the pool's cutoffs.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import cut

RISK, ERROR = 0.02, 0.1
#: name, numerator, denominator, step of the grid, number of steps.
RULES = (
    ("symbols", "n_symbols", "n_words", 0.02, 100),
    ("exclaim", "n_exclaim", "n_words", 0.02, 100),
    ("upper", "n_upper", "n_upper + n_lower", 0.02, 50),
    ("repeated", "n_repeat_words", "n_words", 0.02, 50),
    ("dup_lines", "n_dup_lines", "n_lines", 0.02, 50),
)
MIN_WORDS, MAX_REPEATED_PCT = 50, 50


def base_failed() -> Column:
    """The base rules: too short, or more than half of the words in repeated three-word windows."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PCT * F.col("n_words"))


def rule_value(rule: tuple) -> Column:
    """Share of a rule; 0 where its denominator is 0."""
    _, num, den, _, _ = rule
    return F.coalesce(F.expr(num).cast("double") / F.nullif(F.expr(den).cast("double"), F.lit(0.0)), F.lit(0.0))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of X ~ Binomial(n, p), as a regularised incomplete beta function (continued fraction), so that
    its cost does not grow with n."""
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1.0, 1 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(p))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1 - front * _fraction(b, a, 1 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    """Modified Lentz evaluation of the continued fraction of the incomplete beta function."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out, m = d, 0
    while True:
        m += 1
        for t in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                  -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + t * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + t / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1) < 1e-14 or m > 100_000:
            return out


def lowest_cutoff(cells: dict[int, int], steps: int, risk: float, error: float) -> int | None:
    """Least grid place j, reached from ``steps`` downwards without a failed test, beyond which few good documents
    lie. ``cells[j]``: good documents whose value is above place j - 1 and not above place j."""
    n = sum(cells.values())
    above, found = sum(v for j, v in cells.items() if j > steps), None
    for j in range(steps, -1, -1):
        if binomial_tail(above, n, risk) > error:
            break
        found = j
        above += cells.get(j, 0)
    return found


def learn_cutoffs(stats: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK,
                  error: float = ERROR) -> DataFrame:
    """``stratum, pooled, cutoffs map<rule, double>, good, lost``: one row per stratum for which any rule passed. ``good`` counts
    its labelled good rows, ``lost`` those beyond a cutoff (once per rule); null cutoffs leave the base rules alone.

    ``stats`` holds ``doc_id``, the stratum and the counts, ``labels`` the columns ``doc_id, good``. Good documents that
    pass the base rules are counted by stratum, rule and grid cell; all further work is on these counts.
    """
    good = labels.where("good").select(F.col("doc_id").alias("_id"))
    held = stats.where(~base_failed()).join(good, F.col("doc_id") == F.col("_id"))
    cell = [F.struct(F.lit(r[0]).alias("rule"), F.ceil(rule_value(r) / r[3] - 1e-9).alias("cell")) for r in RULES]
    counts = cut(held.select(F.col(stratum).alias("stratum"), F.inline(F.array(*cell)))
                 .groupBy("stratum", "rule", "cell").agg(F.count("*").alias("n")))
    sizes = counts.where(F.col("rule") == RULES[0][0]).groupBy("stratum").agg(F.sum("n").alias("size"))
    each_risk = risk / len(RULES)
    least = _least_holdout(each_risk, error / (len(RULES) * max(1, sizes.count())))
    groups = cut(sizes.select("stratum", "size", (F.col("size") < least).alias("pooled"),
                              F.when(F.col("size") >= least, F.col("stratum")).alias("pool")))
    each_error = error / (len(RULES) * max(1, groups.select("pooled", "pool").distinct().count()))
    steps = {r[0]: (r[3], r[4]) for r in RULES}

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pooled, pool, rule = pdf[["pooled", "pool", "rule"]].iloc[0]
        step, last = steps[rule]
        j = lowest_cutoff(pdf.groupby("cell")["n"].sum().to_dict(), last, each_risk, each_error)
        rows = [] if j is None else [(pooled, pool, rule, j * step)]
        return pd.DataFrame(rows, columns=["pooled", "pool", "rule", "cutoff"])

    cells = counts.join(groups.withColumnRenamed("stratum", "_s"), F.col("stratum").eqNullSafe(F.col("_s")))
    chosen = cut(cells.groupBy("pooled", "pool", "rule").applyInPandas(choose, "pooled boolean, pool string, rule string, cutoff double"))
    maps = chosen.groupBy(F.col("pooled").alias("_pooled"), F.col("pool").alias("_pool")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    step = F.create_map(*[F.lit(v) for r in RULES for v in (r[0], r[3])])
    there = groups.join(maps, (F.col("pooled") == F.col("_pooled")) & F.col("pool").eqNullSafe(F.col("_pool")))
    beyond = F.col("cell") > F.round(F.col("cutoffs")[F.col("rule")] / step[F.col("rule")])
    rows = there.join(counts.withColumnRenamed("stratum", "_s"), F.col("stratum").eqNullSafe(F.col("_s")))
    lost = rows.groupBy("stratum").agg(F.sum(F.when(beyond, F.col("n")).otherwise(0)).alias("lost"))
    own = there.join(lost.withColumnRenamed("stratum", "_s"), F.col("stratum").eqNullSafe(F.col("_s")))
    return cut(own.select("stratum", "pooled", F.when(~F.col("pooled") | (F.col("lost") <= risk * F.col("size")), F.col("cutoffs")).alias("cutoffs"),
                          F.col("size").alias("good"), "lost"))


def _least_holdout(risk: float, error: float) -> int:
    """Fewest good documents with which a cutoff that rejects none of them passes its test."""
    return math.ceil(math.log(error) / math.log(1 - risk))


def with_verdict(stats: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``stats`` with ``base_failed``, ``failed_rule`` (the first broken rule in the order of ``RULES``, else null) and
    ``kept``. ``cutoffs`` holds one short row per stratum and was written out, so that its true size decides the join."""
    names = stats.columns
    joined = stats.join(cutoffs.select(F.col("stratum").alias("_stratum"), "cutoffs"), F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    broken = F.coalesce(*[F.when(rule_value(r) > F.col("cutoffs")[r[0]] + 1e-9, r[0]) for r in RULES])
    return (joined.select(*names, base_failed().alias("base_failed"), broken.alias("failed_rule"))
            .withColumn("kept", ~F.col("base_failed") & F.col("failed_rule").isNull()))
