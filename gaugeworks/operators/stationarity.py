"""Dickey-Fuller test with constant and no lagged terms, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.scalars import normal_cdf
from gaugeworks.operators.series import TARGET_ROWS, with_lags

# MacKinnon (2010) response surfaces, constant, one variable: b0 + b1/T + b2/T^2 + b3/T^3.
CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
# MacKinnon (1994) p-value polynomials in the statistic, constant first.
P_SMALL = (2.1659, 1.4412, 0.038269)
P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
P_SPLIT, P_MIN, P_MAX = -1.61, -18.83, 2.74

SMALL = "too few points"
BY_P = "unit root rejected at 5 %"
BY_CRITICAL = "unit root rejected at 10 % only"
NON_STATIONARY = "unit root not rejected"


def _poly(x: Column, coefs: tuple[float, ...]) -> Column:
    out = F.lit(coefs[-1])
    for c in reversed(coefs[:-1]):
        out = out * x + F.lit(c)
    return out


def p_value(stat: Column) -> Column:
    inner = F.when(stat <= P_SPLIT, normal_cdf(_poly(stat, P_SMALL))).otherwise(
        normal_cdf(_poly(stat, P_LARGE)))
    return F.when(stat < P_MIN, 0.0).when(stat > P_MAX, 1.0).otherwise(inner)


def adf(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
        target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Statistic, p-value and critical values per series, from one regression of the difference on the
    level before; all sums are partial aggregates."""
    keys = list(keys)
    lagged = with_lags(df, keys, order, value, 1, target_rows, "_prev")
    x = F.try_element_at("_prev", F.lit(1))
    steps = lagged.select(*keys, x.alias("_x"), (F.col(value) - x).alias("_dy"))
    fit = steps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("size"), F.regr_count("_dy", "_x").alias("nobs"),
        F.regr_slope("_dy", "_x").alias("_b"), F.regr_sxx("_dy", "_x").alias("_sxx"),
        F.regr_syy("_dy", "_x").alias("_syy"), F.regr_sxy("_dy", "_x").alias("_sxy"))
    resid = (F.col("_syy") - F.col("_b") * F.col("_sxy")) / (F.col("nobs") - 2)
    stat = F.when((F.col("nobs") > 2) & (F.col("_sxx") > 0) & (resid > 0),
                  F.col("_b") / F.sqrt(resid / F.col("_sxx")))
    inv = F.lit(1.0) / F.col("nobs")
    return (fit.withColumn("stat", stat).withColumn("pvalue", p_value(F.col("stat")))
            .withColumns({n: _poly(inv, c) for n, c in CRITICAL.items()})
            .select(*keys, "size", "nobs", "stat", "pvalue", *CRITICAL))


def stationarity(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
                 min_records: int = 50, target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """The test with a verdict; series of ``min_records`` rows or fewer are only marked small."""
    tested = adf(df, keys, order, value, target_rows)
    above_all = F.col("stat") > F.greatest(*CRITICAL)
    verdict = (F.when(F.col("size") <= min_records, SMALL)
               .when(F.col("pvalue") < 0.05, BY_P)
               .when(above_all, NON_STATIONARY)
               .when(F.col("stat").isNotNull(), BY_CRITICAL))
    return tested.withColumn("feature", verdict)
