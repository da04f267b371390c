"""Exact group medians that scale, and outliers by median absolute deviation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.operators.series import TARGET_ROWS, if_small
from gaugeworks.session import cut

# Fixed value: scales a MAD to a standard deviation under a normal distribution.
MAD_SCALE = 1.4826
THRESHOLD = 3.5
# Groups up to this many rows, as counted, may be handled as one array.
ARRAY_ROWS = 100_000
# Cells into which what is left of a large group is cut in each round.
CELLS = 64


def value_counts(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """Distinct values of a group with their number ``_c``: ties collapse before the shuffle."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(n.alias("_c"))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the largest group: one counting job over the key columns."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0


def median(counts: DataFrame, keys: Sequence[str], value: str, name: str = "median",
           large: bool = False, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Exact median per group from weighted values (column ``_c``); ``large`` picks the form in which no
    task holds a whole group."""
    if large:
        return median_of_large(counts, keys, value, name, target_rows)
    return counts.groupBy(*keys).agg(F.percentile(value, 0.5, F.col("_c")).alias(name))


def median_of_large(counts: DataFrame, keys: Sequence[str], value: str, name: str = "median",
                    target_rows: int = TARGET_ROWS) -> DataFrame:
    """Exact median per group, by distributed selection.

    Groups of up to ``target_rows`` distinct values are ranked as they are. Of the others, only the stretch of values that
    holds the middle ranks is kept, and cut into ``CELLS`` cells again until it is within ``target_rows`` (``narrowed``).
    """
    keys = list(keys)
    counts = cut(counts)
    open_, settled = narrowed(counts, keys, value, target_rows)
    if open_ is None:
        return counts.groupBy(*keys).agg(F.percentile(value, 0.5, F.col("_c")).alias(name))
    hot = open_.select(*keys).unionByName(settled.select(*keys)).distinct()
    rest = counts.join(_named(hot, keys), _match(keys), "left_anti").groupBy(*keys).agg(F.percentile(value, 0.5, F.col("_c")).alias(name))
    order = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = open_.withColumn("_to", F.col("_before") + F.sum("_c").over(order))
    lo = F.col("_to") - F.col("_c")

    def at(rank: str):
        return F.max(F.when((lo <= F.col(rank)) & (F.col(rank) < F.col("_to")), F.col(value)))

    found = ranked.groupBy(*keys).agg(at("_r1").alias("_m1"), at("_r2").alias("_m2"))
    both = found.unionByName(settled.select(*keys, "_m1", "_m2"))
    return rest.unionByName(both.select(*keys, ((F.col("_m1") + F.col("_m2")) / 2).alias(name)))


def narrowed(counts: DataFrame, keys: list[str], value: str, target_rows: int) -> tuple[DataFrame | None, DataFrame | None]:
    """The stretches of values that hold the medians of groups with more than ``target_rows`` distinct values.

    Each round takes approximate quantiles of what is left of a group as bounds of cells, counts the cells exactly and keeps
    the one with the middle ranks ``_r1`` and ``_r2``; so whatever the distribution, about one in ``CELLS`` values stays. If the two ranks
    fall to two cells they are the greatest value of one and the least of the next, and the group is settled. Returns the
    stretches (``keys, value, _c, _before`` the rows below, ``_r1, _r2``) and the settled groups (``keys, _m1, _m2``), or nothing
    where no group is large. Joins with the few bounds per large group are broadcast only up to a counted size.
    """
    sizes = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.sum("_c").alias("_n")).where(F.col("_rows") > target_rows)
    groups = cut(sizes.select(*keys, F.expr("(_n - 1) div 2").alias("_r1"), F.expr("_n div 2").alias("_r2"), F.lit(0).cast("long").alias("_before")))
    many = groups.count()
    if not many:
        return None, None
    left = counts.join(if_small(_named(groups, keys), many), _match(keys)).drop(*[f"_of_{k}" for k in keys])
    stretches, settled = [], []
    while many:
        cuts = left.groupBy(*keys).agg(F.percentile_approx(value, [k / CELLS for k in range(1, CELLS)], 20 * CELLS).alias("_cuts"))
        held = left.join(if_small(_named(cut(cuts), keys), many), _match(keys)).drop(*[f"_of_{k}" for k in keys])
        celled = cut(held.withColumn("_cell", F.size(F.filter("_cuts", lambda c: c <= F.col(value)))).drop("_cuts"))
        upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = (celled.groupBy(*keys, "_cell", "_before", "_r1", "_r2")
                .agg(F.sum("_c").alias("_h"), F.count(F.lit(1)).alias("_rows"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
                .withColumn("_end", F.col("_before") + F.sum("_h").over(upto)).withColumn("_from", F.col("_end") - F.col("_h")))
        first, second = ((F.col("_from") <= F.col(r)) & (F.col(r) < F.col("_end")) for r in ("_r1", "_r2"))
        picked = cut(hist.where(first | second).groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_cells"), F.min("_cell").alias("_at"), F.max("_rows").alias("_rows"), F.min("_from").alias("_from"),
            F.max(F.when(first, F.col("_hi"))).alias("_m1"), F.max(F.when(second, F.col("_lo"))).alias("_m2")))
        settled.append(picked.where("_cells = 2").select(*keys, "_m1", "_m2"))
        one = _named(picked.where("_cells = 1").select(*keys, "_at", "_from", "_rows"), keys)
        kept = (celled.join(if_small(one, many), [*_match(keys), F.col("_cell") == F.col("_at")])
                .withColumn("_before", F.col("_from")).drop("_cell", "_at", "_from", *[f"_of_{k}" for k in keys]))
        stretches.append(kept.where(F.col("_rows") <= target_rows).drop("_rows"))
        many = picked.where((F.col("_cells") == 1) & (F.col("_rows") > target_rows)).count()
        left = kept.where(F.col("_rows") > target_rows).drop("_rows")
    return reduce(DataFrame.unionByName, stretches), reduce(DataFrame.unionByName, settled)


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_of_{k}" for k in keys})


def _match(keys: list[str]) -> list[Column]:
    """Groups of the same key; a null key is a key."""
    return [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in keys]


def mad_table(counts: DataFrame, keys: Sequence[str], value: str, large: bool = False, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Median and median absolute deviation per group."""
    keys = list(keys)
    med = median(counts, keys, value, "median", large, target_rows)
    dev = (counts.join(med, keys).withColumn("_d", F.abs(F.col(value) - F.col("median")))
           .groupBy(*keys, "_d").agg(F.sum("_c").alias("_c")))
    return med.join(median(dev, keys, "_d", "mad", large, target_rows), keys)


def mad_outliers(df: DataFrame, keys: Sequence[str], value: str = "value", weight: str | None = None,
                 threshold: float = THRESHOLD, target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Outlying values per group: |x - median| / (1.4826 MAD) above ``threshold``.

    Where the MAD is 0 every value off the median is an outlier. One row per distinct value; ``n`` says
    how often it occurs.
    """
    keys = list(keys)
    largest = 0 if target_rows is None else largest_group(df, keys)
    if weight is None and 0 < largest <= min(ARRAY_ROWS, target_rows):
        return _outliers_of_small(df, keys, value, threshold)
    counts = value_counts(df, keys, value, weight)
    large = target_rows is not None and largest > target_rows
    scored = counts.join(mad_table(counts, keys, value, large, target_rows or TARGET_ROWS), keys)
    hit = _is_outlier(F.col(value), F.col("median"), F.col("mad"), threshold)
    return scored.where(hit).select(*keys, value, F.col("_c").alias("n"), "median", "mad")


def _is_outlier(x: Column, median: Column, mad: Column, threshold: float) -> Column:
    dist = F.abs(x - median)
    return F.when(mad == 0, dist > 0).otherwise(dist / (F.lit(MAD_SCALE) * mad) > threshold)


def _middle(ordered: Column) -> Column:
    n = F.size(ordered)
    at = lambda i: F.element_at(ordered, (F.floor(i) + 1).cast("int"))
    return (at((n - 1) / 2) + at(n / 2)) / 2


def _outliers_of_small(df: DataFrame, keys: list[str], value: str, threshold: float) -> DataFrame:
    """The same for groups counted to be short: one shuffle, each group as an ordered array."""
    groups = (df.where(F.col(value).isNotNull()).groupBy(*keys)
              .agg(F.sort_array(F.collect_list(value)).alias("_v"))
              .withColumn("median", _middle(F.col("_v")))
              .withColumn("_d", F.sort_array(F.transform("_v", lambda x: F.abs(x - F.col("median")))))
              .withColumn("mad", _middle(F.col("_d"))))
    out = F.filter("_v", lambda x: _is_outlier(x, F.col("median"), F.col("mad"), threshold))
    return (groups.select(*keys, "median", "mad", F.explode(out).alias(value))
            .groupBy(*keys, value, "median", "mad").agg(F.count(F.lit(1)).alias("n"))
            .select(*keys, value, "n", "median", "mad"))
