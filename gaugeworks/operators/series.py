"""Per-series order operators that hold up when one series has a large share of all rows.

A plain ``Window.partitionBy(series)`` puts a whole series into one task. Here a series above
``target_rows`` is first split along its order columns into chunks of about that size; work runs per
(series, chunk), and the little that crosses a chunk edge (the last k rows, a running total) is carried
over by a table with a few rows per chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.session import cut

TARGET_ROWS = 1_000_000
BROADCAST_ROWS = 200_000
# Up to here single lag columns beat a sliding list.
_FEW_LAGS = 6


def split_hot(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              target_rows: int | None = TARGET_ROWS) -> tuple[DataFrame, int]:
    """Add ``_chunk`` (and ``_hot`` if any series is split) and say about how many chunks split series have.

    One counting job (partial aggregation, key columns only) finds the series above ``target_rows``.
    There are at most rows / target_rows of those. Their rows are range-partitioned by keys and all order columns, whose
    sampled bounds follow the rows however bunched their times are, and written out with their partition as
    chunk. Without any hot series ``_chunk`` is the constant 0 and the plan gains nothing. ``target_rows=None`` skips the
    count.
    """
    keys = list(keys)
    if target_rows is None:
        return df.withColumn("_chunk", F.lit(0).cast("long")), 0
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > target_rows)
    n_hot, n_rows = hot.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if n_hot == 0:
        return df.withColumn("_chunk", F.lit(0).cast("long")), 0
    side = if_small(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot")), n_hot)
    same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys]
    marked = df.join(side, same, "left").drop(*[f"_hot_{k}" for k in keys]).withColumn("_hot", F.col("_hot").isNotNull())
    parts = max(2, -(-n_rows // target_rows))
    pieces = cut(marked.where("_hot").repartitionByRange(parts, *keys, *order)
                 .withColumn("_chunk", F.spark_partition_id().cast("long")))
    rest = marked.where(~F.col("_hot")).withColumn("_chunk", F.lit(0).cast("long"))
    return pieces.unionByName(rest), parts + n_hot


def if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table counted to be small; leave a larger one to a shuffle join."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _carried(df: DataFrame, carry: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df`` with the columns that ``carry``, of about ``rows`` rows, has per series and chunk. A null key is a key, as in ``split_hot``."""
    on = [*keys, "_chunk"]
    side = if_small(carry.withColumnsRenamed({c: f"_at_{c}" for c in on}), rows)
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"`_at_{c}`")) for c in on]
    return df.join(side, same, "left").drop(*[f"_at_{c}" for c in on])


def with_lags(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, k: int,
              target_rows: int | None = TARGET_ROWS, name: str = "lags") -> DataFrame:
    """Add the array ``name`` of the up to ``k`` earlier values of the series, nearest first.

    ``order`` must be a total order within a series.
    """
    keys, order = list(keys), list(order)
    split, chunks = split_hot(df, keys, order, target_rows)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    # The struct keeps null values in the list.
    item = F.struct(F.col(value).alias("x"))
    if k <= _FEW_LAGS:
        own = split.withColumns({f"_lag{i}": F.lag(item, i).over(w) for i in range(1, k + 1)})
        near = F.array(*[F.col(f"_lag{i}") for i in range(1, k + 1)])
        own = own.withColumn(name, F.filter(near, lambda e: e.isNotNull())).drop(
            *[f"_lag{i}" for i in range(1, k + 1)])
    else:
        own = split.withColumn(name, F.reverse(F.collect_list(item).over(w.rowsBetween(-k, -1))))
    if chunks:
        own = (_carried(own, _carry_last(split, keys, order, value, k), keys, chunks * k)
               .withColumn(name, F.when(
                   (F.size(name) < k) & F.col("_carry").isNotNull(),
                   F.slice(F.concat(F.col(name), F.col("_carry")), 1, k)).otherwise(F.col(name)))
               .drop("_carry"))
    return own.withColumn(name, F.transform(name, lambda e: e["x"])).drop("_chunk", "_hot")


def _carry_last(split: DataFrame, keys: list[str], order: list[str], value: str, k: int) -> DataFrame:
    """Per chunk the last ``k`` values of the series before it, nearest first."""
    back = Window.partitionBy(*keys, "_chunk").orderBy(*[F.col(c).desc() for c in order])
    ends = (split.where("_hot").select(*keys, "_chunk", *order, value)
            .withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= k))
    last = (ends.groupBy(*keys, "_chunk")
            .agg(F.sort_array(F.collect_list(
                F.struct((-F.col("_back")).alias("p"), F.struct(F.col(value).alias("x")).alias("e"))),
                asc=False).alias("_own"))
            .withColumn("_own", F.transform("_own", lambda s: s["e"])))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(-k, -1)
    return last.select(
        *keys, "_chunk",
        F.slice(F.flatten(F.reverse(F.collect_list("_own").over(before))), 1, k).alias("_carry"))


def with_running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | None = None,
                 target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Add ``running_count`` (the 1-based time index) and, given ``value``, ``running_sum``."""
    keys, order = list(keys), list(order)
    split, chunks = split_hot(df, keys, order, target_rows)
    w = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    total = F.sum(value) if value else F.sum(F.lit(0.0))
    out = split.withColumn("running_count", F.count(F.lit(1)).over(w))
    if value:
        out = out.withColumn("running_sum", F.sum(value).over(w))
    if chunks:
        before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (split.where("_hot").groupBy(*keys, "_chunk")
                   .agg(F.count(F.lit(1)).alias("_n"), total.alias("_s"))
                   .select(*keys, "_chunk", F.sum("_n").over(before).alias("_n0"),
                           F.sum("_s").over(before).alias("_s0")))
        out = _carried(out, offsets, keys, chunks).withColumn(
            "running_count", F.col("running_count") + F.coalesce("_n0", F.lit(0)))
        if value:
            out = out.withColumn("running_sum", F.when(
                F.col("running_sum").isNull(), F.col("_s0")).otherwise(
                F.col("running_sum") + F.coalesce("_s0", F.lit(0))))
        out = out.drop("_n0", "_s0")
    return out.drop("_chunk", "_hot")


def with_next(df: DataFrame, keys: Sequence[str], column: str, target_rows: int | None = TARGET_ROWS,
              name: str = "_next") -> DataFrame:
    """Add the following value of the series in the order of ``column`` itself; null on its last row."""
    keys = list(keys)
    split, chunks = split_hot(df, keys, [column], target_rows)
    out = split.withColumn(name, F.lead(column).over(Window.partitionBy(*keys, "_chunk").orderBy(column)))
    if chunks:
        firsts = split.where("_hot").groupBy(*keys, "_chunk").agg(F.min(column).alias("_first"))
        after = firsts.select(*keys, "_chunk", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_chunk")).alias("_after"))
        out = (_carried(out, after, keys, chunks)
               .withColumn(name, F.coalesce(name, "_after")).drop("_after"))
    return out.drop("_chunk", "_hot")


def with_page(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int,
              target_rows: int | None = TARGET_ROWS, name: str = "page") -> DataFrame:
    """Number consecutive pages of ``rows`` rows within a series, from 0.

    Lists gathered per series and page have a fixed greatest length, whatever a series holds.
    """
    run = with_running(df, keys, order, None, target_rows)
    page = F.call_function("div", F.col("running_count") - F.lit(1), F.lit(rows).cast("long"))
    return run.withColumn(name, page).drop("running_count")


def difference(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
               target_rows: int | None = TARGET_ROWS, name: str = "diff") -> DataFrame:
    """First difference within a series; null on its first row."""
    lagged = with_lags(df, keys, order, value, 1, target_rows, "_prev")
    return lagged.withColumn(name, F.col(value) - F.try_element_at("_prev", F.lit(1))).drop("_prev")


def undo_difference(df: DataFrame, keys: Sequence[str], order: Sequence[str], diff: str, start: Column,
                    target_rows: int | None = TARGET_ROWS, name: str = "level") -> DataFrame:
    """Levels from first differences: the running sum on top of ``start``."""
    run = with_running(df, keys, order, diff, target_rows)
    return run.withColumn(name, start + F.col("running_sum")).drop("running_sum", "running_count")


def last_points(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The ``n`` latest rows of each series, ``_back`` = 1 for the last.

    Spark prunes to n rows per key before the shuffle (window group limit), so hot series are safe.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_back", F.row_number().over(w)).where(F.col("_back") <= n)


def number_in_order(df: DataFrame, order: Sequence[str], name: str = "no", start: int = 0) -> DataFrame:
    """Dense global numbering of the rows of ``df`` by ``order``, without gathering them in one task.

    The rows are range-partitioned and sorted, then materialised; row positions come from partition-local
    ids plus the sizes of the partitions before, a table with one row per partition.
    """
    fixed = cut(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_id"), 33)
    pos = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (fixed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
             .select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_before")))
    return (fixed.withColumn("_part", part)
            .join(F.broadcast(sizes), "_part")
            .withColumn(name, F.col("_before") + pos + F.lit(start))
            .drop("_id", "_part", "_before"))


def number_series(df: DataFrame, label: str, ts: str, name: str = "sensor") -> DataFrame:
    """Sensor numbers 0.. for the labels of ``df`` in first-seen order (ties by label)."""
    first = df.groupBy(label).agg(F.min(ts).alias("first_seen"))
    return number_in_order(first, ["first_seen", label], name)
