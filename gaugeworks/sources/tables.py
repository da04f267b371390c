"""Partitioned tables, write-back and output formats."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions import geo
from gaugeworks.functions.scalars import duration_seconds
from gaugeworks.operators.select import PAGE_ROWS, point_lists, recent
from gaugeworks.session import remove_path


def with_slice(df: DataFrame, seconds: int, ts: str = "ts") -> DataFrame:
    """Add the storage slice, epoch div width."""
    return df.withColumn("slice", F.floor(F.unix_seconds(ts) / F.lit(seconds)).cast("long"))


def write_readings(df: DataFrame, path: str, slice_seconds: int, mode: str = "append",
                   by: Sequence[str] = ("measurement", "site"), order: Sequence[str] = ("sensor", "ts")) -> None:
    """Write partitioned by ``by`` and slice, sorted by ``order`` (where there are such columns) within files.

    The rebalance hint lets AQE merge small partitions and split large ones, so neither many tiny files nor
    one task with a hot partition result. In a sorted file a read of a few sensors leaves most row groups out.
    """
    cols = [*by, "slice"]
    # A partition column that may be null is rewritten by the writer, which then sorts anew; this name reads back as null.
    texts = {c: F.coalesce(F.col(c), F.lit("__HIVE_DEFAULT_PARTITION__")) for c in by if df.schema[c].dataType.simpleString() == "string"}
    (with_slice(df, slice_seconds).withColumns(texts).hint("rebalance", *cols).sortWithinPartitions(*cols, *[c for c in order if c in df.columns])
     .write.mode(mode).partitionBy(*cols).parquet(path))


def expire(df: DataFrame, keep: str = "30d", anchor: dt.datetime | None = None, slice_seconds: int | None = None) -> DataFrame:
    """Rows not older than ``keep`` before the anchor (default: the newest row). With the width of its slices, a
    partitioned table is read from the retention edge on."""
    return recent(df, keep, anchor, slice_seconds=slice_seconds)


def expired_slices(df: DataFrame, slice_seconds: int, keep: str, anchor: dt.datetime, by: Sequence[str] = ()) -> DataFrame:
    """Whole slices that lie before the retention edge: partitions which can be dropped. With ``by`` one row per partition."""
    edge = int(anchor.timestamp()) - duration_seconds(keep)
    return df.where((F.col("slice") + 1) * slice_seconds <= edge).select(*by, "slice").distinct()


def drop_expired(spark: SparkSession, path: str, slice_seconds: int, keep: str, anchor: dt.datetime,
                 by: Sequence[str] = ("measurement", "site")) -> list[str]:
    """Remove the folders of the slices that lie wholly before the retention edge; gives the removed folders.

    The table is laid out as ``write_readings`` writes it. What comes to the driver is a list of partitions, not of rows.
    """
    old = expired_slices(spark.read.parquet(path).select(*by, "slice"), slice_seconds, keep, anchor, by)
    gone = ["/".join([path.rstrip("/"), *(f"{c}={r[c]}" for c in by), f"slice={r['slice']}"]) for r in old.collect()]
    for folder in gone:
        remove_path(spark, folder)
    return gone


def read_back_diff(source: DataFrame, stored: DataFrame, keys: Sequence[str] = ("sensor", "ts"),
                   values: Sequence[str] = ("value",)) -> DataFrame:
    """Rows missing on one side or with other values, by full outer join on ``keys``."""
    a = source.select(*keys, F.struct(*values).alias("expected"))
    b = stored.select(*keys, F.struct(*values).alias("found"))
    both = a.join(b, list(keys), "full_outer")
    status = (F.when(F.col("found").isNull(), "missing").when(F.col("expected").isNull(), "extra")
              .when(~F.col("expected").eqNullSafe(F.col("found")), "differs"))
    return both.withColumn("status", status).where(F.col("status").isNotNull())


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows (with multiplicity) in one set and not in the other; empty when the sets are equal."""
    return (a.exceptAll(b).withColumn("side", F.lit("left"))
            .unionByName(b.exceptAll(a).withColumn("side", F.lit("right"))))


def latest_labels(updates: DataFrame, ts: str = "ts") -> DataFrame:
    """Sensor label table from label updates; the latest update wins."""
    return updates.groupBy("sensor").agg(F.max_by("label", F.struct(ts, "label")).alias("label"))


def point_positions(df: DataFrame) -> DataFrame:
    """Positions of point sensors as boxes without extent."""
    return df.groupBy("sensor").agg(F.max("lat").alias("lat1"), F.max("lat").alias("lat2"),
                                    F.max("lng").alias("lng1"), F.max("lng").alias("lng2"))


def cell_positions(sensors: DataFrame) -> DataFrame:
    """Positions of grid-cell sensors, derived from their labels."""
    parsed = sensors.withColumn("_b", geo.cell_bounds(F.col("label")))
    return parsed.select("sensor", "_b.lat1", "_b.lat2", "_b.lng1", "_b.lng2")


def text_rows(df: DataFrame, columns: Sequence[str], decimals: int | None = None) -> DataFrame:
    """One comma-separated ``line`` per row; doubles are rounded to ``decimals``."""
    def text(c: str) -> Column:
        if df.schema[c].dataType.simpleString() in ("double", "float") and decimals is not None:
            return F.format_string(f"%.{decimals}f", F.round(c, decimals))
        return F.col(c).cast("string")

    return df.select(F.concat_ws(",", *[F.coalesce(text(c), F.lit("null")) for c in columns]).alias("line"))


def json_rows(df: DataFrame, key: str = "sensor", value: str = "value", ts: str = "ts",
              page_rows: int = PAGE_ROWS) -> DataFrame:
    """Per sensor the JSON list of its values in time order, in pages of at most ``page_rows`` values."""
    lists = point_lists(df, [key], [ts, value], value, page_rows)
    points = F.transform("points", lambda p: F.struct(F.unix_seconds(p[ts]).alias("ts"), p["value"].alias("value")))
    return lists.select(key, "page", F.to_json(points).alias("json"))


def append_metrics(df: DataFrame, path: str) -> None:
    """Append ``labels, ts, value`` rows to a metrics table."""
    df.select("labels", "ts", "value").write.mode("append").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch so that a replay replaces it instead of doubling it."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All micro-batches written by ``write_batch``."""
    return spark.read.parquet(path).drop("batch")


def compact(spark: SparkSession, path: str, out: str, by: Sequence[str]) -> None:
    """Rewrite a table of many small files in partitions of even size."""
    spark.read.parquet(path).hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(out)
