"""Projections, filters and ordering on readings and metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.scalars import duration_seconds
from gaugeworks.operators.series import with_page


def sensor(df: DataFrame, no: int) -> DataFrame:
    return df.where(F.col("sensor") == no)


def sensor_range(df: DataFrame, first: int, last: int) -> DataFrame:
    """Sensors ``first`` to ``last``, both included."""
    return df.where(F.col("sensor").between(first, last))


def use(df: DataFrame, swimlane: str) -> DataFrame:
    """Rows of one container; a partition filter on tables laid out by container."""
    return df.where(F.col("swimlane") == swimlane)


def computed(df: DataFrame, keys: Sequence[str], replace: bool = True, **columns: Column) -> DataFrame:
    """Add computed columns; with ``replace`` only ``keys`` and the new columns remain."""
    named = [c.alias(n) for n, c in columns.items()]
    return df.select(*keys, *named) if replace else df.select("*", *named)


def merge_series(df: DataFrame, name: str = "area") -> DataFrame:
    """Fold all sensors into one series: the series key becomes a constant, all rows stay."""
    return df.withColumn("series", F.lit(name))


PAGE_ROWS = 10_000


def point_lists(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "value",
                page_rows: int = PAGE_ROWS) -> DataFrame:
    """Points of a series as arrays of structs (the order columns, then ``value``), one per ``page`` of rows."""
    paged = with_page(df, keys, order, page_rows)
    fields = [F.col(c) for c in order if c != value] + [F.col(value).alias("value")]
    point = F.struct(*fields)
    return paged.groupBy(*keys, "page").agg(F.sort_array(F.collect_list(point)).alias("points"))


def values_of(points: str) -> Column:
    """Values of an ordered array of points, timestamps stripped."""
    return F.transform(points, lambda p: p["value"])


def datapoints(df: DataFrame, points: str, keys: Sequence[str]) -> DataFrame:
    """One row per point of an array of ``{ts, value}``."""
    return df.select(*keys, F.inline(points))


def time_range(df: DataFrame, start: str, end: str, ts: str = "ts",
               slice_seconds: int | None = None) -> DataFrame:
    """Half-open range ``[start, end)``.

    On a table partitioned by ``slice`` (epoch div width) give its width: the range then also prunes
    partitions.
    """
    a, b = _utc(start), _utc(end)
    out = df.where((F.col(ts) >= F.lit(a)) & (F.col(ts) < F.lit(b)))
    if slice_seconds:
        lo, hi = (int(t.timestamp()) // slice_seconds for t in (a, b))
        out = out.where(F.col("slice").between(lo, hi))
    return out


def _utc(text: str) -> dt.datetime:
    t = dt.datetime.fromisoformat(text)
    return t if t.tzinfo else t.replace(tzinfo=dt.timezone.utc)


def recent(df: DataFrame, duration: str, anchor: dt.datetime | None = None, ts: str = "ts",
           slice_seconds: int | None = None) -> DataFrame:
    """Rows not older than ``duration`` before the anchor, by default the latest row of ``df``.

    On a table partitioned by ``slice`` give its width: the range then prunes partitions, and the default anchor, a
    scalar subquery over the time column, reads the last slice only.
    """
    seconds = duration_seconds(duration)
    span = F.make_dt_interval(secs=F.lit(seconds))
    if anchor is not None:
        out = df.where(F.col(ts) >= F.lit(anchor) - span)
        return out.where(F.col("slice") >= (int(anchor.timestamp()) - seconds) // slice_seconds) if slice_seconds else out
    last = df.where(F.col("slice") == df.agg(F.max("slice").alias("last")).scalar()) if slice_seconds else df
    newest = last.agg(F.max(ts).alias("newest")).scalar()
    out = df.where(F.col(ts) >= newest - span)
    if slice_seconds:
        edge = last.agg(F.floor((F.unix_seconds(F.max(ts)) - seconds) / slice_seconds).alias("edge")).scalar()
        out = out.where(F.col("slice") >= edge)
    return out


def min_records(df: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    """Rows of the series with more than ``more_than`` records (semi join on partial counts)."""
    keep = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_cnt")).where(F.col("_cnt") > more_than)
    return df.join(keep.select(*keys), list(keys), "left_semi")


@dataclass(frozen=True)
class Matcher:
    """A label test: ``EQ``, ``NEQ``, ``RE`` or ``NRE``; patterns (Java's dialect) cover the whole label text."""

    label: str
    value: str
    rule: str = "EQ"

    def column(self, labels: str = "labels") -> Column:
        return self.test(F.coalesce(F.try_element_at(F.col(labels), F.lit(self.label)), F.lit("")))

    def test(self, text: Column) -> Column:
        if self.rule in ("EQ", "NEQ"):
            hit = text == self.value
        elif self.rule in ("RE", "NRE"):
            hit = text.rlike(rf"\A(?:{self.value})\z")
        else:
            raise ValueError(f"unknown rule {self.rule!r}")
        return ~hit if self.rule.startswith("N") else hit


def select_metrics(df: DataFrame, from_ms: int, to_ms: int, matchers: Sequence[Matcher],
                   slice_seconds: int | None = None, by: dict[str, str] | None = None) -> DataFrame:
    """Metric rows within ``[from_ms, to_ms]`` that pass all matchers.

    On a partitioned table ``slice_seconds`` makes the range prune slices, and ``by`` names the partition column that holds
    a label (``{"__name__": "site"}``): a test on that label then prunes partitions, too.
    """
    out = df.where(F.col("ts").between(F.timestamp_millis(F.lit(from_ms)),
                                       F.timestamp_millis(F.lit(to_ms))))
    if slice_seconds:
        out = out.where(F.col("slice").between(from_ms // 1000 // slice_seconds, to_ms // 1000 // slice_seconds))
    for m in matchers:
        out = out.where(m.column())
        if m.label in (by or {}):
            out = out.where(m.test(F.coalesce(F.col(by[m.label]), F.lit(""))))
    return out


def having_label(df: DataFrame, label: str, labels: str = "labels") -> DataFrame:
    return df.where(F.map_contains_key(labels, label))


def filter_map(df: DataFrame, keep: Column, **columns: Column) -> DataFrame:
    """Rows that pass ``keep``, rewritten to ``columns``."""
    return df.where(keep).select(*[c.alias(n) for n, c in columns.items()])


def find_sensor(sensors: DataFrame, label: str) -> DataFrame:
    return sensors.where(F.col("label") == label).select("sensor")


def containers(df: DataFrame) -> DataFrame:
    return df.select("swimlane").distinct()


def containers_of_tags(df: DataFrame, **tags: str) -> DataFrame:
    """Containers that hold series with the given labels."""
    out = df
    for key, val in tags.items():
        out = out.where(F.try_element_at("labels", F.lit(key)) == val)
    return containers(out)


def large_containers(df: DataFrame, min_sensors: int) -> DataFrame:
    """Containers with at least ``min_sensors`` sensors."""
    return (df.groupBy("swimlane").agg(F.count_distinct("sensor").alias("sensors"))
            .where(F.col("sensors") >= min_sensors))


def top_containers(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` containers with most sensors; ties go to the greatest name."""
    return (df.groupBy("swimlane").agg(F.count_distinct("sensor").alias("sensors"))
            .orderBy(F.desc("sensors"), F.desc("swimlane")).limit(n))


def sources(*parts: DataFrame) -> DataFrame:
    """Union of the sources of a job, by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def per_series(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A named function in a select: one frame-to-frame step keyed by series."""
    return df.transform(fn)
