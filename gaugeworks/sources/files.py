"""Readers for wide series, event catalogues and payload files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.scalars import country_label, from_epoch
from gaugeworks.schema import LABELS, POINT_VALUE

ROW_CAP = 2_000_000


def read_wide_series(spark: SparkSession, path: str) -> DataFrame:
    """Comma file with province, country, lat, lng and one column per day (``M/d/yy``).

    Comes out long: ``label, lat, lng, ts, value``.
    """
    raw = spark.read.option("header", True).csv(path)
    province, country, lat, lng, *days = raw.columns
    kept = raw.select(
        country_label(F.col(f"`{country}`"), F.col(f"`{province}`")).alias("label"),
        F.col(f"`{lat}`").cast("double").alias("lat"), F.col(f"`{lng}`").cast("double").alias("lng"),
        *[F.col(f"`{d}`").cast("long").alias(d) for d in days])
    long = kept.unpivot(["label", "lat", "lng"], [f"`{d}`" for d in days], "day", "value")
    parsed = F.to_timestamp("day", "M/d/yy")
    # Two-digit years 69 to 99 belong to the 1900s.
    ts = F.when(F.year(parsed) >= 2069, parsed - F.make_ym_interval(F.lit(100))).otherwise(parsed)
    return long.where(F.col("value").isNotNull()).withColumn("ts", ts).drop("day")


# Positions of the columns used in an event catalogue.
_CATALOGUE = {"date": 2, "time": 3, "lat": 4, "lng": 5, "depth": 6, "m": 7, "kind": 13}


def read_event_catalogue(spark: SparkSession, path: str, kind: str = "Ke", site: str = "tr",
                         measurement: str = "m1") -> DataFrame:
    """Tab file of events as readings with the structured value ``v``; fractions of a second are dropped."""
    width = max(_CATALOGUE.values()) + 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    raw = spark.read.option("header", True).option("sep", "\t").option("enforceSchema", True).schema(
        schema).csv(path)
    col = {n: F.col(f"c{i}") for n, i in _CATALOGUE.items()}
    ts = F.date_trunc("second", F.to_timestamp(
        F.concat_ws("T", col["date"], F.regexp_extract(col["time"], r"^[0-9:]+", 0)),
        "yyyy.MM.dd'T'HH:mm:ss"))
    value = F.struct(
        col["m"].cast("double").alias("m"), col["lat"].cast("double").alias("lat"),
        col["lng"].cast("double").alias("lng"),
        F.bround(F.abs(col["depth"].cast("double"))).cast("int").alias("alt"))
    return (raw.where(col["kind"] == kind)
            .select(F.lit(measurement).alias("measurement"), F.lit(site).alias("site"),
                    ts.alias("ts"), value.alias("v")))


def capped(df: DataFrame, rows: int = ROW_CAP) -> DataFrame:
    """Import at most ``rows`` rows."""
    return df.limit(rows)


_PAYLOAD = T.StructType([
    T.StructField("measurement", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("series", LABELS),
    T.StructField("data", T.ArrayType(T.StructType([
        T.StructField("ns", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("series", LABELS),
    ]))),
])


def read_payloads(spark: SparkSession, path: str, one_per_line: bool = False) -> DataFrame:
    """Payload rows ``measurement, key, labels, ts, raw``; outer and row labels are merged.

    A file is one JSON list, which is read by a single task, or has one payload per line, which splits.
    ``raw`` is the value as JSON text; see ``numeric_value`` and ``point_value``.
    """
    payloads = spark.read.option("multiLine", not one_per_line).schema(_PAYLOAD).json(path)
    rows = payloads.select("measurement", "key", "series", F.explode("data").alias("d"))
    return rows.select("measurement", "key", merged_labels(F.col("series"), F.col("d.series")).alias("labels"),
                       from_epoch(F.col("d.ns")).alias("ts"), F.col("d.value").alias("raw"))


def numeric_value(raw: Column) -> Column:
    return raw.cast("double")


def point_value(raw: Column) -> Column:
    return F.from_json(raw, POINT_VALUE)


def merged_labels(outer: Column, inner: Column) -> Column:
    """Labels of the series joined with those of the row; the row's win."""
    empty = F.create_map().cast(LABELS)
    inner = F.coalesce(inner, empty)
    outer = F.map_filter(F.coalesce(outer, empty), lambda k, _: ~F.map_contains_key(inner, k))
    return F.map_concat(outer, inner)


def long_records(df: DataFrame, json: str = "json") -> DataFrame:
    """Wide records ``{"ns": t, "0": v, ...}`` to rows ``sensor, ts, value``; absent sensors give no row."""
    parsed = df.select(F.from_json(json, "map<string,double>").alias("_m"))
    return (parsed.select(from_epoch(F.col("_m")["ns"].cast("long")).alias("ts"),
                          F.explode(F.map_filter("_m", lambda k, _: k != "ns")).alias("_k", "value"))
            .select(F.col("_k").cast("long").alias("sensor"), "ts", "value"))


def route(df: DataFrame, swimlane: Column, sensor: Column) -> DataFrame:
    """Apply routing expressions: which container and which sensor a row belongs to."""
    return df.withColumns({"swimlane": swimlane, "sensor_key": sensor})
