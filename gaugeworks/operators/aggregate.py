"""Group and whole-table aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators.select import PAGE_ROWS, point_lists, values_of


def count_by_sensor(df: DataFrame) -> DataFrame:
    return df.groupBy("sensor").agg(F.count(F.lit(1)).alias("cnt"))


def summary(df: DataFrame, by: Sequence[Column], value: Column, ts: str = "ts") -> DataFrame:
    """Count, max, min, mean and last timestamp per group.

    Nulls do not count, so a group without any value gives 0 and nulls.
    """
    return df.groupBy(*by).agg(
        F.count(value).alias("cnt"), F.max(value).alias("max"), F.min(value).alias("min"),
        F.avg(value).alias("avg"), F.max(ts).alias("ts"))


def sum_by_time(df: DataFrame) -> DataFrame:
    """One series: the sum over all sensors at each time."""
    return df.groupBy("ts").agg(F.sum("value").alias("value"))


def values_by_type(df: DataFrame, keys: Sequence[str], type_col: str, order: Sequence[str], value: str,
                   page_rows: int = PAGE_ROWS) -> DataFrame:
    """Per key and ``page`` a map type -> values in order; a list longer than ``page_rows`` goes on in
    the next page."""
    lists = point_lists(df, [*keys, type_col], order, value, page_rows)
    return lists.groupBy(*keys, "page").agg(F.map_from_entries(F.collect_list(
        F.struct(F.col(type_col), values_of("points").alias("values")))).alias("series"))


def shortest_list(df: DataFrame, keys: Sequence[str], type_col: str) -> DataFrame:
    """Per key the least number of values over the types present, and how many types there are."""
    return (df.groupBy(*keys, type_col).agg(F.count(F.lit(1)).alias("_n"))
            .groupBy(*keys).agg(F.min("_n").alias("min_n"), F.count(F.lit(1)).alias("types")))


def profile_sensors(df: DataFrame) -> DataFrame:
    """Records per sensor of each container."""
    return df.groupBy("swimlane", "sensor").agg(F.count(F.lit(1)).alias("records"))


def profile_containers(df: DataFrame) -> DataFrame:
    """Records and sensors used per container, rolled up from the sensor counts."""
    return profile_sensors(df).groupBy("swimlane").agg(
        F.sum("records").alias("records"), F.count(F.lit(1)).alias("sensors"))


def grand_totals(df: DataFrame) -> DataFrame:
    return profile_containers(df).agg(
        F.count(F.lit(1)).alias("containers"), F.sum("sensors").alias("sensors"),
        F.sum("records").alias("records"))
