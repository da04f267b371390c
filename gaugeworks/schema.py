"""Canonical schemas of the data model."""

from pyspark.sql import types as T

LABELS = T.MapType(T.StringType(), T.StringType())

POINT_VALUE = T.StructType([
    T.StructField("m", T.DoubleType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()),
    T.StructField("alt", T.IntegerType()),
])

READINGS = T.StructType([
    T.StructField("measurement", T.StringType()),
    T.StructField("site", T.StringType()),
    T.StructField("swimlane", T.StringType()),
    T.StructField("sensor", T.LongType()),
    T.StructField("labels", LABELS),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("v", POINT_VALUE),
])

SENSORS = T.StructType([
    T.StructField("sensor", T.LongType()),
    T.StructField("label", T.StringType()),
])

POSITIONS = T.StructType([
    T.StructField("sensor", T.LongType()),
    T.StructField("lat1", T.DoubleType()),
    T.StructField("lat2", T.DoubleType()),
    T.StructField("lng1", T.DoubleType()),
    T.StructField("lng2", T.DoubleType()),
])

METRICS = T.StructType([
    T.StructField("labels", LABELS),
    T.StructField("ts", T.TimestampType()),
    T.StructField("value", T.DoubleType()),
])

CPT = T.StructType([
    T.StructField("node", T.IntegerType()),
    T.StructField("state", T.IntegerType()),
    T.StructField("parents", T.ArrayType(T.IntegerType())),
    T.StructField("p", T.DoubleType()),
])
