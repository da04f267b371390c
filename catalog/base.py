"""Registry of the checked queries and the fixture mapping of the driver tables to the data model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, the oracle text."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


# Times are declared as instants (the zone is UTC), so that time filters reach the scan without a cast.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp, o_orderpriority string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf}/{name}.parquet")


def lat_of(key: Column) -> Column:
    return (F.lit(25) + key * 7 % 45).cast("double") + 0.37


def lng_of(key: Column) -> Column:
    return (F.lit(-20) + key * 11 % 60).cast("double") + 0.61


def readings(spark: SparkSession, sf: str) -> DataFrame:
    """Events as readings: user = sensor, event type = site, ten containers."""
    ev = table(spark, sf, "events")
    alt = F.get_json_object("props", "$.k").cast("int")
    lat, lng = lat_of(F.col("user_id")), lng_of(F.col("user_id"))
    return ev.select(
        "event_id", F.lit("events").alias("measurement"), F.col("event_type").alias("site"),
        F.concat(F.lit("lane"), F.col("user_id") % 10).alias("swimlane"), F.col("user_id").alias("sensor"),
        F.create_map(F.lit("__name__"), F.col("event_type"), F.lit("instance"),
                     F.concat(F.lit("u"), F.col("user_id"))).alias("labels"),
        "ts", "value",
        F.struct(F.col("value").alias("m"), lat.alias("lat"), lng.alias("lng"), alt.alias("alt")).alias("v"))


def sensors(spark: SparkSession, sf: str) -> DataFrame:
    """Sensor names: nation and customer."""
    nation = table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return table(spark, sf, "customer").join(nation, "c_nationkey").select(
        F.col("c_custkey").alias("sensor"), F.concat_ws(".", "n_name", "c_name").alias("label"))


def positions(spark: SparkSession, sf: str) -> DataFrame:
    """Point positions of all customers as sensors."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        key.alias("sensor"), lat_of(key).alias("lat1"), lat_of(key).alias("lat2"),
        lng_of(key).alias("lng1"), lng_of(key).alias("lng2"))


def health(spark: SparkSession, sf: str) -> DataFrame:
    """Four health metrics per instance: ten instances, values of the last three scaled to ratios."""
    r = readings(spark, sf)
    kind = (F.when(F.col("site") == "click", "ping").when(F.col("site") == "error", "cpu")
            .when(F.col("site") == "view", "mem").when(F.col("site") == "purchase", "reject"))
    value = F.when(F.col("site") == "click", F.col("value")).otherwise(F.col("value") / 500)
    return (r.withColumn("type", kind).where(F.col("type").isNotNull())
            .select(F.col("swimlane").alias("instance"), "type", "ts", value.alias("value")))


def risk_series(spark: SparkSession, sf: str) -> DataFrame:
    """Risk metrics per user: clicks as ddos, views as overload, scaled to 0..1."""
    r = readings(spark, sf).where(F.col("site").isin("click", "view"))
    risk = F.when(F.col("site") == "click", "ddos").otherwise("overload")
    labels = F.create_map(
        F.lit("__name__"), F.lit("instance_risk"), F.lit("instance"), F.col("labels")["instance"],
        F.lit("risk"), risk, F.lit("when"), F.when(F.col("v.alt") < 80, "now").otherwise("future"))
    return r.select(labels.alias("labels"), "ts", (F.col("value") / 500).alias("value"))


def cpt(spark: SparkSession) -> DataFrame:
    """Probability tables by a rule of our own (see CPT_SQL for the same rule)."""
    states = {0: 2, 1: 3, 2: 5, 3: 5, 4: 5, 5: 2, 6: 2}
    rows = [(5, 0, [], 0.9), (5, 1, [], 0.1), (6, 0, [], 0.75), (6, 1, [], 0.25)]
    for node in range(1, 5):
        for a in range(2):
            for b in range(2):
                lean = 2 * a + b if node in (1, 4) else a + 2 * b
                w = [1.0 + s * lean for s in range(states[node])]
                rows += [(node, s, [a, b], w[s] / sum(w)) for s in range(states[node])]
    for s1 in range(3):
        for s2 in range(5):
            for s3 in range(5):
                for s4 in range(5):
                    p = 0.02 + 0.05 * (s1 + s2 + s3 + s4)
                    rows += [(0, 0, [s1, s2, s3, s4], 1.0 - p), (0, 1, [s1, s2, s3, s4], p)]
    return spark.createDataFrame(rows, "node int, state int, parents array<int>, p double")


def secs(c: str = "ts") -> Column:
    return F.unix_seconds(c)


# The same mapping for the oracle.
READINGS = """readings AS (SELECT event_id, 'events' AS measurement, event_type AS site,
    'lane' || (user_id % 10) AS swimlane, user_id AS sensor, 'u' || user_id AS instance, ts,
    epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS t, value,
    CAST(json_extract(props, '$.k') AS INTEGER) AS alt,
    CAST(25 + user_id * 7 % 45 AS DOUBLE) + 0.37 AS lat,
    CAST(-20 + user_id * 11 % 60 AS DOUBLE) + 0.61 AS lng FROM events)"""
SENSORS = """sensors AS (SELECT c_custkey AS sensor, n_name || '.' || c_name AS label
    FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
POSITIONS = """positions AS (SELECT c_custkey AS sensor, CAST(25 + c_custkey * 7 % 45 AS DOUBLE) + 0.37 AS lat,
    CAST(-20 + c_custkey * 11 % 60 AS DOUBLE) + 0.61 AS lng FROM customer)"""
HEALTH = """health AS (SELECT swimlane AS instance, CASE site WHEN 'click' THEN 'ping' WHEN 'error' THEN 'cpu'
    WHEN 'view' THEN 'mem' ELSE 'reject' END AS type, ts, t, us,
    CASE WHEN site = 'click' THEN value ELSE value / 500 END AS value
    FROM readings WHERE site IN ('click', 'error', 'view', 'purchase'))"""
RISKS = """risks AS (SELECT instance, CASE site WHEN 'click' THEN 'ddos' ELSE 'overload' END AS risk,
    CASE WHEN alt < 80 THEN 'now' ELSE 'future' END AS whn, t, value / 500 AS value
    FROM readings WHERE site IN ('click', 'view'))"""
STATE = """CASE type
    WHEN 'ping' THEN CASE WHEN value <= 50 THEN 0 WHEN value <= 500 THEN 1 ELSE 2 END
    WHEN 'cpu' THEN CASE WHEN value <= 0.10 THEN 0 WHEN value <= 0.25 THEN 1 WHEN value <= 0.40 THEN 2
        WHEN value <= 0.55 THEN 3 ELSE 4 END
    WHEN 'mem' THEN CASE WHEN value <= 0.1 THEN 0 WHEN value <= 0.2 THEN 1 WHEN value <= 0.3 THEN 2
        WHEN value <= 0.4 THEN 3 ELSE 4 END
    ELSE CASE WHEN value <= 0.001 THEN 0 WHEN value <= 0.01 THEN 1 WHEN value <= 0.1 THEN 2
        WHEN value <= 0.5 THEN 3 ELSE 4 END END"""
CPT_SQL = """ab AS (SELECT a.a, b.b, CASE a.a WHEN 1 THEN 0.1 ELSE 0.9 END * CASE b.b WHEN 1 THEN 0.25 ELSE 0.75 END
    AS prior FROM (VALUES (0), (1)) a(a), (VALUES (0), (1)) b(b)),
  lk AS (SELECT node, s, a, b, (1.0 + s * lean) / sum(1.0 + s * lean) OVER (PARTITION BY node, a, b) AS p
    FROM (SELECT node, s, a, b, CASE WHEN node IN (1, 4) THEN 2 * a + b ELSE a + 2 * b END AS lean
      FROM (VALUES (1, 3), (2, 5), (3, 5), (4, 5)) n(node, k), range(5) r(s), ab WHERE s < k))"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts)
