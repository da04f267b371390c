"""Sources and sinks. Input files are written by Spark from the tables, then read by the operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (READINGS, RISKS, SENSORS, lat_of, lng_of, query, readings, risk_series, secs,
                          table, with_)
from catalog.sqlgeo import sql_decode
from gaugeworks.operators import aggregate, select
from gaugeworks.operators.series import with_page
from gaugeworks.plans import jobs
from gaugeworks.session import scratch_path
from gaugeworks.sources import files, kafka, tables

@query("a1_wide_csv_import", with_(SENSORS) + """
SELECT CASE WHEN c_custkey % 2 = 0 THEN n_name ELSE n_name || '.' || c_name END AS label,
  CAST(25 + c_custkey * 7 % 45 AS DOUBLE) + 0.37 AS lat, CAST(-20 + c_custkey * 11 % 60 AS DOUBLE) + 0.61 AS lng,
  epoch_us(date_trunc('month', o_orderdate)) // 1000000 AS t, count(*) AS value
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY c_custkey, c_name, n_name, date_trunc('month', o_orderdate)""")
def a1(spark, sf):
    cust = table(spark, sf, "customer").join(
        table(spark, sf, "nation").withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey")
    # A wide file has one column per month of the orders.
    first, last = table(spark, sf, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    months = [divmod(i, 12) for i in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]
    head = {(y, m + 1): f"{m + 1}/1/{y % 100:02d}" for y, m in months}
    ym = F.year("o_orderdate") * 100 + F.month("o_orderdate")
    counts = (table(spark, sf, "orders").groupBy("o_custkey")
              .agg(*[F.count_if(ym == y * 100 + m).alias(h) for (y, m), h in head.items()]))
    key = F.col("c_custkey")
    wide = cust.join(counts, key == F.col("o_custkey")).select(
        F.when(key % 2 == 0, F.lit(" ")).otherwise(F.col("c_name")).alias("province"),
        F.col("n_name").alias("country"), lat_of(key).alias("lat"), lng_of(key).alias("lng"),
        *[F.when(F.col(f"`{h}`") > 0, F.col(f"`{h}`")).alias(h) for h in head.values()])
    path = scratch_path(spark, "wide")
    wide.write.option("header", True).csv(path)
    return files.read_wide_series(spark, path).select("label", "lat", "lng", secs().alias("t"), "value")


@query("a2_event_catalogue_import", with_(READINGS) + """
SELECT t, value AS m, lat, lng, CAST(round_even(abs(-(alt + 0.5)), 0) AS INTEGER) AS alt
FROM readings WHERE site IN ('click', 'error')""")
def a2(spark, sf):
    r = readings(spark, sf)
    blank = [F.lit("-").alias(f"x{i}") for i in range(5)]
    out = r.select(
        "event_id", F.lit("-").alias("code"), F.date_format("ts", "yyyy.MM.dd").alias("date"),
        F.date_format("ts", "HH:mm:ss.SS").alias("time"), F.col("v.lat").alias("lat"), F.col("v.lng").alias("lng"),
        (-(F.col("v.alt") + F.lit(0.5))).alias("depth"), F.col("value").alias("m"), *blank,
        F.when(F.col("site").isin("click", "error"), "Ke").otherwise("Sm").alias("kind"))
    path = scratch_path(spark, "catalogue")
    out.write.option("header", True).option("sep", "\t").csv(path)
    return files.read_event_catalogue(spark, path).select(
        secs().alias("t"), "v.m", "v.lat", "v.lng", "v.alt")


@query("a3_row_cap", "SELECT least(count(*), 5000) AS n FROM events")
def a3(spark, sf):
    return files.capped(readings(spark, sf), 5000).agg(F.count(F.lit(1)).alias("n"))


@query("a4_json_payload_import", with_(READINGS) + """
SELECT 'events' AS measurement, site AS name, instance, t, value FROM readings""")
def a4(spark, sf):
    r = readings(spark, sf)
    # Payloads hold a limited number of rows, as an importing client would send them.
    r = with_page(r, ["sensor"], ["ts", "event_id"], 1000)
    row = F.struct(secs().alias("ns"), F.col("value"), F.create_map(
        F.lit("instance"), F.col("labels")["instance"]).alias("series"))
    payload = r.groupBy("measurement", "site", "sensor", "page").agg(F.collect_list(row).alias("data"))
    text = payload.select(F.to_json(F.struct(
        "measurement", F.create_map(F.lit("__name__"), F.col("site"), F.lit("instance"), F.lit("?"))
        .alias("series"), "data")).alias("value"))
    path = scratch_path(spark, "payload")
    text.write.text(path)
    got = files.read_payloads(spark, path, one_per_line=True)
    return got.select("measurement", F.col("labels")["__name__"].alias("name"),
                      F.col("labels")["instance"].alias("instance"), secs().alias("t"),
                      files.numeric_value(F.col("raw")).alias("value"))


@query("a5_wide_record_ingest", with_(READINGS) + """
SELECT sensor, t, value FROM readings UNION ALL SELECT sensor + 1000000, t, value + 1 FROM readings
WHERE alt >= 50""")
def a5(spark, sf):
    r = readings(spark, sf)
    ns = F.create_map(F.lit("ns"), secs().cast("double"), F.col("sensor").cast("string"), F.col("value"))
    more = F.create_map((F.col("sensor") + 1000000).cast("string"), F.col("value") + 1)
    wide = r.select(F.to_json(F.when(F.col("v.alt") >= 50, F.map_concat(ns, more)).otherwise(ns)).alias("json"))
    return files.long_records(wide).select("sensor", secs().alias("t"), "value")


@query("a6_tagged_ingest", with_(READINGS) + """
SELECT event_id, 'node' AS job, CASE WHEN alt < 50 THEN instance ELSE 'localhost' END AS instance, site AS name
FROM readings""")
def a6(spark, sf):
    outer = F.create_map(F.lit("job"), F.lit("node"), F.lit("instance"), F.lit("localhost"))
    own = F.map_filter("labels", lambda k, _: (k != "instance") | (F.col("v.alt") < 50))
    got = readings(spark, sf).withColumn("labels", files.merged_labels(outer, own))
    return got.select("event_id", *[F.col("labels")[k].alias(n) for k, n in
                                    (("job", "job"), ("instance", "instance"), ("__name__", "name"))])


ALERTS = with_(READINGS, """c AS (SELECT t - t % 86400 AS window_start, swimlane AS sensor, value FROM readings),
  m AS (SELECT window_start, sensor, median(value) AS med FROM c GROUP BY ALL),
  d AS (SELECT window_start, sensor, median(abs(value - med)) AS mad FROM c JOIN m USING (window_start, sensor)
    GROUP BY ALL),
  o AS (SELECT window_start, sensor, value, count(*) AS n FROM c JOIN m USING (window_start, sensor)
    JOIN d USING (window_start, sensor)
    WHERE CASE WHEN mad = 0 THEN value <> med ELSE abs(value - med) / (1.4826 * mad) > 3.5 END GROUP BY ALL),
  i AS (SELECT window_start, sensor, count(*) AS items FROM c GROUP BY ALL),
  alerts AS (SELECT window_start, sensor, CAST(0 AS BIGINT) AS page, CAST(sum(n) AS BIGINT) AS outliers, items,
    '{"task":"detect_outliers","seconds":86400,"items":' || items || ',"outliers":' || CAST(sum(n) AS BIGINT) || ',"values":['
    || string_agg('"' || printf('%.2f', value) || '"', ',' ORDER BY value) || ']}' AS message
    FROM o JOIN i USING (window_start, sensor) GROUP BY window_start, sensor, items)""")


def alert_rows(spark, sf):
    r = readings(spark, sf).select(F.col("swimlane").alias("sensor"), "ts", "value")
    return jobs.alert_job(86400).run_batch(r)


@query("a11_alert_records", ALERTS + " SELECT message AS value FROM alerts")
def a11(spark, sf):
    return kafka.to_records(alert_rows(spark, sf))


@query("a12_first_messages", ALERTS + " SELECT least(count(*), 20) AS n FROM alerts")
def a12(spark, sf):
    raw = alert_rows(spark, sf).select(F.lit("alerts").alias("topic"), F.col("message").cast("binary").alias("value"),
                                       F.timestamp_seconds("window_start").alias("timestamp"))
    return kafka.first_messages(kafka.messages(raw), 20).agg(F.count(F.lit(1)).alias("n"))


@query("a13_metric_write_back", with_(READINGS, RISKS) + """
SELECT instance, risk, count(*) AS n, round(max(value), 6) AS top FROM risks GROUP BY ALL""")
def a13(spark, sf):
    path = scratch_path(spark, "metrics")
    tables.append_metrics(risk_series(spark, sf), path)
    back = spark.read.parquet(path)
    return (back.groupBy(F.col("labels")["instance"].alias("instance"), F.col("labels")["risk"].alias("risk"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.max("value"), 6).alias("top")))


@query("a14_text_output", with_(READINGS) + """
SELECT (max(t)) || ',' || alt || ',' || count(*) || ',' || printf('%.2f', max(value)) || ','
  || printf('%.2f', min(value)) AS line FROM readings GROUP BY alt""")
def a14(spark, sf):
    s = aggregate.summary(readings(spark, sf), [F.col("v.alt").alias("alt")], F.col("v.m"))
    return tables.text_rows(s.withColumn("t", secs()), ["t", "alt", "cnt", "max", "min"], 2)


@query("a15_json_output", with_(READINGS, """pg AS (SELECT *,
  (row_number() OVER (PARTITION BY sensor ORDER BY us, value) - 1) // 40 AS page FROM readings)""") + """
SELECT sensor, page, '[' || string_agg('{"ts":' || t || ',"value":' || CAST(value AS VARCHAR) || '}',
  ',' ORDER BY us, value) || ']' AS json FROM pg GROUP BY ALL""")
def a15(spark, sf):
    return tables.json_rows(readings(spark, sf), page_rows=40)


@query("a17_partitioned_layout", with_(READINGS) + """
SELECT site, t // 86400 AS slice, count(*) AS n, round(sum(value), 2) AS total FROM readings
WHERE t >= 1704844800 AND t < 1705708800 AND site IN ('view', 'error') GROUP BY ALL""")
def a17(spark, sf):
    path = scratch_path(spark, "readings")
    tables.write_readings(readings(spark, sf), path, 86400)
    part = select.time_range(spark.read.parquet(path), "2024-01-10", "2024-01-20", slice_seconds=86400)
    return (part.where(F.col("site").isin("view", "error")).groupBy("site", F.col("slice").cast("long").alias("slice"))
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")))


@query("a18_retention", with_(READINGS) + """
SELECT site, count(*) AS n, min(t) AS oldest FROM readings
WHERE us >= (SELECT max(us) FROM readings) - CAST(20 * 86400 AS BIGINT) * 1000000 GROUP BY site""")
def a18(spark, sf):
    return (tables.expire(readings(spark, sf), "20d").groupBy("site")
            .agg(F.count(F.lit(1)).alias("n"), F.min(secs()).alias("oldest")))


@query("a19_read_back_diff", with_(READINGS, """stored AS (SELECT sensor, ts,
  CASE WHEN event_id % 100 = 0 THEN value + 1 ELSE value END AS value FROM readings WHERE event_id % 97 <> 0)""") + """
SELECT CASE WHEN s.sensor IS NULL THEN 'missing' WHEN r.sensor IS NULL THEN 'extra' ELSE 'differs' END AS status,
  count(*) AS n FROM readings r FULL JOIN stored s ON r.sensor = s.sensor AND r.ts = s.ts
WHERE r.value IS DISTINCT FROM s.value GROUP BY ALL""")
def a19(spark, sf):
    r = readings(spark, sf)
    stored = r.where(F.col("event_id") % 97 != 0).withColumn(
        "value", F.when(F.col("event_id") % 100 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return tables.read_back_diff(r, stored).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("a20_source_list", with_(READINGS) + """
SELECT swimlane, sensor, count(*) AS n FROM readings WHERE (swimlane = 'lane1' AND sensor BETWEEN 0 AND 60)
  OR (swimlane = 'lane2' AND sensor BETWEEN 0 AND 99) GROUP BY ALL""")
def a20(spark, sf):
    r = readings(spark, sf)
    parts = [select.sensor_range(select.use(r, lane), 0, top) for lane, top in (("lane1", 60), ("lane2", 99))]
    return select.sources(*parts).groupBy("swimlane", "sensor").agg(F.count(F.lit(1)).alias("n"))


@query("a21_label_dimension", with_(READINGS) + """
SELECT sensor, arg_max(site, ts) AS label FROM readings GROUP BY sensor""")
def a21(spark, sf):
    return tables.latest_labels(readings(spark, sf).withColumn("label", F.col("site")))


@query("a22_cell_positions", with_(READINGS) + f"""
SELECT DISTINCT sensor, {sql_decode("lat", "lng")} FROM readings""")
def a22(spark, sf):
    cells = jobs.grid_readings(readings(spark, sf)).select("sensor", "label").distinct()
    return tables.cell_positions(cells).distinct()


@query("a22_point_positions", with_(READINGS) + """
SELECT DISTINCT sensor, lat AS lat1, lat AS lat2, lng AS lng1, lng AS lng2 FROM readings""")
def a22b(spark, sf):
    return tables.point_positions(readings(spark, sf).select("sensor", "v.lat", "v.lng"))
