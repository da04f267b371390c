"""Projections, filters, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (HEALTH, POSITIONS, READINGS, RISKS, SENSORS, health, positions, query, readings,
                          risk_series, secs, sensors, with_)
from catalog.sqlgeo import sql_decode
from gaugeworks.operators import aggregate, lookup, select
from gaugeworks.operators.series import number_series
from gaugeworks.plans import jobs, risk
from gaugeworks.sources import tables


def n(df, *by):
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


@query("b1_select_sensor", with_(READINGS) + " SELECT sensor, us, value FROM readings WHERE sensor = 7")
def b1(spark, sf):
    return select.sensor(readings(spark, sf), 7).select("sensor", F.unix_micros("ts").alias("us"), "value")


@query("b2_select_sensor_range", with_(READINGS) + """
SELECT sensor, us, value FROM readings WHERE sensor BETWEEN 0 AND 20""")
def b2(spark, sf):
    return select.sensor_range(readings(spark, sf), 0, 20).select("sensor", F.unix_micros("ts").alias("us"), "value")


@query("b3_select_all", with_(READINGS) + " SELECT sensor, us, value FROM readings")
def b3(spark, sf):
    return readings(spark, sf).select("sensor", F.unix_micros("ts").alias("us"), "value")


@query("b4_use_container", with_(READINGS) + """
SELECT sensor, count(*) AS n FROM readings WHERE swimlane = 'lane3' GROUP BY sensor""")
def b4(spark, sf):
    return n(select.use(readings(spark, sf), "lane3"), "sensor")


@query("b5_nested_field", with_(READINGS) + " SELECT event_id, alt, value AS m FROM readings")
def b5(spark, sf):
    return readings(spark, sf).select("event_id", F.col("v.alt").alias("alt"), F.col("v")["m"].alias("m"))


@query("b6_alias", with_(READINGS) + " SELECT event_id, value AS w FROM readings")
def b6(spark, sf):
    return readings(spark, sf).select("event_id", F.col("value").alias("w"))


@query("b7_computed_column", with_(READINGS) + """
SELECT event_id, round(value * 2 + alt, 4) AS area FROM readings""")
def b7(spark, sf):
    return select.computed(readings(spark, sf), ["event_id"],
                           area=F.round(F.col("value") * 2 + F.col("v.alt"), 4))


@query("b8_merge_series", with_(READINGS) + " SELECT 'area' AS series, us, value FROM readings")
def b8(spark, sf):
    return select.merge_series(readings(spark, sf)).select("series", F.unix_micros("ts").alias("us"), "value")


PAGED = """pg AS (SELECT *, (row_number() OVER (PARTITION BY sensor ORDER BY us, event_id) - 1) // 40 AS page
  FROM readings)"""


def paged_points(spark, sf):
    return select.point_lists(readings(spark, sf), ["sensor"], ["ts", "event_id"], page_rows=40)


@query("b9_values_of", with_(READINGS, PAGED) + """
SELECT sensor, page, string_agg(CAST(value AS VARCHAR), ',' ORDER BY us, event_id) AS vals FROM pg GROUP BY ALL""")
def b9(spark, sf):
    return paged_points(spark, sf).select(
        "sensor", "page", F.array_join(select.values_of("points").cast("array<string>"), ",").alias("vals"))


@query("b10_datapoints", with_(READINGS) + " SELECT sensor, us, event_id, value FROM readings")
def b10(spark, sf):
    return select.datapoints(paged_points(spark, sf), "points", ["sensor"]).select(
        "sensor", F.unix_micros("ts").alias("us"), "event_id", "value")


@query("b11_map_series", with_(READINGS) + """
SELECT sensor, round(max(value) - min(value), 4) AS spread FROM readings GROUP BY sensor""")
def b11(spark, sf):
    return select.per_series(readings(spark, sf), lambda df: df.groupBy("sensor").agg(
        F.round(F.max("value") - F.min("value"), 4).alias("spread")))


@query("b12_row_map", with_(READINGS, HEALTH) + " SELECT instance, type, t, value FROM health")
def b12(spark, sf):
    return health(spark, sf).select("instance", "type", secs().alias("t"), "value")


@query("b14_sensor_positions", with_(READINGS, POSITIONS) + """
SELECT DISTINCT r.sensor, p.lat AS lat1, p.lng AS lng1 FROM readings r JOIN positions p ON r.sensor = p.sensor""")
def b14(spark, sf):
    used = readings(spark, sf).select("sensor").distinct()
    return (lookup.with_position(used, positions(spark, sf), "inner").select("sensor", "lat1", "lng1")
            .orderBy("sensor"))


@query("b15_sensor_labels", with_(READINGS, SENSORS) + """
SELECT DISTINCT r.sensor, s.label FROM readings r JOIN sensors s ON r.sensor = s.sensor
WHERE r.swimlane = 'lane4'""")
def b15(spark, sf):
    used = select.use(readings(spark, sf), "lane4").select("sensor").distinct()
    return lookup.with_label(used, sensors(spark, sf)).where("label is not null")


@query("b16_containers", with_(READINGS) + " SELECT DISTINCT swimlane FROM readings")
def b16(spark, sf):
    return select.containers(readings(spark, sf))


@query("c1_time_range", with_(READINGS) + """
SELECT site, count(*) AS n FROM readings WHERE ts >= '2024-01-05' AND ts < '2024-01-12' GROUP BY site""")
def c1(spark, sf):
    return n(select.time_range(readings(spark, sf), "2024-01-05T00:00:00+00:00", "2024-01-12T00:00:00+00:00"), "site")


@query("c2_recent", with_(READINGS) + """
SELECT event_id, us FROM readings WHERE us >= (SELECT max(us) FROM readings) - CAST(24 * 3600 AS BIGINT) * 1000000""")
def c2(spark, sf):
    return select.recent(readings(spark, sf), "24H").select("event_id", F.unix_micros("ts").alias("us"))


@query("c3_min_records", with_(READINGS) + """
SELECT sensor, us, value FROM readings WHERE sensor IN
  (SELECT sensor FROM readings GROUP BY sensor HAVING count(*) > 65)""")
def c3(spark, sf):
    return select.min_records(readings(spark, sf), ["sensor"], 65).select(
        "sensor", F.unix_micros("ts").alias("us"), "value")


BOX = [40.0, 0.0, 60.0, 30.0]
IN_BOX = "lat BETWEEN 40 AND 60 AND lng BETWEEN 0 AND 30"


@query("c4_geo_box", with_(READINGS) + f" SELECT event_id, sensor, value FROM readings WHERE {IN_BOX}")
def c4(spark, sf):
    return lookup.geo_box(readings(spark, sf), positions(spark, sf), BOX).select("event_id", "sensor", "value")


@query("c5_geo_box_cells", with_(READINGS, f"""cells AS (SELECT *, {sql_decode("lat", "lng")} FROM readings)""") + """
SELECT sensor, count(*) AS n FROM cells WHERE lat1 <= 60.3 AND lat2 >= 30.5 AND lng1 <= 45.4 AND lng2 >= 0.2
GROUP BY sensor""")
def c5(spark, sf):
    r = readings(spark, sf)
    cells = tables.cell_positions(jobs.grid_readings(r).select("sensor", "label").distinct())
    # The altitude part of a label makes several cells per sensor, all with the same outline.
    return n(lookup.geo_box_cells(r, cells.distinct(), [30.5, 0.2, 60.3, 45.4]), "sensor")


# Boxes of our own, each around the one before, latitude first.
SWEEP = [[45.0 - 1.7 * i, 10.0 - 2.6 * i, 46.0 + 2.1 * i, 11.5 + 2.9 * i] for i in range(14)]
SWEEP_SQL = "boxes(box, a, b, c, d) AS (VALUES " + ", ".join(
    f"({i}, {', '.join(f'CAST({x!r} AS DOUBLE)' for x in b)})" for i, b in enumerate(SWEEP)) + ")"


@query("c6_box_sweep", with_(READINGS, SWEEP_SQL) + """
SELECT box, us, round(sum(value), 2) AS value FROM readings JOIN boxes ON lat BETWEEN a AND c AND lng BETWEEN b AND d
GROUP BY box, us""")
def c6(spark, sf):
    boxes = lookup.box_table(spark, SWEEP)
    swept = lookup.box_sweep(readings(spark, sf), positions(spark, sf), boxes)
    return swept.select("box", F.unix_micros("ts").alias("us"), F.round("value", 2).alias("value"))


@query("jn5_boxes_of_sensors", with_(POSITIONS, SWEEP_SQL) + """
SELECT box, sensor FROM positions JOIN boxes ON lat BETWEEN a AND c AND lng BETWEEN b AND d""")
def jn5(spark, sf):
    return lookup.boxes_of_sensors(positions(spark, sf), lookup.box_table(spark, SWEEP))


FROM_MS, TO_MS = 1704499200000, 1705708800000
MATCHED = "SELECT event_id FROM readings WHERE us BETWEEN 1704499200000000 AND 1705708800000000 AND "


def matched(*matchers):
    def run(spark, sf):
        return select.select_metrics(readings(spark, sf), FROM_MS, TO_MS,
                                     [select.Matcher(*m) for m in matchers]).select("event_id")
    return run


query("c7_match_eq", with_(READINGS) + MATCHED + "site = 'click'")(matched(("__name__", "click", "EQ")))
query("c7_match_neq", with_(READINGS) + MATCHED + "site <> 'click'")(matched(("__name__", "click", "NEQ")))
query("c7_match_re", with_(READINGS) + MATCHED + "regexp_full_match(instance, 'u1[0-9]')")(
    matched(("instance", "u1[0-9]", "RE")))
query("c7_match_nre", with_(READINGS) + MATCHED + "NOT regexp_full_match(site, 'c.*|v.*') AND site = site")(
    matched(("__name__", "c.*|v.*", "NRE"), ("absent", "", "EQ")))


@query("c8_having_label", with_(READINGS, PAGED.replace("FROM readings", "FROM readings WHERE alt < 50")) + """
SELECT instance, page, string_agg(CAST(value AS VARCHAR), ',' ORDER BY us, event_id) AS vals FROM pg GROUP BY ALL""")
def c8(spark, sf):
    r = readings(spark, sf)
    some = r.withColumn("labels", F.when(F.col("v.alt") < 50, F.col("labels")).otherwise(
        F.map_filter("labels", lambda k, _: k != "instance")))
    named = select.having_label(some, "instance").withColumn("instance", F.col("labels")["instance"])
    points = select.point_lists(named, ["instance"], ["ts", "event_id"], page_rows=40)
    return points.select("instance", "page",
                         F.array_join(select.values_of("points").cast("array<string>"), ",").alias("vals"))


@query("c9_filter_map", with_(READINGS, RISKS) + " SELECT instance, risk, t, value FROM risks WHERE whn = 'now'")
def c9(spark, sf):
    return risk.current_risks(risk_series(spark, sf)).select("instance", "risk", secs().alias("t"), "value")


@query("c10_find_sensor", with_(SENSORS) + " SELECT sensor FROM sensors WHERE label LIKE '%.Customer#000000011'")
def c10(spark, sf):
    s = sensors(spark, sf)
    wanted = s.where(F.col("label").endswith(".Customer#000000011")).select("label").scalar()
    return s.where(F.col("label") == wanted).select("sensor")


GATE = """w AS (SELECT t - t % 86400 AS window_start, instance, type, count(*) AS c FROM health GROUP BY ALL)"""


@query("c11_evidence_gate", with_(READINGS, HEALTH, GATE) + """
SELECT window_start, instance, min(c) AS min_n FROM w GROUP BY ALL HAVING count(*) = 4""")
def c11(spark, sf):
    w = risk.in_windows(health(spark, sf), 86400, 86400)
    return aggregate.shortest_list(w, ["window_start", "instance"], "type").where("types = 4").drop("types")


PEAKS = """peaks AS (SELECT t - t % 86400 AS window_start, instance,
    max(CASE WHEN risk = 'ddos' THEN value END) AS ddos, max(CASE WHEN risk = 'overload' THEN value END) AS overload
  FROM risks WHERE whn = 'now' GROUP BY ALL)"""


def peaks(spark, sf):
    return risk.peak_risks(risk.current_risks(risk_series(spark, sf)), 86400)


@query("c12_drop_incomplete", with_(READINGS, RISKS, PEAKS) + """
SELECT window_start, count(*) AS n FROM peaks WHERE ddos IS NOT NULL AND overload IS NOT NULL GROUP BY ALL""")
def c12(spark, sf):
    return n(peaks(spark, sf), "window_start")


@query("c13_group_filter", with_(READINGS) + """
SELECT alt, count(*) AS cnt, max(value) AS max, min(value) AS min FROM readings GROUP BY alt HAVING count(*) > 0""")
def c13(spark, sf):
    r = readings(spark, sf)
    return (aggregate.summary(r, [F.col("v.alt").alias("alt")], F.col("v.m")).where("cnt > 0")
            .select("alt", "cnt", "max", "min").orderBy("alt"))


@query("c14_large_containers", with_(READINGS) + """
SELECT swimlane, count(DISTINCT sensor) AS sensors FROM readings GROUP BY ALL HAVING count(DISTINCT sensor) >= 2""")
def c14(spark, sf):
    return select.large_containers(readings(spark, sf), 2)


@query("c15_containers_of_tags", with_(READINGS) + " SELECT DISTINCT swimlane FROM readings WHERE site = 'purchase'")
def c15(spark, sf):
    return select.containers_of_tags(readings(spark, sf), __name__="purchase")


@query("g1_order_by_alt", with_(READINGS) + """
SELECT alt, event_id FROM readings ORDER BY alt, event_id""")
def g1(spark, sf):
    return readings(spark, sf).select("v.alt", "event_id").orderBy("alt", "event_id")


LANES = "lanes AS (SELECT swimlane, count(DISTINCT sensor) AS sensors FROM readings GROUP BY swimlane)"


@query("g2_top_container", with_(READINGS, LANES) + " SELECT * FROM lanes ORDER BY sensors DESC, swimlane DESC LIMIT 1")
def g2(spark, sf):
    return select.top_containers(readings(spark, sf), 1)


@query("g3_top5_recent_count", with_(READINGS, LANES, """
top AS (SELECT swimlane FROM lanes ORDER BY sensors DESC, swimlane DESC LIMIT 5)""") + """
SELECT swimlane, sensor, count(*) AS cnt FROM readings WHERE swimlane IN (SELECT swimlane FROM top)
  AND us >= (SELECT max(us) FROM readings) - CAST(48 * 3600 AS BIGINT) * 1000000 GROUP BY ALL""")
def g3(spark, sf):
    r = readings(spark, sf)
    late = select.recent(r, "48H").join(select.top_containers(r, 5).select("swimlane"), "swimlane", "left_semi")
    return late.groupBy("swimlane", "sensor").agg(F.count(F.lit(1)).alias("cnt"))


@query("g4_sensors_by_records", with_(READINGS) + """
SELECT sensor, count(*) AS cnt FROM readings GROUP BY sensor ORDER BY cnt DESC, sensor""")
def g4(spark, sf):
    return aggregate.count_by_sensor(readings(spark, sf)).orderBy(F.desc("cnt"), "sensor")


@query("g6_first_n", "SELECT least(count(*), 1000) AS n FROM events")
def g6(spark, sf):
    from gaugeworks.sources.kafka import first_messages
    return first_messages(readings(spark, sf), 1000).agg(F.count(F.lit(1)).alias("n"))


@query("h1_union_sources", with_(READINGS) + """
SELECT site, count(*) AS n FROM readings WHERE site IN ('click', 'view', 'error', 'purchase') GROUP BY site""")
def h1(spark, sf):
    r = readings(spark, sf)
    return n(select.sources(*[r.where(F.col("site") == s) for s in ("click", "view", "error", "purchase")]), "site")


@query("h2_set_equality", with_(READINGS) + """
SELECT 'left' AS side, count(*) AS n FROM readings WHERE event_id % 50 = 0 UNION ALL
SELECT 'right', count(*) FROM readings WHERE event_id % 50 = 0""")
def h2(spark, sf):
    r = readings(spark, sf).select("event_id", "sensor", "value")
    other = r.withColumn("value", F.when(F.col("event_id") % 50 == 0, -F.col("value")).otherwise(F.col("value")))
    return n(tables.set_difference(r, other), "side")


@query("f4_sensor_numbering", with_(READINGS) + """
SELECT label, first_us, row_number() OVER (ORDER BY first_us, label) - 1 AS sensor FROM
  (SELECT instance AS label, min(us) AS first_us FROM readings GROUP BY instance)""")
def f4(spark, sf):
    named = readings(spark, sf).withColumn("label", F.col("labels")["instance"])
    return number_series(named, "label", "ts").select("label", F.unix_micros("first_seen").alias("first_us"), "sensor")
