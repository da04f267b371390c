"""Joins, aggregates, window operators and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (CPT_SQL, HEALTH, POSITIONS, READINGS, RISKS, SENSORS, STATE, cpt, health, positions,
                          query, readings, risk_series, secs, sensors, with_)
from catalog.selecting import BOX, GATE, IN_BOX, LANES, PAGED, PEAKS, n, paged_points, peaks
from catalog.sqlgeo import sql_decode, sql_geohash, sql_tile_x, sql_tile_y
from gaugeworks.functions import geo, scalars
from gaugeworks.operators import aggregate, arma, lookup, resample, select, series
from gaugeworks.plans import jobs, risk
from gaugeworks.session import scratch_path
from gaugeworks.sources import layout

DAY = 86400
ORDER = ["ts", "event_id"]


@query("jn1_label_lookup", with_(READINGS, SENSORS) + """
SELECT label, count(*) AS n FROM readings r LEFT JOIN sensors s ON r.sensor = s.sensor GROUP BY label""")
def jn1(spark, sf):
    return n(lookup.with_label(readings(spark, sf), sensors(spark, sf)), "label")


@query("jn2_position_lookup", with_(READINGS, POSITIONS) + """
SELECT event_id, p.lat AS lat1, p.lng AS lng1 FROM readings r LEFT JOIN positions p ON r.sensor = p.sensor""")
def jn2(spark, sf):
    return lookup.with_position(readings(spark, sf), positions(spark, sf)).select("event_id", "lat1", "lng1")


@query("jn3_align_metrics", with_(READINGS, HEALTH) + """
SELECT t - t % 86400 AS window_start, instance, round(avg(CASE WHEN type = 'ping' THEN value END), 9) AS ping,
  round(avg(CASE WHEN type = 'cpu' THEN value END), 9) AS cpu,
  round(avg(CASE WHEN type = 'mem' THEN value END), 9) AS mem,
  round(avg(CASE WHEN type = 'reject' THEN value END), 9) AS reject FROM health GROUP BY ALL""")
def jn3(spark, sf):
    h = health(spark, sf)
    streams = select.sources(*[h.where(F.col("type") == t) for t in ("ping", "cpu", "mem", "reject")])
    out = (risk.in_windows(streams, DAY, DAY).groupBy("window_start", "instance")
           .pivot("type", ["ping", "cpu", "mem", "reject"]).agg(F.avg("value")))
    return out.select("window_start", "instance", *[F.round(c, 9).alias(c) for c in ("ping", "cpu", "mem", "reject")])


@query("jn4_table_lookup", with_(READINGS, HEALTH, CPT_SQL) + f"""
SELECT type, a, b, CAST(state AS INTEGER) AS state, count(*) AS n, round(max(p), 9) AS p FROM
  (SELECT type, {STATE} AS state FROM health) h JOIN lk ON s = state AND node =
  CASE type WHEN 'ping' THEN 1 WHEN 'cpu' THEN 2 WHEN 'mem' THEN 3 ELSE 4 END GROUP BY ALL""")
def jn4(spark, sf):
    h = health(spark, sf)
    node = F.lit(None).cast("int")
    for kind, no in scalars.STATE_NODE.items():
        node = F.when(F.col("type") == kind, no).otherwise(node)
    seen = (h.select("type", node.alias("node"), scalars.health_state(F.col("type"), F.col("value")).alias("state"))
            .groupBy("type", "node", "state").agg(F.count(F.lit(1)).alias("n")))
    return seen.join(cpt(spark), ["node", "state"]).select(
        "type", F.col("parents")[0].alias("a"), F.col("parents")[1].alias("b"), "state", "n",
        F.round("p", 9).alias("p"))


@query("jn7_fallback_key", with_(READINGS, SENSORS) + """
SELECT CASE WHEN alt < 50 THEN r.instance ELSE label END AS instance, count(*) AS n
FROM readings r LEFT JOIN sensors s ON r.sensor = s.sensor GROUP BY ALL""")
def jn7(spark, sf):
    some = readings(spark, sf).withColumn("labels", F.when(F.col("v.alt") < 50, F.col("labels")).otherwise(
        F.map_filter("labels", lambda k, _: k != "instance")))
    return n(lookup.with_series_key(some, sensors(spark, sf)), "instance")


@query("e1_count_sensor", with_(READINGS) + " SELECT sensor, count(*) AS cnt FROM readings WHERE sensor = 7 GROUP BY ALL")
def e1(spark, sf):
    return aggregate.count_by_sensor(select.sensor(readings(spark, sf), 7))


@query("e2_geo_count", with_(READINGS) + f"""
SELECT sensor, count(*) AS cnt FROM readings WHERE {IN_BOX} GROUP BY sensor""")
def e2(spark, sf):
    return aggregate.count_by_sensor(lookup.geo_box(readings(spark, sf), positions(spark, sf), BOX))


@query("e3_recent_count", with_(READINGS) + """
SELECT sensor, count(*) AS cnt FROM readings WHERE us >= (SELECT max(us) FROM readings) - CAST(7200 AS BIGINT) * 1000000
GROUP BY sensor""")
def e3(spark, sf):
    return aggregate.count_by_sensor(select.recent(readings(spark, sf), "2H"))


@query("e4_summary_with_empty", with_(READINGS) + """
SELECT alt, count(m) AS cnt, max(m) AS max, min(m) AS min, round(avg(m), 6) AS avg FROM
  (SELECT alt, CASE WHEN alt % 10 <> 3 THEN value END AS m FROM readings) GROUP BY alt""")
def e4(spark, sf):
    m = F.when(F.col("v.alt") % 10 != 3, F.col("v.m"))
    out = aggregate.summary(readings(spark, sf), [F.col("v.alt").alias("alt")], m)
    return out.select("alt", "cnt", "max", "min", F.round("avg", 6).alias("avg"))


@query("e5_group_by_alt", with_(READINGS) + """
SELECT alt, count(*) AS cnt, max(value) AS max, min(value) AS min, round(avg(value), 6) AS avg, max(t) AS t
FROM readings GROUP BY alt""")
def e5(spark, sf):
    out = aggregate.summary(readings(spark, sf), [F.col("v.alt").alias("alt")], F.col("v.m"))
    return out.select("alt", "cnt", "max", "min", F.round("avg", 6).alias("avg"), secs().alias("t"))


@query("e6_group_by_rounded", with_(READINGS) + """
SELECT CAST(round(alt / 10.0, 0) AS BIGINT) AS alt, count(*) AS cnt, max(value) AS max FROM readings GROUP BY ALL""")
def e6(spark, sf):
    key = F.round(F.col("v.alt") / 10.0).cast("long").alias("alt")
    return aggregate.summary(readings(spark, sf), [key], F.col("v.m")).select("alt", "cnt", "max")


@query("e7_geo_sum_by_time", with_(READINGS) + f"""
SELECT us, round(sum(value), 2) AS value FROM readings WHERE {IN_BOX} GROUP BY us""")
def e7(spark, sf):
    out = aggregate.sum_by_time(lookup.geo_box(readings(spark, sf), positions(spark, sf), BOX))
    return out.select(F.unix_micros("ts").alias("us"), F.round("value", 2).alias("value"))


def resample_sql(total: str, digits: int = 3) -> str:
    return with_(READINGS, f"""b AS (SELECT sensor, t - t % 86400 AS bucket, {total} AS s FROM readings GROUP BY ALL),
  span AS (SELECT sensor, unnest(range(min(bucket), max(bucket) + 1, 86400)) AS bucket FROM b GROUP BY sensor),
  f AS (SELECT sensor, bucket, CAST(coalesce(s, 0) AS DOUBLE) AS total FROM span LEFT JOIN b USING (sensor, bucket))""") + f"""
SELECT sensor, bucket, round(total, 2) AS total, round(avg(total) OVER (PARTITION BY sensor ORDER BY bucket
  ROWS UNBOUNDED PRECEDING), {digits}) AS value FROM f"""


@query("e8_resample_counts", resample_sql("count(*)"))
def e8(spark, sf):
    return resample.resample(readings(spark, sf), ["sensor"], DAY)


@query("e9_resample_sums", resample_sql("sum(value)", 6))
def e9(spark, sf):
    out = resample.resample(readings(spark, sf), ["sensor"], DAY, F.col("v.m"), digits=6)
    return out.withColumn("total", F.round("total", 2))


@query("e9_general_fold", resample_sql("count(*)").replace("round(total, 2) AS total, ", ""))
def e9b(spark, sf):
    totals = resample.bucket_totals(readings(spark, sf), ["sensor"], DAY)
    return resample.fold_buckets(
        totals, ["sensor"], F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("d")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), (acc["d"] + 1).alias("d")),
        lambda acc: F.round(acc["s"] / acc["d"], 3))


@query("e10_values_by_type", with_(READINGS, HEALTH) + """
SELECT t - t % 86400 AS window_start, instance, type, string_agg(printf('%.5f', value), ',' ORDER BY us, value) AS vals
FROM health GROUP BY ALL""")
def e10(spark, sf):
    w = risk.in_windows(health(spark, sf), DAY, DAY)
    maps = aggregate.values_by_type(w, ["window_start", "instance"], "type", ["ts", "value"], "value")
    return maps.select("window_start", "instance", F.explode("series").alias("type", "_v")).select(
        "window_start", "instance", "type", F.array_join(F.transform("_v", lambda x: F.format_string("%.5f", x)), ",").alias("vals"))


@query("e11_shortest_list", with_(READINGS, HEALTH, GATE) + """
SELECT window_start, instance, min(c) AS min_n, count(*) AS types FROM w GROUP BY ALL""")
def e11(spark, sf):
    w = risk.in_windows(health(spark, sf), DAY, DAY)
    return aggregate.shortest_list(w, ["window_start", "instance"], "type")


LATEST = f"""x AS (SELECT t - t % 86400 AS window_start, * FROM health),
  l AS (SELECT *, row_number() OVER (PARTITION BY window_start, instance, type ORDER BY us DESC, value DESC) AS k FROM x),
  st AS (SELECT window_start, instance, type, CAST(round(avg({STATE}), 0) AS INTEGER) AS state FROM l WHERE k <= 5
    GROUP BY ALL)"""


@query("e12_latest_state", with_(READINGS, HEALTH, LATEST) + " SELECT * FROM st")
def e12(spark, sf):
    return risk.latest_states(risk.in_windows(health(spark, sf), DAY, DAY), ["window_start", "instance"])


@query("e13_peak_risk", with_(READINGS, RISKS, PEAKS) + """
SELECT window_start, instance, ddos, overload FROM peaks WHERE ddos IS NOT NULL AND overload IS NOT NULL""")
def e13(spark, sf):
    return peaks(spark, sf)


CLASSED = """classed AS (SELECT *, CASE WHEN ddos < 0.3 AND overload < 0.3 THEN 'safe' WHEN ddos < 0.3 THEN 'overloaded'
  WHEN overload < 0.3 THEN 'ddos' ELSE 'both' END AS cls FROM peaks WHERE ddos IS NOT NULL AND overload IS NOT NULL)"""


@query("e14_risk_classes", with_(READINGS, RISKS, PEAKS, CLASSED) + """
SELECT window_start, count(*) AS n_total, count(*) FILTER (cls = 'overloaded') AS n_overloaded,
  count(*) FILTER (cls = 'ddos') AS n_ddos, count(*) FILTER (cls = 'both') AS n_both
FROM classed GROUP BY window_start""")
def e14(spark, sf):
    return risk.class_counts(peaks(spark, sf))


@query("e14_risk_members", with_(READINGS, RISKS, PEAKS, CLASSED) + """
SELECT window_start, CAST(0 AS BIGINT) AS page, coalesce(string_agg(instance, ',' ORDER BY instance) FILTER (cls = 'both'), '') AS both,
  coalesce(string_agg(instance, ',' ORDER BY instance) FILTER (cls = 'ddos'), '') AS ddos,
  coalesce(string_agg(instance, ',' ORDER BY instance) FILTER (cls = 'overloaded'), '') AS overloaded
FROM classed WHERE cls <> 'safe' GROUP BY window_start""")
def e14b(spark, sf):
    return risk.class_members(peaks(spark, sf)).select(
        "window_start", "page", *[F.array_join(f"{c}_members", ",").alias(c) for c in ("both", "ddos", "overloaded")])


BROAD = """broad AS (SELECT window_start, count(*) AS n_total, count(*) FILTER (cls <> 'safe') AS n_threat,
    count(*) FILTER (cls IN ('ddos', 'both')) AS n_ddos FROM classed GROUP BY window_start),
  status AS (SELECT *, CASE WHEN n_threat = 0 THEN 0.0 ELSE n_ddos / n_total END AS attack_broadness FROM broad)"""


@query("e15_attack_broadness", with_(READINGS, RISKS, PEAKS, CLASSED, BROAD) + """
SELECT window_start, n_total, n_threat, n_ddos, round(attack_broadness, 9) AS attack_broadness FROM status""")
def e15(spark, sf):
    return risk.broadness(peaks(spark, sf)).withColumn("attack_broadness", F.round("attack_broadness", 9))


@query("e17_container_profile", with_(READINGS) + """
SELECT swimlane, count(*) AS records, count(DISTINCT sensor) AS sensors FROM readings GROUP BY swimlane""")
def e17(spark, sf):
    return aggregate.profile_containers(readings(spark, sf))


@query("e17_sensor_profile", with_(READINGS) + """
SELECT swimlane, sensor, count(*) AS records FROM readings GROUP BY ALL""")
def e17b(spark, sf):
    return aggregate.profile_sensors(readings(spark, sf))


@query("e18_grand_totals", with_(READINGS, LANES) + """
SELECT count(*) AS containers, CAST(sum(sensors) AS BIGINT) AS sensors, (SELECT count(*) FROM readings) AS records
FROM lanes""")
def e18(spark, sf):
    return aggregate.grand_totals(readings(spark, sf))


W = "OVER (PARTITION BY sensor ORDER BY us, event_id)"


@query("f1_difference", with_(READINGS) + f"""
SELECT sensor, event_id, round(value - lag(value) {W}, 4) AS diff FROM readings""")
def f1(spark, sf):
    out = series.difference(readings(spark, sf), ["sensor"], ORDER, "value")
    return out.select("sensor", "event_id", F.round("diff", 4).alias("diff"))


@query("f1_undo_difference", with_(READINGS, f"d AS (SELECT *, value - lag(value) {W} AS diff FROM readings)") + f"""
SELECT sensor, event_id, round(sum(diff) {W}, 4) AS level FROM d WHERE diff IS NOT NULL""")
def f1b(spark, sf):
    diff = series.difference(readings(spark, sf), ["sensor"], ORDER, "value").where("diff is not null")
    out = series.undo_difference(diff, ["sensor"], ORDER, "diff", F.lit(0.0))
    return out.select("sensor", "event_id", F.round("level", 4).alias("level"))


@query("f2_last_five", with_(READINGS) + f"""
SELECT sensor, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY us DESC, event_id DESC)
  AS k FROM readings) WHERE k <= 5""")
def f2(spark, sf):
    return series.last_points(readings(spark, sf), ["sensor"], ORDER, 5).select("sensor", "event_id", "value")


@query("f3_running_totals", with_(READINGS) + f"""
SELECT sensor, event_id, count(*) {W} AS running_count, round(sum(value) {W}, 2) AS running_sum FROM readings""")
def f3(spark, sf):
    out = series.with_running(readings(spark, sf), ["sensor"], ORDER, "value")
    return out.select("sensor", "event_id", "running_count", F.round("running_sum", 2).alias("running_sum"))


@query("f5_time_index", with_(READINGS) + f"""
SELECT sensor, event_id, row_number() {W} AS idx FROM readings UNION ALL
SELECT sensor, NULL, unnest(range(count(*) + 1, count(*) + 4)) FROM readings GROUP BY sensor""")
def f5(spark, sf):
    r = readings(spark, sf)
    seen = series.with_running(r, ["sensor"], ORDER).select("sensor", "event_id", F.col("running_count").alias("idx"))
    size = r.groupBy("sensor").agg(F.count(F.lit(1)).alias("_n"))
    ahead = size.select("sensor", F.lit(None).cast("long").alias("event_id"),
                        F.explode(F.sequence(F.col("_n") + 1, F.col("_n") + 3)).alias("idx"))
    return seen.unionByName(ahead)


@query("i1_geohash", with_(READINGS) + f"""
SELECT sensor, {sql_geohash("lat", "lng")} AS hash, count(*) AS n FROM readings GROUP BY ALL""")
def i1(spark, sf):
    r = readings(spark, sf).select("sensor", "v.lat", "v.lng")
    return n(r, "sensor", geo.geohash_encode(F.col("lat"), F.col("lng")).alias("hash"))


@query("i2_geohash_decode", with_(POSITIONS) + f" SELECT sensor, {sql_decode('lat', 'lng')} FROM positions")
def i2(spark, sf):
    p = positions(spark, sf)
    box = geo.geohash_decode(geo.geohash_encode(F.col("lat1"), F.col("lng1")))
    return p.select("sensor", box.alias("b")).select("sensor", "b.*")


@query("i3_altitude_bucket", with_(READINGS) + """
SELECT event_id, CAST(round(alt + value / 100, 0) AS BIGINT) // 35 * 35 AS bucket FROM readings""")
def i3(spark, sf):
    return readings(spark, sf).select("event_id", geo.altitude_bucket(
        F.col("v.alt") + F.col("value") / 100).cast("long").alias("bucket"))


@query("i4_cell_label", with_(READINGS) + f"""
SELECT event_id, 'C' || {sql_geohash("lat", "lng")} || 'Z' || (alt // 35 * 35) AS label,
  {sql_geohash("lat", "lng")} AS hash, alt // 35 * 35 AS alt FROM readings""")
def i4(spark, sf):
    label = geo.cell_label(F.col("v.lat"), F.col("v.lng"), F.col("v.alt"))
    out = readings(spark, sf).select("event_id", label.alias("label"))
    return out.withColumn("_p", geo.parse_cell_label(F.col("label"))).select("event_id", "label", "_p.hash", "_p.alt")


@query("i5_routing_key", with_(READINGS) + " SELECT 'owner_' || site AS swimlane, count(*) AS n FROM readings GROUP BY ALL")
def i5(spark, sf):
    return n(readings(spark, sf), scalars.routing_key(F.lit("owner"), F.col("site")).alias("swimlane"))


@query("i6_polygon_ring", with_(POSITIONS, f"b AS (SELECT sensor, {sql_decode('lat', 'lng')} FROM positions)") + """
SELECT sensor, '[[' || lng1 || ',' || lat1 || '],[' || lng2 || ',' || lat1 || '],[' || lng2 || ',' || lat2 || '],['
  || lng1 || ',' || lat2 || '],[' || lng1 || ',' || lat1 || ']]' AS ring FROM b""")
def i6(spark, sf):
    p = positions(spark, sf)
    box = p.select("sensor", geo.geohash_decode(geo.geohash_encode(F.col("lat1"), F.col("lng1"))).alias("b"))
    ring = geo.polygon_ring(*[F.col(f"b.{c}") for c in ("lat1", "lat2", "lng1", "lng2")])
    return box.select("sensor", F.to_json(ring).alias("ring"))


@query("i7_country_label", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n_name ELSE n_name || '.' || c_name END
  AS label FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def i7(spark, sf):
    s = sensors(spark, sf).withColumn("_p", F.split("label", "\\."))
    province = F.when(F.col("sensor") % 3 == 0, F.lit("  ")).otherwise(F.col("_p")[1])
    return s.select(F.col("sensor").alias("c_custkey"), scalars.country_label(F.col("_p")[0], province).alias("label"))


@query("i8_discretise", with_(READINGS, HEALTH) + f"""
SELECT type, CAST({STATE} AS INTEGER) AS state, count(*) AS n FROM health GROUP BY ALL""")
def i8(spark, sf):
    h = health(spark, sf)
    return n(h, "type", scalars.health_state(F.col("type"), F.col("value")).alias("state"))


@query("i9_message", with_(READINGS) + """
SELECT event_id, printf('Sensor %d at %s: %.2f', sensor, site, value) AS message FROM readings""")
def i9(spark, sf):
    return readings(spark, sf).select("event_id", F.format_string(
        "Sensor %d at %s: %.2f", "sensor", "site", "value").alias("message"))


@query("i10_rounding", with_(READINGS) + """
SELECT event_id, round((value + 0.003) / 7, 3) AS r3, round((value + 0.003) / 7, 2) AS r2, round((value + 0.003) / 7, 1) AS r1 FROM readings""")
def i10(spark, sf):
    x = (F.col("value") + 0.003) / 7
    return readings(spark, sf).select("event_id", *[F.round(x, d).alias(f"r{d}") for d in (3, 2, 1)])


@query("i11_time_units", with_(READINGS) + """
SELECT event_id, t AS s, us // 1000 AS ms, us * 1000 AS ns, us AS back, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso
FROM readings""")
def i11(spark, sf):
    us = F.unix_micros("ts")
    back = scalars.from_epoch(us * 1000, "ns")
    return readings(spark, sf).select(
        "event_id", scalars.epoch_seconds(F.col("ts")).alias("s"), scalars.epoch_millis(F.col("ts")).alias("ms"),
        (us * 1000).alias("ns"), F.unix_micros(back).alias("back"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


LISTS = "SELECT sensor, page, list(value ORDER BY us, event_id) AS v FROM pg GROUP BY ALL"


@query("i12_lists", with_(READINGS, PAGED, f"d AS ({LISTS})") + """
SELECT sensor, page, len(v) AS len, round(list_sum(v), 4) AS total, list_max(v) AS top, list_min(v) AS low,
  round(list_sum(v[1:2]), 4) AS head, len(list_filter(v, lambda x: x > 50)) AS big FROM d""")
def i12(spark, sf):
    d = paged_points(spark, sf).withColumn("v", select.values_of("points"))
    add = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x)
    return d.select("sensor", "page", F.size("v").cast("long").alias("len"), F.round(add(F.col("v")), 4).alias("total"),
                    F.array_max("v").alias("top"), F.array_min("v").alias("low"),
                    F.round(add(F.slice("v", 1, 2)), 4).alias("head"),
                    F.size(F.filter("v", lambda x: x > 50)).cast("long").alias("big"))


@query("i13_maps", with_(READINGS) + """
SELECT sensor, count(DISTINCT site) AS kinds, count(DISTINCT CASE WHEN site <> 'click' THEN site END) AS others,
  round(max(value) * 2, 4) AS top FROM readings GROUP BY sensor""")
def i13(spark, sf):
    best = readings(spark, sf).groupBy("sensor", "site").agg(F.max("value").alias("_m"))
    maps = best.groupBy("sensor").agg(F.map_from_entries(F.collect_list(F.struct("site", "_m"))).alias("m"))
    doubled = F.transform_values("m", lambda _, x: x * 2)
    return maps.select("sensor", F.size("m").cast("long").alias("kinds"),
                       F.size(F.map_filter("m", lambda k, _: k != "click")).cast("long").alias("others"),
                       F.round(F.array_max(F.map_values(doubled)), 4).alias("top"))


@query("i14_math", with_(READINGS) + """
SELECT sensor, max(alt // 7) AS q, min(alt % 7) AS r, CAST(round(avg(alt), 0) AS BIGINT) AS mean FROM readings
GROUP BY sensor""")
def i14(spark, sf):
    return readings(spark, sf).groupBy("sensor").agg(
        F.max(F.expr("v.alt div 7")).cast("int").alias("q"), F.min(F.col("v.alt") % 7).alias("r"),
        F.round(F.avg("v.alt")).cast("long").alias("mean"))


@query("i15_json", with_(READINGS) + """
SELECT event_id, alt AS k, '{"k":' || alt || '}' AS json FROM readings""")
def i15(spark, sf):
    from catalog.base import table
    parsed = table(spark, sf, "events").withColumn("_j", F.from_json("props", "k int"))
    return parsed.select("event_id", "_j.k", F.to_json("_j").alias("json"))


@query("k18_grid_cells", with_(READINGS) + f"""
SELECT label, row_number() OVER (ORDER BY first_us, label) - 1 AS sensor, lat1, lat2, lng1, lng2 FROM
  (SELECT 'C' || {sql_geohash("lat", "lng")} || 'Z' || (alt // 35 * 35) AS label, {sql_decode("lat", "lng")},
    min(us) AS first_us FROM readings GROUP BY ALL)""")
def k18(spark, sf):
    return jobs.grid_sensors(jobs.grid_readings(readings(spark, sf)))


@query("k18_cell_counts", with_(READINGS) + f"""
SELECT 'owner_' || site AS swimlane, 'C' || {sql_geohash("lat", "lng")} || 'Z' || (alt // 35 * 35) AS label,
  count(*) AS n FROM readings GROUP BY ALL""")
def k18b(spark, sf):
    return n(jobs.grid_readings(readings(spark, sf)), "swimlane", "label")


@query("k19_tiles", with_(POSITIONS) + "SELECT sensor, " + ", ".join(
    f"{sql_tile_x('lng', z)} AS tile_x_{z}, {sql_tile_y('lat', z)} AS tile_y_{z}" for z in (8, 14, 20)) + " FROM positions")
def k19(spark, sf):
    p = positions(spark, sf).select("sensor", F.col("lat1").alias("lat"), F.col("lng1").alias("lng"))
    return lookup.with_tiles(p, [8, 14, 20]).drop("lat", "lng")


@query("k19_tile_box", with_(POSITIONS) + f" SELECT sensor FROM positions WHERE {IN_BOX}")
def k19b(spark, sf):
    p = positions(spark, sf).select("sensor", F.col("lat1").alias("lat"), F.col("lng1").alias("lng"))
    return lookup.tile_prefilter(lookup.with_tiles(p, [5]), 5, BOX).select("sensor")


@query("k19_clustered_box", with_(READINGS) + f" SELECT event_id, sensor FROM readings WHERE {IN_BOX}")
def k19c(spark, sf):
    """A box read from a table that is stored along the curve of its tiles: the box is a few ranges of the stored column."""
    path = scratch_path(spark, "clustered")
    placed = readings(spark, sf).select("event_id", "sensor", "ts", "v.lat", "v.lng")
    layout.write_clustered(placed, path)
    return layout.in_box(spark.read.parquet(path), BOX).select("event_id", "sensor")
