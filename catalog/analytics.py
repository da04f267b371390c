"""Models, outliers, clusters, risk scores, standing jobs and user hooks."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.base import (CPT_SQL, HEALTH, READINGS, RISKS, SCHEMAS, STATE, cpt, health, positions, query, readings,
                          risk_series, secs, table, with_)
from catalog.grouping import BROAD, CLASSED, DAY, ORDER
from catalog.selecting import BOX, IN_BOX, PEAKS, peaks
from catalog.sources import ALERTS, alert_rows
from gaugeworks.operators import arma, bayes, dbscan, lookup, network, outliers, rbf, resample, series, stationarity
from gaugeworks.plans import jobs, risk
from gaugeworks.session import scratch_path
from gaugeworks.sources import tables
from gaugeworks.streaming import keyed
from gaugeworks.streaming.jobs import ChainedJob, WindowJob, drop_report

W = "OVER (PARTITION BY sensor ORDER BY us, event_id)"
LAGGED = f"lagged AS (SELECT sensor, us, event_id, value AS y, lag(value) {W} AS y1, lag(value, 2) {W} AS y2 FROM readings)"


MAD = with_(READINGS, """c AS (SELECT t - t % 3600 AS h, site, value FROM readings),
  m AS (SELECT h, site, median(value) AS median FROM c GROUP BY ALL),
  d AS (SELECT h, site, median(abs(value - median)) AS mad FROM c JOIN m USING (h, site) GROUP BY ALL)""") + """
SELECT h, site, value, count(*) AS n, round(median, 6) AS median, round(mad, 6) AS mad
FROM c JOIN m USING (h, site) JOIN d USING (h, site)
WHERE CASE WHEN mad = 0 THEN value <> median ELSE abs(value - median) / (1.4826 * mad) > 3.5 END GROUP BY ALL"""


# Streams read the event table as a file source. What the watermark has not closed does not come out.

def event_stream(spark, sf):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    raw = spark.readStream.schema(SCHEMAS["events"]).parquet(f"{sf}/events*.parquet")
    return raw.select(F.col("user_id").alias("sensor"), F.col("event_type").alias("site"), "ts", "value")


def run_stream(spark, job, stream):
    path = scratch_path(spark, job.name)
    q = job.start(stream, f"{path}/checkpoint", f"{path}/out")
    q.awaitTermination()
    return tables.read_batches(spark, f"{path}/out"), q


def count_job(seconds, slide=None):
    return WindowJob(f"count_{seconds}", seconds, ["site"], result=lambda closed: closed, slide=slide)


CLOSED = "window_start + {0} <= (SELECT max(us) FROM readings) // 1000000 - {0}"


@query("j1_tumbling_stream", with_(READINGS) + """
SELECT * FROM (SELECT t - t % 3600 AS window_start, t - t % 3600 + 3600 AS window_end, site, count(*) AS n
  FROM readings GROUP BY ALL) WHERE """ + CLOSED.format(3600))
def j1(spark, sf):
    return run_stream(spark, count_job(3600), event_stream(spark, sf))[0]


@query("j1_tumbling_batch", with_(READINGS) + """
SELECT t - t % 3600 AS window_start, t - t % 3600 + 3600 AS window_end, site, count(*) AS n FROM readings GROUP BY ALL""")
def j1b(spark, sf):
    return count_job(3600).run_batch(readings(spark, sf))


SLID = """s AS (SELECT t - t % 60 - 60 * i AS window_start, site FROM readings, range(10) r(i))"""


@query("j2_sliding_batch", with_(READINGS, SLID) + """
SELECT window_start, window_start + 600 AS window_end, site, count(*) AS n FROM s GROUP BY ALL""")
def j2(spark, sf):
    return count_job(600, 60).run_batch(readings(spark, sf))


@query("j2_sliding_stream", with_(READINGS, SLID) + """
SELECT * FROM (SELECT window_start, window_start + 600 AS window_end, site, count(*) AS n FROM s GROUP BY ALL)
WHERE """ + CLOSED.format(600))
def j2b(spark, sf):
    return run_stream(spark, count_job(600, 60), event_stream(spark, sf))[0]


UNEVEN = """s AS (SELECT t - t % 250 - 250 * i AS window_start, site FROM readings, range(3) r(i) WHERE t - t % 250 - 250 * i + 600 > t)"""


@query("j2_uneven_slide_batch", with_(READINGS, UNEVEN) + """
SELECT window_start, window_start + 600 AS window_end, site, count(*) AS n FROM s GROUP BY ALL""")
def j2c(spark, sf):
    return count_job(600, 250).run_batch(readings(spark, sf))


@query("j2_uneven_slide_stream", with_(READINGS, UNEVEN) + """
SELECT * FROM (SELECT window_start, window_start + 600 AS window_end, site, count(*) AS n FROM s GROUP BY ALL)
WHERE """ + CLOSED.format(600))
def j2d(spark, sf):
    return run_stream(spark, count_job(600, 250), event_stream(spark, sf))[0]


@query("j13_restarted_stream", with_(READINGS) + """
SELECT * FROM (SELECT t - t % 86400 AS window_start, t - t % 86400 + 86400 AS window_end, site, count(*) AS n
  FROM readings GROUP BY ALL) WHERE """ + CLOSED.format(DAY))
def j13(spark, sf):
    path, source = scratch_path(spark, "restart"), scratch_path(spark, "parts")
    rows = readings(spark, sf).select("site", "ts")
    for part in (F.col("ts") < "2024-01-16 12:00", F.col("ts") >= "2024-01-16 12:00"):
        rows.where(part).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        count_job(DAY).start(stream, f"{path}/checkpoint", f"{path}/out").awaitTermination()
    return tables.read_batches(spark, f"{path}/out")


@query("a16_unsaved_results", with_(READINGS) + """
SELECT count(*) AS windows FROM (SELECT t - t % 86400 AS window_start FROM readings GROUP BY ALL) WHERE """
       + CLOSED.format(DAY))
def a16(spark, sf):
    path = scratch_path(spark, "unsaved")
    job = WindowJob("unsaved", DAY, [], result=lambda closed: closed, save=False)
    sink = lambda df, batch: tables.write_batch(df, f"{path}/alerts", batch)
    job.start(event_stream(spark, sf), f"{path}/checkpoint", sinks=[sink]).awaitTermination()
    return tables.read_batches(spark, f"{path}/alerts").agg(F.count(F.lit(1)).alias("windows"))


@query("j4_partition_map_filter", with_(READINGS) + """
SELECT t - t % 86400 AS window_start, t - t % 86400 + 86400 AS window_end, instance, count(*) AS n
FROM readings WHERE site IN ('click', 'view') AND value * 2 > 20 GROUP BY ALL""")
def j4(spark, sf):
    job = WindowJob(
        "stages", DAY, ["instance"], result=lambda closed: closed, keep=F.col("site").isin("click", "view"),
        map=lambda df: df.withColumn("value", F.col("value") * 2).where("value > 20"),
        partition=lambda df: df.withColumn("instance", F.col("labels")["instance"]))
    return job.run_batch(readings(spark, sf))


@query("j5_map_stage", with_(READINGS) + """
SELECT t - t % 86400 AS window_start, t - t % 86400 + 86400 AS window_end, kind, count(*) AS n FROM
  (SELECT t, CASE WHEN site IN ('click', 'view') THEN 'seen' ELSE 'other' END AS kind FROM readings) GROUP BY ALL""")
def j5(spark, sf):
    kind = F.when(F.col("site").isin("click", "view"), "seen").otherwise("other")
    job = WindowJob("mapped", DAY, ["kind"], result=lambda closed: closed,
                    map=lambda df: df.select(kind.alias("kind"), "ts"))
    return job.run_batch(readings(spark, sf))


@query("j6_filter_stage", with_(READINGS, RISKS) + """
SELECT t - t % 86400 AS window_start, t - t % 86400 + 86400 AS window_end, instance, risk, max(value) AS top
FROM risks WHERE whn = 'now' GROUP BY ALL""")
def j6(spark, sf):
    job = WindowJob("filtered", DAY, ["instance", "risk"], state={"top": F.max("value")},
                    map=risk.current_risks, result=lambda closed: closed)
    return job.run_batch(risk_series(spark, sf))


@query("j7_result_stage", MAD.replace("SELECT h, site, value", "SELECT h AS window_start, h + 3600 AS window_end, site, value"))
def j7(spark, sf):
    out = jobs.outlier_job(3600, ["site"]).run_batch(readings(spark, sf))
    return out.withColumns({"median": F.round("median", 6), "mad": F.round("mad", 6)})


@query("j8_collect", with_(READINGS, RISKS, PEAKS, CLASSED, BROAD) + """
SELECT 'attack_share' AS name, 'ddos' AS type, window_start + 86400 AS t,
  round(attack_broadness, 9) AS value FROM status""")
def j8(spark, sf):
    out = jobs.cluster_status_job(DAY).run_batch(risk_series(spark, sf))
    return out.select(F.col("labels")["__name__"].alias("name"), F.col("labels")["type"].alias("type"),
                      secs().alias("t"), F.round("value", 9).alias("value"))


@query("j10_chained_streams", with_(READINGS) + """
SELECT * FROM (SELECT h - h % 86400 AS window_start, site, max(n) AS busiest FROM
  (SELECT t - t % 3600 AS h, site, count(*) AS n FROM readings GROUP BY ALL)
  WHERE h + 3600 <= (SELECT max(us) FROM readings) // 1000000 - 3600 GROUP BY ALL)
WHERE window_start + 86400 <= (SELECT max(h) FROM (SELECT t - t % 3600 AS h FROM readings)
  WHERE h + 3600 <= (SELECT max(us) FROM readings) // 1000000 - 3600) - 86400""")
def j10(spark, sf):
    hourly = run_stream(spark, count_job(3600), event_stream(spark, sf))[0]
    path = scratch_path(spark, "hourly")
    hourly.withColumn("ts", F.timestamp_seconds("window_start")).write.parquet(path)
    made = spark.read.parquet(path)
    daily = WindowJob("busiest", DAY, ["site"], state={"busiest": F.max("n")},
                      result=lambda closed: closed.drop("window_end"))
    return run_stream(spark, daily, spark.readStream.schema(made.schema).parquet(path))[0]


ARRIVED = "t + event_id % 7 * 1800"


@query("j3_arrival_windows", with_(READINGS) + f"""
SELECT {ARRIVED} - ({ARRIVED}) % 3600 AS window_start, {ARRIVED} - ({ARRIVED}) % 3600 + 3600 AS window_end, site, count(*) AS n FROM readings GROUP BY ALL""")
def j3(spark, sf):
    """Windows of recorded arrival times, in a batch."""
    return arrival_job().run_batch(arrivals(readings(spark, sf).select("event_id", "site", "ts")))


@query("j3_arrival_stream", with_(READINGS) + f"""
SELECT * FROM (SELECT {ARRIVED} - ({ARRIVED}) % 3600 AS window_start, {ARRIVED} - ({ARRIVED}) % 3600 + 3600 AS window_end, site, count(*) AS n
  FROM readings GROUP BY ALL) WHERE window_end <= (SELECT max((us + event_id % 7 * 1800000000)) // 1000000 FROM readings) - 3600""")
def j3b(spark, sf):
    """The same as a standing job: what came late by its event time is on time by its arrival."""
    raw = spark.readStream.schema(SCHEMAS["events"]).parquet(f"{sf}/events*.parquet")
    return run_stream(spark, arrival_job(), arrivals(raw.select("event_id", F.col("event_type").alias("site"), "ts")))[0]


def arrivals(df):
    return df.withColumn("arrived", F.col("ts") + F.make_dt_interval(secs=F.col("event_id") % 7 * 1800))


def arrival_job():
    return WindowJob("arrivals", 3600, ["site"], result=lambda closed: closed, real_time=True, arrival="arrived")


@query("j10_chained_in_one_query", with_(READINGS) + """
SELECT * FROM (SELECT h - h % 86400 AS window_start, h - h % 86400 + 86400 AS window_end, site, max(n) AS busiest FROM
  (SELECT t - t % 3600 AS h, site, count(*) AS n FROM readings GROUP BY ALL) GROUP BY ALL)
WHERE window_end <= (SELECT max(us) FROM readings) // 1000000 - 3600""")
def j10b(spark, sf):
    """Two stateful stages in one stream with one checkpoint."""
    daily = ChainedJob("busiest", DAY, ["site"], result=lambda closed: closed, state={"busiest": F.max("n")}, first=count_job(3600))
    return run_stream(spark, daily, event_stream(spark, sf))[0]


@query("l5_keyed_sessions", with_(READINGS) + """,
  g AS (SELECT sensor, t, us, CASE WHEN us - lag(us) OVER (PARTITION BY sensor ORDER BY us) <= 7200000000 THEN 0 ELSE 1 END AS opens FROM readings),
  s AS (SELECT sensor, t, sum(opens) OVER (PARTITION BY sensor ORDER BY us ROWS UNBOUNDED PRECEDING) AS no FROM g)
SELECT sensor, min(t) AS start, max(t) AS last, count(*) AS n FROM s GROUP BY sensor, no""")
def l5b(spark, sf):
    """Sessions per sensor by callbacks with state of their own. Whole seconds, so that gaps are the same in both."""
    return keyed.sessions(readings(spark, sf), ["sensor"], 7200)


@query("j12_drop_report", "SELECT count(*) AS rows_in, CAST(0 AS BIGINT) AS rows_dropped FROM events")
def j12(spark, sf):
    _, q = run_stream(spark, count_job(DAY), event_stream(spark, sf))
    return drop_report(spark, q).agg(F.sum("rows_in").alias("rows_in"), F.sum("rows_dropped").alias("rows_dropped"))


@query("j12_late_half_refused", with_(READINGS) + """
SELECT t - t % 86400 AS window_start, t - t % 86400 + 86400 AS window_end, site, count(*) AS n, true AS refused FROM readings
WHERE ts >= TIMESTAMP '2024-01-16 00:00:00' AND t - t % 86400 + 86400 <= (SELECT max(us) FROM readings) // 1000000 - 86400 GROUP BY ALL""")
def j12c(spark, sf):
    """The newer half of the rows comes first; all that comes after it is late, and the report says so."""
    path, source = scratch_path(spark, "late"), scratch_path(spark, "halves")
    rows = readings(spark, sf).select("site", "ts")
    for part in (F.col("ts") >= "2024-01-16", F.col("ts") < "2024-01-16"):
        rows.where(part).write.mode("append").parquet(source)
        q = count_job(DAY).start(spark.readStream.schema(rows.schema).parquet(source), f"{path}/checkpoint", f"{path}/out")
        q.awaitTermination()
    refused = drop_report(spark, q).agg((F.sum("rows_dropped") > 0).alias("refused")).scalar()
    return tables.read_batches(spark, f"{path}/out").withColumn("refused", refused)


@query("j12_late_rows_replay", with_(READINGS, """
b AS (SELECT t, (event_id + event_id % 7 * 40) * 6 // (SELECT max(event_id) + 281 FROM readings) AS batch FROM readings),
m AS (SELECT batch, max(max(t)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - 3600 AS mark
  FROM b GROUP BY batch)""") + """
SELECT batch, coalesce(t - t % 3600 + 3600 <= mark, false) AS late, count(*) AS n FROM b JOIN m USING (batch)
GROUP BY ALL""")
def j12b(spark, sf):
    """Six arrival batches as micro-batches of one stream; each row is a state of its own, so refused states are refused rows. A batch
    refuses by the watermark that the batch before it went by, which is two batches behind."""
    rows = readings(spark, sf).select("event_id", "ts")
    top = rows.agg(F.max("event_id")).first()[0] + 281
    batch = F.call_function("div", (F.col("event_id") + F.col("event_id") % 7 * 40) * 6, F.lit(top))
    path, source = scratch_path(spark, "late_rows"), scratch_path(spark, "arrivals")
    for k in range(6):
        rows.where(batch == k).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    job = WindowJob("late_rows", 3600, ["event_id"], result=lambda closed: closed)
    q = job.start(stream, f"{path}/checkpoint", f"{path}/out")
    q.awaitTermination()
    arrived = drop_report(spark, q).where("rows_in > 0").withColumn(
        "batch", F.row_number().over(Window.partitionBy("task").orderBy("batch")).cast("long") - 1)
    counts = F.array(F.struct(F.lit(True).alias("late"), F.col("rows_dropped").alias("n")),
                     F.struct(F.lit(False).alias("late"), (F.col("rows_in") - F.col("rows_dropped")).alias("n")))
    return arrived.select("batch", F.inline(counts)).where("n > 0")


@query("k1_mad_outliers", MAD)
def k1(spark, sf):
    hourly = readings(spark, sf).withColumn("h", secs() - secs() % 3600)
    return outliers.mad_outliers(hourly, ["h", "site"]).withColumns(
        {"median": F.round("median", 6), "mad": F.round("mad", 6)})


@query("k1_mad_by_selection", with_(READINGS, """m AS (SELECT site, median(value) AS median FROM readings GROUP BY ALL),
  d AS (SELECT site, median(abs(value - median)) AS mad FROM readings JOIN m USING (site) GROUP BY ALL)""") + """
SELECT site, value, count(*) AS n, round(median, 6) AS median, round(mad, 6) AS mad FROM readings JOIN m USING (site) JOIN d USING (site)
WHERE CASE WHEN mad = 0 THEN value <> median ELSE abs(value - median) / (1.4826 * mad) > 1.2 END GROUP BY ALL""")
def k1b(spark, sf):
    """Groups too large for one task: their medians are found by repeated selection."""
    found = outliers.mad_outliers(readings(spark, sf), ["site"], threshold=1.2, target_rows=100)
    return found.withColumns({"median": F.round("median", 6), "mad": F.round("mad", 6)})


@query("k2_outlier_alerts", ALERTS + " SELECT * FROM alerts")
def k2(spark, sf):
    return alert_rows(spark, sf)


ADF = f"""a AS (SELECT sensor, count(*) AS size, regr_count(y - y1, y1) AS nobs, regr_slope(y - y1, y1) AS b,
    regr_sxx(y - y1, y1) AS sxx, regr_syy(y - y1, y1) AS syy, regr_sxy(y - y1, y1) AS sxy FROM lagged GROUP BY sensor),
  s AS (SELECT *, b / sqrt((syy - b * sxy) / (nobs - 2) / sxx) AS stat FROM a)"""


@query("k3_adf_stat", with_(READINGS, LAGGED, ADF) + " SELECT sensor, size, CAST(nobs AS BIGINT) AS nobs, round(stat, 6) AS stat FROM s")
def k3(spark, sf):
    return stationarity.adf(readings(spark, sf), ["sensor"], ORDER).select(
        "sensor", "size", "nobs", F.round("stat", 6).alias("stat"))


NORMAL = """p AS (SELECT *, CASE WHEN stat <= -1.61 THEN 2.1659 + 1.4412 * stat + 0.038269 * stat * stat
    ELSE 1.7339 + 0.93202 * stat - 0.12745 * stat * stat - 0.010368 * stat * stat * stat END AS z FROM s),
  k AS (SELECT *, 1.0 / (1.0 + 0.3275911 * abs(z) / sqrt(2.0)) AS k FROM p),
  e AS (SELECT *, 1.0 - ((((1.061405429 * k - 1.453152027) * k + 1.421413741) * k - 0.284496736) * k + 0.254829592)
    * k * exp(-z * z / 2) AS erf FROM k),
  v AS (SELECT *, CASE WHEN stat < -18.83 THEN 0 WHEN stat > 2.74 THEN 1 WHEN z >= 0 THEN (1 + erf) / 2
    ELSE (1 - erf) / 2 END AS pvalue, greatest(-3.43035 - 6.5393 / nobs - 16.786 / nobs ** 2 - 79.433 / nobs ** 3,
    -2.86154 - 2.8903 / nobs - 4.234 / nobs ** 2 - 40.040 / nobs ** 3,
    -2.56677 - 1.5384 / nobs - 2.809 / nobs ** 2) AS top FROM e)"""


@query("k4_stationarity", with_(READINGS, LAGGED, ADF, NORMAL) + """
SELECT sensor, round(pvalue, 6) AS pvalue, CASE WHEN size <= 60 THEN 'too few points'
  WHEN pvalue < 0.05 THEN 'unit root rejected at 5 %' WHEN stat > top THEN 'unit root not rejected'
  ELSE 'unit root rejected at 10 % only' END AS feature FROM v""")
def k4(spark, sf):
    return stationarity.stationarity(readings(spark, sf), ["sensor"], ORDER, min_records=60).select(
        "sensor", F.round("pvalue", 6).alias("pvalue"), "feature")


@query("k5_lag_sums", with_(READINGS, LAGGED) + """
SELECT sensor, count(*) AS n, round(sum(y * y), 2) AS s0, round(coalesce(sum(y * y1), 0), 2) AS s1,
  round(coalesce(sum(y * y2), 0), 2) AS s2 FROM lagged GROUP BY sensor""")
def k5(spark, sf):
    s = arma.lag_sums(readings(spark, sf), ["sensor"], ORDER, "value", 2)
    return s.select("sensor", "n", *[F.round(F.col("s")[i], 2).alias(f"s{i}") for i in range(3)])


ALL_SENSORS = "ids AS (SELECT DISTINCT sensor FROM readings)"
AR2 = """m AS (SELECT sensor, sum(y1 * y1) AS a, sum(y1 * y2) AS b, sum(y2 * y2) AS c, sum(y * y1) AS u, sum(y * y2) AS v,
    sum(y * y) AS yy, count(*) AS rows FROM lagged WHERE y2 IS NOT NULL GROUP BY sensor),
  ar AS (SELECT *, (u * c - v * b) / (a * c - b * b) AS phi1, (v * a - u * b) / (a * c - b * b) AS phi2
    FROM m WHERE rows > 2)"""


@query("k5_ar2_fit", with_(READINGS, LAGGED, ALL_SENSORS, AR2) + """
SELECT sensor, round(phi1, 6) AS phi1, round(phi2, 6) AS phi2,
  round((yy - phi1 * u - phi2 * v) / (rows - 2), 3) AS sigma2 FROM ids LEFT JOIN ar USING (sensor)""")
def k5b(spark, sf):
    model = arma.fit(readings(spark, sf), ["sensor"], ORDER, p=2)
    return model.select("sensor", F.round(F.col("phi")[0], 6).alias("phi1"), F.round(F.col("phi")[1], 6).alias("phi2"),
                        F.round("sigma2", 3).alias("sigma2"))


AR1 = """m AS (SELECT sensor, sum(y * y1) / sum(y1 * y1) AS phi, sum(y * y) - sum(y * y1) ** 2 / sum(y1 * y1) AS sse,
    count(*) AS rows FROM {0} WHERE y1 IS NOT NULL GROUP BY sensor HAVING count(*) > 1),
  l AS (SELECT sensor, arg_max(y, (us, event_id)) AS last FROM {0} GROUP BY sensor)"""


def ahead(df, *columns, digits=4):
    """Rows of a forecast with rounded values, as the oracles give them."""
    return df.select(*[F.col("h").cast("long").alias("h") if c == "h" else F.round(c, digits).alias(c) if c in ("forecast", "upper") else c
                       for c in columns])


@query("k6_ar1_forecast", with_(READINGS, LAGGED, ALL_SENSORS, AR1.format("lagged")) + """
SELECT sensor, h, round(last * phi ** h, 5) AS forecast, CASE WHEN abs(phi) < 1 THEN round(last * phi ** h
  + 1.959963984540054 * sqrt(sse / (rows - 1) * (1 - phi ** (2 * h)) / (1 - phi * phi)), 5) END AS upper
FROM ids LEFT JOIN m USING (sensor) LEFT JOIN l USING (sensor), range(1, 13) r(h)""")
def k6(spark, sf):
    model = arma.fit(readings(spark, sf), ["sensor"], ORDER, p=1)
    return ahead(arma.forecast(model, ["sensor"], 12), "sensor", "h", "forecast", "upper", digits=5)


# AR(3) by Cramer's rule; the recursion carries the last three values and weights. Stationary by Jury's conditions.
AR3 = f"""z3 AS (SELECT sensor, us, event_id, value AS y, lag(value) {W} AS y1, lag(value, 2) {W} AS y2, lag(value, 3) {W} AS y3
    FROM readings),
  m AS (SELECT sensor, sum(y1 * y1) AS a, sum(y1 * y2) AS b, sum(y1 * y3) AS c, sum(y2 * y2) AS d, sum(y2 * y3) AS e, sum(y3 * y3) AS f,
    sum(y * y1) AS u, sum(y * y2) AS v, sum(y * y3) AS w, sum(y * y) AS yy, count(*) AS rows FROM z3 WHERE y3 IS NOT NULL
    GROUP BY sensor HAVING count(*) > 3),
  det AS (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS det FROM m),
  phi AS (SELECT *, (u * (d * f - e * e) - b * (v * f - w * e) + c * (v * e - w * d)) / det AS p1,
    (a * (v * f - w * e) - u * (b * f - c * e) + c * (b * w - c * v)) / det AS p2,
    (a * (d * w - e * v) - b * (b * w - c * v) + u * (b * e - c * d)) / det AS p3 FROM det),
  model AS (SELECT sensor, p1, p2, p3, (yy - p1 * u - p2 * v - p3 * w) / (rows - 3) AS s2, abs(p3) < 1 AND 1 - p1 - p2 - p3 > 0
    AND 1 + p1 - p2 + p3 > 0 AND 1 - p3 * p3 > abs(p2 + p1 * p3) AS steady FROM phi),
  ends AS (SELECT sensor, y AS x1, y1 AS x2, y2 AS x3 FROM z3 QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY us DESC, event_id DESC) = 1),
  run AS (SELECT sensor, 0 AS h, x1, x2, x3, 1.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 0.0::DOUBLE AS w3, 0.0::DOUBLE AS var FROM ends
    UNION ALL SELECT r.sensor, h + 1, p1 * x1 + p2 * x2 + p3 * x3, x1, x2, p1 * w1 + p2 * w2 + p3 * w3, w1, w2, var + w1 * w1
    FROM run r JOIN model USING (sensor) WHERE h < 12)"""


@query("k6_ar3_forecast", "WITH RECURSIVE " + READINGS + ",\n" + AR3 + """
SELECT sensor, h::BIGINT AS h, round(x1, 4) AS forecast, CASE WHEN steady THEN round(x1 + 1.959963984540054 * sqrt(s2 * var), 4) END AS upper
FROM run JOIN model USING (sensor) WHERE h > 0""")
def k6c(spark, sf):
    return ahead(arma.forecast(arma.fit(readings(spark, sf), ["sensor"], ORDER, p=3), ["sensor"], 12), "sensor", "h", "forecast", "upper")


@query("k6_ar_forecast")
def k6b(spark, sf):
    return arma.forecast(arma.fit(readings(spark, sf), ["sensor"], ORDER, p=3), ["sensor"], 12)


# ARMA(1,1) with a long AR of one term: two regressions with one and two unknowns.
ARMA11 = """ar AS (SELECT sensor, sum(y * y1) / sum(y1 * y1) AS pi FROM {0} WHERE y2 IS NOT NULL GROUP BY sensor),
  mm AS (SELECT sensor, sum(y1 * y1) AS a, sum(y1 * (y1 - pi * y2)) AS b, sum((y1 - pi * y2) ** 2) AS c, sum(y * y1) AS u,
    sum(y * (y1 - pi * y2)) AS v, sum(y * y) AS yy, count(*) AS rows FROM {0} JOIN ar USING (sensor) WHERE y2 IS NOT NULL
    GROUP BY sensor HAVING count(*) > 2),
  arma AS (SELECT *, (u * c - v * b) / (a * c - b * b) AS phi, (v * a - u * b) / (a * c - b * b) AS theta FROM mm),
  ends AS (SELECT sensor, y, y1 FROM {0} QUALIFY row_number() OVER (PARTITION BY sensor ORDER BY us DESC, event_id DESC) = 1),
  next AS (SELECT sensor, phi, theta, (yy - phi * u - theta * v) / (rows - 2) AS s2, phi * y + theta * (y - pi * y1) AS f1
    FROM arma JOIN ar USING (sensor) JOIN ends USING (sensor))"""


@query("k7_arma11_fit", with_(READINGS, LAGGED, ALL_SENSORS, ARMA11.format("lagged")) + """
SELECT sensor, round(phi, 5) AS phi, round(theta, 5) AS theta, round(s2, 3) AS sigma2 FROM ids LEFT JOIN next USING (sensor)""")
def k7b(spark, sf):
    model = arma.fit(readings(spark, sf), ["sensor"], ORDER, p=1, q=1, long_order=1)
    return model.select("sensor", F.round(F.col("phi")[0], 5).alias("phi"), F.round(F.col("theta")[0], 5).alias("theta"),
                        F.round("sigma2", 3).alias("sigma2"))


@query("k8_arma11_forecast", with_(READINGS, LAGGED, ALL_SENSORS, ARMA11.format("lagged")) + """
SELECT sensor, h, round(f1 * phi ** (h - 1), 4) AS forecast, CASE WHEN abs(phi) < 1 THEN round(f1 * phi ** (h - 1) + 1.959963984540054 *
  sqrt(s2 * (1 + (phi + theta) ** 2 * (1 - phi ** (2 * h - 2)) / (1 - phi * phi))), 4) END AS upper
FROM ids LEFT JOIN next USING (sensor), range(1, 13) r(h)""")
def k8b(spark, sf):
    model = arma.fit(readings(spark, sf), ["sensor"], ORDER, p=1, q=1, long_order=1)
    return ahead(arma.forecast(model, ["sensor"], 12), "sensor", "h", "forecast", "upper")


@query("k7_arma_fit")
def k7(spark, sf):
    return arma.fit(readings(spark, sf), ["sensor"], ORDER, p=3, q=4).select(
        "sensor", "n", F.col("phi").cast("string").alias("phi"), F.col("theta").cast("string").alias("theta"), "sigma2", "reason")


@query("k8_arma_forecast")
def k8(spark, sf):
    return arma.forecast(arma.fit(readings(spark, sf), ["sensor"], ORDER, p=3, q=4), ["sensor"], 12)


DIFFED = f"""dd AS (SELECT sensor, us, event_id, value - lag(value) {W} AS y, value FROM readings),
  z AS (SELECT sensor, us, event_id, y, lag(y) {W} AS y1, lag(y, 2) {W} AS y2 FROM dd WHERE y IS NOT NULL)"""
LEVELS = "v AS (SELECT sensor, arg_max(value, (us, event_id)) AS level FROM readings GROUP BY sensor)"


@query("k9_arima_110_forecast", with_(READINGS, DIFFED, AR1.format("z"), LEVELS) + """
SELECT sensor, h, round(level + last * phi * (1 - phi ** h) / (1 - phi), 4) AS forecast
FROM v LEFT JOIN m USING (sensor) LEFT JOIN l USING (sensor), range(1, 21) r(h)""")
def k9(spark, sf):
    model = arma.fit(readings(spark, sf), ["sensor"], ORDER, p=1, d=1)
    return ahead(arma.forecast(model, ["sensor"], 20, d=1), "sensor", "h", "forecast")


@query("k9_arima_111_forecast", with_(READINGS, DIFFED, ARMA11.format("z"), LEVELS) + """
SELECT sensor, h, round(level + f1 * (1 - phi ** h) / (1 - phi), 4) AS forecast
FROM v LEFT JOIN next USING (sensor), range(1, 21) r(h)""")
def k9c(spark, sf):
    out = arma.arima_forecast(readings(spark, sf), ["sensor"], ORDER, p=1, q=1, long_order=1)
    return ahead(out, "sensor", "h", "forecast")


@query("k9_arima_forecast")
def k9b(spark, sf):
    return arma.arima_forecast(readings(spark, sf), ["sensor"], ORDER)


def monthly_by_nation(spark, sf):
    nation = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf, "orders").join(nation, "o_custkey").select(
        "c_nationkey", F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("value"))
    return resample.resample(orders, ["c_nationkey"], 30 * DAY, F.col("value"))


MONTHLY = f"""b AS (SELECT c_nationkey, epoch_us(o_orderdate) // 1000000 // {30 * DAY} * {30 * DAY} AS bucket, sum(o_totalprice) AS s
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
  span AS (SELECT c_nationkey, unnest(range(min(bucket), max(bucket) + 1, {30 * DAY})) AS bucket FROM b GROUP BY c_nationkey),
  f AS (SELECT c_nationkey AS sensor, bucket AS us, 0 AS event_id, round(avg(coalesce(s, 0)) OVER (PARTITION BY c_nationkey ORDER BY bucket
    ROWS UNBOUNDED PRECEDING), 3) AS value FROM span LEFT JOIN b USING (c_nationkey, bucket))"""
MONTHS = LAGGED.replace("FROM readings", "FROM f")

for method in ("ar", "arma", "arima", "rbf"):
    @query(f"k10_many_series_{method}")
    def k10(spark, sf, method=method):
        return jobs.cell_forecasts(monthly_by_nation(spark, sf), ["c_nationkey"], method, p=3, q=2)


@query("k10_many_series_ar1", with_(MONTHLY, MONTHS, AR1.format("lagged")) + """
SELECT sensor AS c_nationkey, h, round(last * phi ** h, 1) AS forecast FROM m JOIN l USING (sensor), range(1, 13) r(h)""")
def k10b(spark, sf):
    out = jobs.cell_forecasts(monthly_by_nation(spark, sf), ["c_nationkey"], "ar", p=1)
    return ahead(out, "c_nationkey", "h", "forecast", digits=1)


@query("k10_many_series_arma11", with_(MONTHLY, MONTHS, ARMA11.format("lagged")) + """
SELECT sensor AS c_nationkey, h, round(f1 * phi ** (h - 1), 1) AS forecast FROM next, range(1, 13) r(h)""")
def k10c(spark, sf):
    out = jobs.cell_forecasts(monthly_by_nation(spark, sf), ["c_nationkey"], "arma", p=1, q=1, long_order=1)
    return ahead(out, "c_nationkey", "h", "forecast", digits=1)


@query("k10_many_series_arima111", with_(MONTHLY, DIFFED.replace("FROM readings", "FROM f"), ARMA11.format("z"),
                                        LEVELS.replace("FROM readings", "FROM f")) + """
SELECT sensor AS c_nationkey, h, round(level + f1 * (1 - phi ** h) / (1 - phi), 0) AS forecast FROM next JOIN v USING (sensor), range(1, 4) r(h)""")
def k10d(spark, sf):
    out = jobs.cell_forecasts(monthly_by_nation(spark, sf), ["c_nationkey"], "arima", p=1, q=1, n=3, long_order=1)
    return ahead(out, "c_nationkey", "h", "forecast", digits=0)


@query("k11_geo_forecast")
def k11(spark, sf):
    return jobs.geo_forecast(readings(spark, sf), positions(spark, sf), BOX)


BOXED = f"""total AS (SELECT us, 0 AS event_id, 1 AS sensor, sum(value) AS value FROM readings WHERE {IN_BOX} GROUP BY us)"""


@query("k11_geo_forecast_110", with_(
    READINGS, BOXED, DIFFED.replace("FROM readings", "FROM total"), AR1.format("z"),
    "v AS (SELECT arg_max(value, us) AS level FROM total)") + """
SELECT 'box' AS series, h, round(level + last * phi * (1 - phi ** h) / (1 - phi), 4) AS forecast
FROM m JOIN l USING (sensor), v, range(1, 21) r(h)""")
def k11b(spark, sf):
    out = jobs.geo_forecast(readings(spark, sf), positions(spark, sf), BOX, p=1, q=0)
    return ahead(out, "series", "h", "forecast")


@query("k11_geo_forecast_111", with_(
    READINGS, BOXED, DIFFED.replace("FROM readings", "FROM total"), ARMA11.format("z"),
    "v AS (SELECT arg_max(value, us) AS level FROM total)") + """
SELECT 'box' AS series, h, round(level + f1 * (1 - phi ** h) / (1 - phi), 4) AS forecast FROM next, v, range(1, 21) r(h)""")
def k11c(spark, sf):
    out = jobs.geo_forecast(readings(spark, sf), positions(spark, sf), BOX, p=1, q=1, long_order=1)
    return ahead(out, "series", "h", "forecast")


AREA = f"""b AS (SELECT t - t % 86400 AS bucket, sum(value) AS s FROM readings WHERE {IN_BOX} GROUP BY ALL),
  span AS (SELECT unnest(range(min(bucket), max(bucket) + 1, 86400)) AS bucket FROM b),
  f AS (SELECT 1 AS sensor, bucket AS us, 0 AS event_id, round(avg(coalesce(s, 0)) OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING), 3) AS value
    FROM span LEFT JOIN b USING (bucket))"""


@query("k12_area_forecast_ar1", with_(READINGS, AREA, MONTHS, AR1.format("lagged")) + """
SELECT 'area' AS series, h, round(last * phi ** h, 3) AS forecast FROM m JOIN l USING (sensor), range(1, 13) r(h)""")
def k12c(spark, sf):
    out = jobs.area_forecast(readings(spark, sf), positions(spark, sf), BOX, DAY, F.col("v.m"), p=1)
    return ahead(out, "series", "h", "forecast", digits=3)


@query("k12_area_series", with_(READINGS, f"""b AS (SELECT t - t % 86400 AS bucket, sum(value) AS s FROM readings
    WHERE {IN_BOX} GROUP BY ALL),
  span AS (SELECT unnest(range(min(bucket), max(bucket) + 1, 86400)) AS bucket FROM b),
  f AS (SELECT bucket, coalesce(s, 0) AS total FROM span LEFT JOIN b USING (bucket))""") + """
SELECT 'area' AS series, bucket, round(total, 2) AS total,
  round(avg(total) OVER (ORDER BY bucket ROWS UNBOUNDED PRECEDING), 6) AS value FROM f""")
def k12(spark, sf):
    out = jobs.area_series(readings(spark, sf), positions(spark, sf), BOX, DAY, F.col("v.m"), digits=6)
    return out.withColumns({"total": F.round("total", 2)})


@query("k12_area_forecast")
def k12b(spark, sf):
    return jobs.area_forecast(readings(spark, sf), positions(spark, sf), BOX, DAY, F.col("v.m"))


@query("k13_rbf_one_landmark", with_(READINGS, """
x AS (SELECT sensor, value, row_number() OVER (PARTITION BY sensor ORDER BY us DESC, event_id DESC) - 1 AS back,
  avg(value) OVER (PARTITION BY sensor) AS mean FROM readings),
w AS (SELECT sensor, mean, sum(exp(-0.125 * back * back) * (value - mean))
  / (sum(exp(-0.25 * back * back)) + 1.0 / 40) AS w FROM x GROUP BY sensor, mean)""") + """
SELECT sensor, h, round(mean + w * exp(-0.125 * h * h), 6) AS forecast FROM w, range(1, 13) r(h)""")
def k13(spark, sf):
    out = rbf.forecast_index(readings(spark, sf), ["sensor"], ORDER, n=12, landmarks=1)
    return out.select("sensor", F.col("h").cast("long").alias("h"), F.round("forecast", 6).alias("forecast"))


# Ridge regression on two bumps: a system of two equations.
RBF2 = """x AS (SELECT sensor, value, row_number() OVER (PARTITION BY sensor ORDER BY us DESC, event_id DESC) - 1 AS back,
    avg(value) OVER (PARTITION BY sensor) AS mean FROM {0}),
  f AS (SELECT sensor, mean, value - mean AS y, exp(-0.125 * back * back) AS f1, exp(-0.125 * (back - 1) ** 2) AS f2 FROM x),
  g AS (SELECT sensor, mean, sum(f1 * f1) + 1.0 / 40 AS a, sum(f1 * f2) AS b, sum(f2 * f2) + 1.0 / 40 AS c, sum(f1 * y) AS u,
    sum(f2 * y) AS v FROM f GROUP BY sensor, mean),
  w AS (SELECT sensor, mean, (u * c - v * b) / (a * c - b * b) AS w1, (v * a - u * b) / (a * c - b * b) AS w2 FROM g)"""


@query("k13_rbf_two_landmarks", with_(READINGS, RBF2.format("readings")) + """
SELECT sensor, h, round(mean + w1 * exp(-0.125 * h * h) + w2 * exp(-0.125 * (h + 1) ** 2), 5) AS forecast FROM w, range(1, 13) r(h)""")
def k13c(spark, sf):
    out = rbf.forecast_index(readings(spark, sf), ["sensor"], ORDER, n=12, landmarks=2)
    return ahead(out, "sensor", "h", "forecast", digits=5)


@query("k10_many_series_rbf2", with_(MONTHLY, RBF2.format("f")).replace("f AS (SELECT sensor, mean", "ff AS (SELECT sensor, mean").replace(
    "sum(f2 * y) AS v FROM f GROUP", "sum(f2 * y) AS v FROM ff GROUP") + """
SELECT sensor AS c_nationkey, h, round(mean + w1 * exp(-0.125 * h * h) + w2 * exp(-0.125 * (h + 1) ** 2), 1) AS forecast FROM w, range(1, 13) r(h)""")
def k10e(spark, sf):
    out = jobs.cell_forecasts(monthly_by_nation(spark, sf), ["c_nationkey"], "rbf", landmarks=2)
    return ahead(out, "c_nationkey", "h", "forecast", digits=1)


SUPPORT = """x AS (SELECT sensor, value, row_number() OVER (PARTITION BY sensor ORDER BY us DESC, event_id DESC) - 1 AS back,
  avg(value) OVER (PARTITION BY sensor) AS mean FROM readings),
  y AS (SELECT sensor, any_value(mean) AS mean, max(CASE WHEN back = 0 THEN value - mean END) AS y0,
    max(CASE WHEN back = 1 THEN value - mean END) AS y1 FROM x WHERE back < {0} GROUP BY sensor)"""
CLIPPED = "greatest(-20, least(20, sign({0}) * greatest(abs({0}) - 0.1, 0)))"


@query("k13_support_one_point", with_(READINGS, SUPPORT.format(1)) + f"""
SELECT sensor, h, round(mean + {CLIPPED.format("y0")} * exp(-0.125 * h * h), 6) AS forecast FROM y, range(1, 13) r(h)""")
def k13d(spark, sf):
    out = rbf.support_forecast(readings(spark, sf), ["sensor"], ORDER, n=12, rows=1)
    return ahead(out, "sensor", "h", "forecast", digits=6)


# Two weights in turn until they stay: each takes what the other leaves.
@query("k13_support_two_points", "WITH RECURSIVE " + with_(READINGS, SUPPORT.format(2)).removeprefix("WITH ") + f""",
  b AS (SELECT 0 AS step, sensor, mean, y0, y1, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1 FROM y UNION ALL
    SELECT step + 1, sensor, mean, y0, y1, c0, coalesce({CLIPPED.format("(y1 - exp(-0.125) * c0)")}, 0) FROM
      (SELECT *, {CLIPPED.format("(y0 - exp(-0.125) * b1)")} AS c0 FROM b WHERE step < 160))
SELECT sensor, h, round(mean + b0 * exp(-0.125 * h * h) + b1 * exp(-0.125 * (h + 1) ** 2), 5) AS forecast FROM b, range(1, 13) r(h) WHERE step = 160""")
def k13e(spark, sf):
    out = rbf.support_forecast(readings(spark, sf), ["sensor"], ORDER, n=12, rows=2, tolerance=1e-10)
    return ahead(out, "sensor", "h", "forecast", digits=5)


@query("k13_rbf_forecast")
def k13b(spark, sf):
    return rbf.forecast_index(readings(spark, sf), ["sensor"], ORDER, n=12)


PTS = """pts AS (SELECT sensor AS id, avg(CASE WHEN site = 'error' THEN value END) / 500 AS x,
    avg(CASE WHEN site = 'click' THEN value END) / 500 AS y FROM readings GROUP BY sensor
    HAVING count(*) FILTER (site = 'error') > 0 AND count(*) FILTER (site = 'click') > 0),
  near AS (SELECT a.id, b.id AS other FROM pts a, pts b
    WHERE (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 0.006 * 0.006),
  core AS (SELECT id, count(*) >= 3 AS core FROM near GROUP BY id)"""


def user_points(spark, sf):
    mean = lambda s: F.avg(F.when(F.col("site") == s, F.col("value"))) / 500
    return (readings(spark, sf).groupBy(F.col("sensor").alias("id")).agg(mean("error").alias("x"), mean("click").alias("y"))
            .where("x is not null and y is not null"))


@query("k14_core_flags", with_(READINGS, PTS) + " SELECT id, core FROM core")
def k14(spark, sf):
    loc = dbscan.locations(user_points(spark, sf), [], 0.006)
    return dbscan.core_flags(loc, [], 0.006, 3).select("id", "core")


CLUSTERS = PTS.replace("pts AS", "RECURSIVE pts AS", 1) + """,
  hop AS (SELECT n.id, n.other FROM near n JOIN core a ON a.id = n.id AND a.core JOIN core b ON b.id = n.other AND b.core),
  reach AS (SELECT id, other FROM hop UNION SELECT r.id, h.other FROM reach r JOIN hop h ON r.other = h.id),
  lab AS (SELECT id, min(other) AS label FROM reach GROUP BY id),
  border AS (SELECT n.id, min(label) AS label FROM near n JOIN core c ON c.id = n.id AND NOT c.core
    JOIN lab l ON l.id = n.other GROUP BY n.id),
  named AS (SELECT label, dense_rank() OVER (ORDER BY label) AS cluster FROM (SELECT DISTINCT label FROM lab)),
  placed AS (SELECT p.id, p.x, p.y, coalesce(cluster, 0) AS cluster FROM pts p LEFT JOIN
    (SELECT * FROM lab UNION ALL SELECT * FROM border) a ON a.id = p.id LEFT JOIN named USING (label))"""
CLUSTER_SQL = "WITH RECURSIVE " + READINGS + ",\n" + CLUSTERS.replace("RECURSIVE ", "")


@query("k14_dbscan_labels", CLUSTER_SQL + " SELECT id, cluster FROM placed")
def k14b(spark, sf):
    return dbscan.dbscan(user_points(spark, sf), 0.006, 3).select("id", "cluster")


@query("e16_cluster_centroids", CLUSTER_SQL + """
SELECT cluster, count(*) AS size, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM placed WHERE cluster <> 0
GROUP BY cluster""")
def e16(spark, sf):
    out = dbscan.centroids(dbscan.dbscan(user_points(spark, sf), 0.006, 3))
    return out.select("cluster", "size", F.round("x", 6).alias("x"), F.round("y", 6).alias("y")).orderBy("size", "x", "y")


@query("g5_clusters_by_size", CLUSTER_SQL + """
SELECT size, count(*) AS clusters FROM (SELECT cluster, count(*) AS size FROM placed WHERE cluster <> 0 GROUP BY cluster)
GROUP BY size ORDER BY size""")
def g5(spark, sf):
    out = dbscan.centroids(dbscan.dbscan(user_points(spark, sf), 0.006, 3, numbered=False).where("cluster is not null"))
    return out.groupBy("size").agg(F.count(F.lit(1)).alias("clusters")).orderBy("size")


@query("jn6_neighbours_in_reach", with_(READINGS, PTS) + """
SELECT id, least(count(*), 3) AS n FROM near GROUP BY id""")
def jn6(spark, sf):
    # A point is core from three neighbours on; beyond that the operator need not count on.
    loc = dbscan.locations(user_points(spark, sf), [], 0.006)
    return dbscan.neighbour_counts(loc, [], 0.006, 3).select("id", F.least("near", F.lit(3)).cast("long").alias("n"))


SLIDE, SPAN = 21600, 86400
NOW = f"""x AS (SELECT t - t % {SLIDE} - {SLIDE} * i AS window_start, h.* FROM health h, range({SPAN // SLIDE}) r(i)),
  l AS (SELECT *, row_number() OVER (PARTITION BY window_start, instance, type ORDER BY us DESC, value DESC) AS k FROM x),
  st AS (SELECT window_start, instance, type, CAST(round(avg({STATE}), 0) AS INTEGER) AS state FROM l WHERE k <= 5
    GROUP BY ALL),
  ev AS (SELECT window_start, instance, max(CASE type WHEN 'ping' THEN state END) AS s1,
    max(CASE type WHEN 'cpu' THEN state END) AS s2, max(CASE type WHEN 'mem' THEN state END) AS s3,
    max(CASE type WHEN 'reject' THEN state END) AS s4 FROM st GROUP BY ALL HAVING count(*) = 4)"""
POST = """post AS (SELECT e.*, a, b, prior * l1.p * l2.p * l3.p * l4.p AS w FROM ev e, ab
    JOIN lk l1 USING (a, b) JOIN lk l2 USING (a, b) JOIN lk l3 USING (a, b) JOIN lk l4 USING (a, b)
    WHERE l1.node = 1 AND l1.s = s1 AND l2.node = 2 AND l2.s = s2 AND l3.node = 3 AND l3.s = s3
      AND l4.node = 4 AND l4.s = s4),
  risked AS (SELECT window_start, instance, CAST(0.02 + 0.05 * (s1 + s2 + s3 + s4) AS DOUBLE) AS p_crash,
    sum(CASE WHEN a = 1 THEN w ELSE 0 END) / sum(w) AS p_ddos,
    sum(CASE WHEN b = 1 THEN w ELSE 0 END) / sum(w) AS p_overload FROM post GROUP BY window_start, instance, s1, s2, s3, s4)"""
RISK_COLS = ", ".join(f"round({c}, 8) AS {c}" for c in ("p_crash", "p_ddos", "p_overload"))


@query("k15_bayes_marginals", with_(READINGS, HEALTH, NOW, CPT_SQL, POST) + f"""
SELECT window_start, instance, {RISK_COLS} FROM risked""")
def k15(spark, sf):
    now = risk.states_now(health(spark, sf), SPAN, SLIDE)
    return bayes.score(now, cpt(spark)).select(
        "window_start", "instance", *[F.round(c, 8).alias(c) for c in ("p_crash", "p_ddos", "p_overload")])


@query("b13_state_one_fields", with_(READINGS, HEALTH, NOW, CPT_SQL, POST) + """
SELECT instance, round(max(p_crash), 8) AS p_crash, round(max(p_ddos), 8) AS p_ddos,
  round(max(p_overload), 8) AS p_overload FROM risked GROUP BY instance""")
def b13(spark, sf):
    now = risk.states_now(health(spark, sf), SPAN, SLIDE)
    return bayes.score(now, cpt(spark)).groupBy("instance").agg(
        *[F.round(F.max(c), 8).alias(c) for c in ("p_crash", "p_ddos", "p_overload")])


# A network of six nodes with a table by a rule of our own, written the same way in SQL.
NET = {0: [1, 2], 1: [4], 2: [4, 5], 3: [2]}
NET_SIZES = [2, 3, 5, 5, 2, 2]


def net_tables(spark):
    """P(state | parents) in proportion to 1 + state * (node + sum of the parents' states)."""
    rows = []
    for v, size in enumerate(NET_SIZES):
        for combo in product(*[range(NET_SIZES[u]) for u in NET.get(v, [])]):
            weight = [1.0 + s * (v + sum(combo)) for s in range(size)]
            rows += [(v, s, list(combo), w / sum(weight)) for s, w in enumerate(weight)]
    return spark.createDataFrame(rows, "node int, state int, parents array<int>, p double")


def _net_p(v):
    lean = " + ".join([str(v), *(f"x{u}" for u in NET.get(v, []))])
    return f"(1.0 + x{v} * ({lean})) / ({' + '.join(f'(1.0 + {s} * ({lean}))' for s in range(NET_SIZES[v]))})"


PART = """l AS (SELECT t - t % 86400 AS window_start, *, row_number() OVER (PARTITION BY t - t % 86400, instance, type
    ORDER BY us DESC, value DESC) AS k FROM health),
  st AS (SELECT window_start, instance, type, CAST(round(avg(""" + STATE + """), 0) AS INTEGER) AS state FROM l WHERE k <= 5 GROUP BY ALL),
  ev AS (SELECT window_start, instance, max(CASE type WHEN 'ping' THEN state END) AS s1, max(CASE type WHEN 'cpu' THEN state END) AS s2,
    max(CASE type WHEN 'mem' THEN state END) AS s3 FROM st GROUP BY ALL)"""


@query("k15_any_network", with_(READINGS, HEALTH, PART) + f""",
  seen AS (SELECT DISTINCT s1, s2, s3 FROM ev),
  w AS (SELECT {", ".join(f"x{v}" for v in range(6))}, {" * ".join(_net_p(v) for v in range(6))} AS p
    FROM {", ".join(f"range({n}) r{v}(x{v})" for v, n in enumerate(NET_SIZES))}),
  post AS (SELECT s1, s2, s3, sum(p) AS total, sum(p * x0) AS q0, sum(p * x4) AS q4, sum(p * x5) AS q5 FROM seen JOIN w
    ON (s1 IS NULL OR x1 = s1) AND (s2 IS NULL OR x2 = s2) AND (s3 IS NULL OR x3 = s3) GROUP BY ALL)
SELECT window_start, instance, round(q0 / total, 8) AS p0, round(q4 / total, 8) AS p4, round(q5 / total, 8) AS p5 FROM ev JOIN post
  ON ev.s1 IS NOT DISTINCT FROM post.s1 AND ev.s2 IS NOT DISTINCT FROM post.s2 AND ev.s3 IS NOT DISTINCT FROM post.s3""")
def k15b(spark, sf):
    """A network of six nodes; what an instance did not report in a day stays open."""
    states = risk.latest_states(risk.in_windows(health(spark, sf), DAY, DAY), ["window_start", "instance"])
    wide = states.groupBy("window_start", "instance").agg(*risk.state_columns())
    out = network.evaluate(wide, NET, NET_SIZES, net_tables(spark), {1: "s1", 2: "s2", 3: "s3"}, [0, 4, 5])
    return out.select("window_start", "instance", *[F.round(F.col(f"p{v}")[1], 8).alias(f"p{v}") for v in (0, 4, 5)])


def node_risks(spark, sf, **options):
    return risk.node_risk(health(spark, sf), cpt(spark), SPAN, SLIDE, 3600, 3600.0, **options)


# The forecast on one landmark, the last second of the window, has one weight.
NEXT = f"""fx AS (SELECT window_start, instance, type, t AS sec, avg(value) AS v, count(*) AS n FROM x GROUP BY ALL),
  fm AS (SELECT *, sum(v * n) OVER w / sum(n) OVER w AS mean, max(sec) OVER w AS c FROM fx WINDOW w AS (PARTITION BY window_start, instance, type)),
  fw AS (SELECT window_start, instance, type, mean, c, sum(n * f * (v - mean)) / (sum(n * f * f) + 1.0 / 40) AS w
    FROM (SELECT *, exp(-0.125 * ((sec - c) / 3600.0) ** 2) AS f FROM fm) GROUP BY ALL),
  fv AS (SELECT window_start, instance, type, mean + w * exp(-0.125 * ((window_start + {SPAN} + 3600 - c) / 3600.0) ** 2) AS value FROM fw),
  fs AS (SELECT window_start, instance, type, {STATE} AS state FROM fv),
  nev AS (SELECT window_start, instance, max(CASE type WHEN 'ping' THEN state END) AS s1, max(CASE type WHEN 'cpu' THEN state END) AS s2,
    max(CASE type WHEN 'mem' THEN state END) AS s3, max(CASE type WHEN 'reject' THEN state END) AS s4 FROM fs GROUP BY ALL HAVING count(*) = 4)"""
NEXT_POST = POST.replace("post AS", "npost AS").replace("FROM ev e", "FROM nev e").replace("risked AS", "nrisked AS").replace("FROM post", "FROM npost")
BOTH = with_(READINGS, HEALTH, NOW, CPT_SQL, POST, NEXT, NEXT_POST)


@query("k16_node_risk_one_landmark", BOTH + f"""
SELECT window_start, window_start + {SPAN} AS window_end, instance, """ + ", ".join(
    f"round({a}.{c}, 7) AS {c}{b}" for a, b in (("r", ""), ("f", "_next")) for c in ("p_crash", "p_ddos", "p_overload")) + """
FROM risked r JOIN nrisked f USING (window_start, instance)""")
def k16b(spark, sf):
    out = node_risks(spark, sf, landmarks=1)
    risks = [c + b for b in ("", "_next") for c in ("p_crash", "p_ddos", "p_overload")]
    return out.select("window_start", "window_end", "instance", *[F.round(c, 7).alias(c) for c in risks])


@query("j9_metrics_by_key", BOTH + f""",
  pairs AS (SELECT window_start + {SPAN} AS t, instance, 'now' AS whn, p_crash, p_ddos, p_overload FROM risked SEMI JOIN nrisked USING (window_start, instance)
    UNION ALL SELECT window_start + {SPAN}, instance, 'future', p_crash, p_ddos, p_overload FROM nrisked SEMI JOIN risked USING (window_start, instance))
SELECT t, instance, whn AS "when", risk, 'instance_risk' AS name, round(CASE risk WHEN 'crash' THEN p_crash WHEN 'ddos' THEN p_ddos ELSE p_overload END, 7) AS value
FROM pairs, (VALUES ('crash'), ('ddos'), ('overload')) k(risk)""")
def j9b(spark, sf):
    out = risk.risk_metrics(node_risks(spark, sf, landmarks=1))
    return out.select(*[F.col("labels")[k].alias(k) for k in ("instance", "risk", "when")], F.col("labels")["__name__"].alias("name"),
                      secs().alias("t"), F.round("value", 7).alias("value"))


@query("k16_node_risk")
def k16(spark, sf):
    return node_risks(spark, sf)


@query("j9_collect_by_key")
def j9(spark, sf):
    out = risk.risk_metrics(node_risks(spark, sf))
    return out.select(*[F.col("labels")[k].alias(k) for k in ("__name__", "instance", "risk", "when")],
                      secs().alias("t"), "value")


@query("k17_cluster_status", with_(READINGS, RISKS, PEAKS, CLASSED, BROAD) + """
SELECT s.window_start, round(attack_broadness, 9) AS attack_broadness, c.members FROM status s JOIN
  (SELECT window_start, coalesce(string_agg(instance, ', ' ORDER BY instance) FILTER (cls = 'ddos'), '') AS members
    FROM classed GROUP BY window_start) c ON c.window_start = s.window_start WHERE attack_broadness > 0.1""")
def k17(spark, sf):
    p = peaks(spark, sf)
    alarmed = risk.broadness(p).where("attack_broadness > 0.1").select("window_start", "attack_broadness")
    return risk.class_members(p).join(alarmed, "window_start").select(
        "window_start", F.round("attack_broadness", 9).alias("attack_broadness"),
        F.array_join("ddos_members", ", ").alias("members"))


@query("k17_cluster_report")
def k17b(spark, sf):
    return risk.cluster_report(peaks(spark, sf), seconds=DAY)


@query("l1_named_function", with_(READINGS, LAGGED, ADF) + " SELECT sensor, round(stat, 6) AS stat FROM s WHERE size > 60")
def l1(spark, sf):
    def adf_of(df):
        return stationarity.adf(df, ["sensor"], ORDER).where("size > 60")
    return readings(spark, sf).transform(adf_of).select("sensor", F.round("stat", 6).alias("stat"))


@query("l2_group_rewrite", with_(READINGS) + """
SELECT alt, count(*) AS count, round(avg(value), 6) AS avg FROM readings GROUP BY alt""")
def l2(spark, sf):
    rewrite = [F.count("v.m").alias("count"), F.round(F.avg("v.m"), 6).alias("avg")]
    return readings(spark, sf).groupBy(F.col("v.alt").alias("alt")).agg(*rewrite)


@query("l3_resample_fold", with_(READINGS, """b AS (SELECT sensor, t - t % 86400 AS bucket, count(*) AS s FROM readings
    GROUP BY ALL),
  span AS (SELECT sensor, unnest(range(min(bucket), max(bucket) + 1, 86400)) AS bucket FROM b GROUP BY sensor)""") + """
SELECT sensor, bucket, CAST(max(coalesce(s, 0)) OVER (PARTITION BY sensor ORDER BY bucket) AS DOUBLE) AS value
FROM span LEFT JOIN b USING (sensor, bucket)""")
def l3(spark, sf):
    totals = resample.bucket_totals(readings(spark, sf), ["sensor"], DAY)
    return resample.fold_buckets(totals, ["sensor"], F.lit(0.0), lambda acc, x: F.greatest(acc, x), lambda acc: acc)


@query("l3_fold_smoothing", with_(READINGS, """b AS (SELECT sensor, t - t % 86400 AS bucket, count(*) AS s FROM readings
    GROUP BY ALL),
  span AS (SELECT sensor, unnest(range(min(bucket), max(bucket) + 1, 86400)) AS bucket FROM b GROUP BY sensor),
  f AS (SELECT sensor, bucket, coalesce(s, 0) AS s FROM span LEFT JOIN b USING (sensor, bucket))""") + """
SELECT a.sensor, a.bucket, round(sum(b.s * power(2.0 / 3.0, (a.bucket - b.bucket) // 86400)) / 3.0, 6) AS value
FROM f a JOIN f b ON a.sensor = b.sensor AND b.bucket <= a.bucket GROUP BY ALL""")
def l3b(spark, sf):
    """Exponential smoothing as a fold in chunks that are folded at the same time: a stretch keeps a share of what was before
    and adds a sum of its own."""
    totals = resample.bucket_totals(readings(spark, sf), ["sensor"], DAY)
    out = resample.fold_buckets(
        totals, ["sensor"], F.struct(F.lit(1.0).alias("keep"), F.lit(0.0).alias("add")),
        lambda a, x: F.struct((a["keep"] * (2 / 3)).alias("keep"), (a["add"] * (2 / 3) + x / 3).alias("add")), lambda a: a["add"],
        merge=lambda a, b: F.struct((a["keep"] * b["keep"]).alias("keep"), (a["add"] * b["keep"] + b["add"]).alias("add")), chunk_rows=4)
    return out.withColumn("value", F.round("value", 6))


@query("l4_routing", with_(READINGS) + """
SELECT 'owner_' || site AS swimlane, 'S' || (sensor % 16) AS sensor_key, count(*) AS n FROM readings GROUP BY ALL""")
def l4(spark, sf):
    from gaugeworks.functions.scalars import routing_key
    from gaugeworks.sources.files import route
    routed = route(readings(spark, sf), routing_key(F.lit("owner"), F.col("site")),
                   F.concat(F.lit("S"), F.col("sensor") % 16))
    return routed.groupBy("swimlane", "sensor_key").agg(F.count(F.lit(1)).alias("n"))


@query("l5_window_job", with_(READINGS) + """
SELECT t - t % 86400 AS window_start, swimlane, round(sum(value), 2) AS total FROM readings WHERE site <> 'signup'
GROUP BY ALL HAVING sum(value) > 100""")
def l5(spark, sf):
    job = WindowJob("totals", DAY, ["swimlane"], state={"total": F.sum("value")}, keep=F.col("site") != "signup",
                    result=lambda closed: closed.where("total > 100"),
                    collect=lambda df: df.select("window_start", "swimlane", F.round("total", 2).alias("total")))
    return job.run_batch(readings(spark, sf))


@query("l6_guarded_clauses", with_(READINGS, RISKS, PEAKS, CLASSED) + """
SELECT cls, count(*) AS n FROM classed GROUP BY cls""")
def l6(spark, sf):
    cls = risk.risk_class(F.col("ddos"), F.col("overload"))
    return peaks(spark, sf).groupBy(cls.alias("cls")).agg(F.count(F.lit(1)).alias("n"))
