import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import lookup, select
from gaugeworks.sources import files, tables


def test_wide_series(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text("Province/State,Country/Region,Lat,Long,1/22/20,1/23/20,12/31/99\n"
                    ",A,1.5,2.5,3,4,5\n Q ,B,1,2,,7,8\n")
    rows = {(r["label"], str(r["ts"])[:10]): r["value"] for r in files.read_wide_series(spark, str(path)).collect()}
    assert rows == {("A", "2020-01-22"): 3, ("A", "2020-01-23"): 4, ("A", "1999-12-31"): 5,
                    ("B. Q ", "2020-01-23"): 7, ("B. Q ", "1999-12-31"): 8}


def test_event_catalogue(spark, tmp_path):
    path = tmp_path / "c.tsv"
    line = lambda kind, depth, time: "\t".join(
        ["1", "c", "2014.05.06", time, "38.1", "27.2", depth, "3.4", "", "", "", "", "", kind])
    path.write_text("\t".join(f"h{i}" for i in range(14)) + "\n" + "\n".join(
        [line("Ke", "-2.5", "10:11:12.98"), line("Ke", "3.5", "00:00:00.00"), line("Sm", "1", "00:00:00.0")]))
    rows = files.read_event_catalogue(spark, str(path)).orderBy("ts").collect()
    assert [r["v"]["alt"] for r in rows] == [4, 2]
    assert str(rows[1]["ts"]) == "2014-05-06 10:11:12" and rows[0]["v"]["m"] == 3.4


def test_payload_list_file(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps([
        {"measurement": "m", "series": {"job": "a", "instance": "x"},
         "data": [{"ns": 10, "value": 1.5, "series": {"instance": "y"}}, {"ns": 11, "value": 2}]},
        {"key": "k", "data": [{"ns": 12, "value": {"m": 3.0, "lat": 1.0, "lng": 2.0, "alt": 7}}]}], indent=1))
    rows = files.read_payloads(spark, str(path)).orderBy("ts").withColumns(
        {"x": F.expr("try_cast(raw AS double)"),
         "v": files.point_value(F.col("raw"))}).collect()
    assert rows[0]["labels"] == {"job": "a", "instance": "y"} and rows[0]["x"] == 1.5
    assert rows[1]["labels"] == {"job": "a", "instance": "x"}
    assert rows[2]["key"] == "k" and rows[2]["v"]["alt"] == 7


def test_layout_prunes_partitions(spark, tmp_path):
    df = spark.range(1000).select(
        F.lit("m").alias("measurement"), F.concat(F.lit("s"), F.col("id") % 3).alias("site"),
        F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.col("id").cast("double").alias("value"))
    path = str(tmp_path / "t")
    tables.write_readings(df, path, 3600)
    part = select.time_range(spark.read.parquet(path), "1970-01-01T02:00:00+00:00", "1970-01-01T03:00:00+00:00",
                             slice_seconds=3600)
    assert part.count() == 60
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slice" in plan


def test_expired_slices(spark):
    import datetime as dt
    df = spark.createDataFrame([(0,), (9,), (10,), (11,)], "slice long")
    anchor = dt.datetime.fromtimestamp(40 * 86400, dt.timezone.utc)
    got = {r["slice"] for r in tables.expired_slices(df, 86400, "30d", anchor).collect()}
    assert got == {0, 9}


def test_batch_replay_replaces(spark, tmp_path):
    path = str(tmp_path / "b")
    for _ in range(2):
        tables.write_batch(spark.range(5), path, 3)
    tables.write_batch(spark.range(2), path, 4)
    assert tables.read_batches(spark, path).count() == 7


def test_metrics_append_and_compact(spark, tmp_path):
    df = spark.range(4).select(F.create_map(F.lit("a"), F.lit("b")).alias("labels"),
                               F.timestamp_seconds("id").alias("ts"), F.lit(1.0).alias("value"))
    for _ in range(2):
        tables.append_metrics(df, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 8
    wide = spark.read.parquet(str(tmp_path / "m")).withColumn("k", F.second("ts"))
    wide.write.parquet(str(tmp_path / "k"))
    tables.compact(spark, str(tmp_path / "k"), str(tmp_path / "c"), ["k"])
    assert spark.read.parquet(str(tmp_path / "c")).count() == 8


def test_matchers(spark):
    df = spark.createDataFrame([({"a": "xy"}, 1), ({"a": "x"}, 2), ({"b": "q"}, 3)], "labels map<string,string>, i int")
    ids = lambda *m: {r["i"] for r in df.where(select.Matcher(*m).column()).collect()}
    assert ids("a", "x", "EQ") == {2} and ids("a", "x", "NEQ") == {1, 3}
    assert ids("a", "x", "RE") == {2} and ids("a", "x.*", "RE") == {1, 2}
    assert ids("a", "x.*", "NRE") == {3} and ids("a", "", "EQ") == {3}
    with pytest.raises(ValueError):
        select.Matcher("a", "x", "ANY").column()


def test_box_order_swapped(spark):
    a = lookup.box_table(spark, [[1, 2, 3, 4]]).first()
    b = lookup.box_table(spark, [[2, 1, 4, 3]], lng_first=True).first()
    assert a == b and a["lat1"] == 1.0 and a["lng2"] == 4.0


def test_range_join_equals_nested_loop(spark):
    pts = spark.range(2000).select(F.col("id").alias("sensor"), (F.rand(5) * 170 - 85).alias("lat1"),
                                   (F.rand(6) * 360 - 180).alias("lng1")).cache()
    boxes = lookup.box_table(spark, [[-80, -170, 80, 170], [10, 10, 10.5, 11], [0, 0, 30, 30], [-85, 179, 85, 180],
                                     [44.9, -0.1, 45.1, 0.1]])
    b = boxes.selectExpr("box", "lat1 AS a", "lng1 AS b", "lat2 AS c", "lng2 AS d")
    want = pts.join(b, F.expr("lat1 BETWEEN a AND c AND lng1 BETWEEN b AND d")).select("box", "sensor")
    got = lookup.boxes_of_sensors(pts, boxes)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_retention_prunes_and_drops_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    day = 86400
    rows = spark.range(40 * 24).select(F.lit("m").alias("measurement"), F.lit("s").alias("site"),
                                       F.timestamp_seconds(F.col("id") * 3600).alias("ts"), F.col("id").alias("value"))
    tables.write_readings(rows, path, day)
    anchor = dt.datetime(1970, 2, 10, tzinfo=dt.timezone.utc)
    stored = spark.read.parquet(path)
    for kept in (tables.expire(stored, "5d", anchor, day), select.recent(stored, "5d", anchor, slice_seconds=day),
                 select.recent(stored, "5d", slice_seconds=day)):
        assert kept.count() in (5 * 24, 5 * 24 + 1)
        assert kept.select("slice").distinct().count() <= 6
    plan = select.recent(stored, "5d", anchor, slice_seconds=day)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(slice" in plan
    gone = tables.drop_expired(spark, path, day, "5d", anchor)
    assert len(gone) == 35 and spark.read.parquet(path).count() == 5 * 24


def test_metric_range_and_name_prune_partitions(spark, tmp_path):
    Matcher, select_metrics = select.Matcher, select.select_metrics
    path = str(tmp_path / "m")
    rows = spark.range(1000).select(F.lit("m").alias("measurement"), F.concat(F.lit("k"), F.col("id") % 3).alias("site"),
                                    F.timestamp_seconds(F.col("id") * 3600).alias("ts"), F.create_map(
                                        F.lit("__name__"), F.concat(F.lit("k"), F.col("id") % 3)).alias("labels"))
    tables.write_readings(rows, path, 86400)
    df = spark.read.parquet(path)
    tests = [Matcher("__name__", "k[01]", "RE")]
    pruned = select_metrics(df, 0, 5 * 86400 * 1000, tests, 86400, {"__name__": "site"})
    assert pruned.count() == select_metrics(df, 0, 5 * 86400 * 1000, tests).count() > 0
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "slice" in plan.split("PartitionFilters")[1].split("]")[0] and "RLIKE" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
