import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from gaugeworks.functions import geo, scalars


def test_known_geohash(spark):
    df = spark.createDataFrame([(57.64911, 10.40744), (-90.0, -180.0), (90.0, 180.0)], "lat double, lng double")
    got = [r[0] for r in df.select(geo.geohash_encode(F.col("lat"), F.col("lng"))).collect()]
    assert got == ["u4pruy", "000000", "zzzzzz"]


def test_decoded_cell_holds_its_point(spark):
    rng = F.rand(1)
    df = spark.range(3000).select((rng * 180 - 90).alias("lat"), (F.rand(2) * 360 - 180).alias("lng"))
    box = geo.geohash_decode(geo.geohash_encode(F.col("lat"), F.col("lng")))
    held = df.select("lat", "lng", box.alias("b")).where(
        F.col("lat").between(F.col("b.lat1"), F.col("b.lat2")) & F.col("lng").between(F.col("b.lng1"), F.col("b.lng2")))
    assert held.count() == 3000


def test_cell_labels(spark):
    df = spark.createDataFrame([(57.64911, 10.40744, 71.5), (1.0, 2.0, -36.0)], "lat double, lng double, alt double")
    rows = df.select(geo.cell_label(F.col("lat"), F.col("lng"), F.col("alt")).alias("l")).withColumn(
        "p", geo.parse_cell_label(F.col("l"))).collect()
    assert rows[0]["l"] == "Cu4pruyZ70" and rows[0]["p"]["hash"] == "u4pruy" and rows[0]["p"]["alt"] == 70
    assert rows[1]["p"]["alt"] == -35


def test_cell_meets_box(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0, 1.0), (0.2, 0.4, 0.2, 0.4), (2.0, 3.0, 0.0, 1.0)],
                               "lat1 double, lat2 double, lng1 double, lng2 double")
    cols = [F.col(c) for c in df.columns]
    hit = df.select(geo.cell_meets_box(*cols, 0.1, 0.1, 0.5, 0.5).alias("o"),
                    geo.cell_meets_box(*cols, 0.1, 0.1, 0.5, 0.5, contained=True).alias("c")).collect()
    assert [(r["o"], r["c"]) for r in hit] == [(True, False), (True, True), (False, False)]


def test_states_have_inclusive_bounds(spark):
    df = spark.createDataFrame([("ping", 50.0), ("ping", 50.1), ("ping", 501.0), ("cpu", 0.55), ("cpu", 0.56),
                                ("reject", 0.001), ("other", 1.0)], "m string, v double")
    got = [r[0] for r in df.select(scalars.health_state(F.col("m"), F.col("v"))).collect()]
    assert got == [0, 1, 2, 3, 4, 0, None]


@given(st.integers(1, 400), st.sampled_from("smhdSMHD"))
@settings(max_examples=20, deadline=None)
def test_durations(n, unit):
    assert scalars.duration_seconds(f"{n}{unit}") == n * {"s": 1, "m": 60, "h": 3600, "d": 86400}[unit.lower()]


def test_bad_duration():
    with pytest.raises(ValueError):
        scalars.duration_seconds("5x")


def test_sliding_windows(spark):
    row = spark.range(1).select(scalars.sliding_starts(F.timestamp_seconds(F.lit(605)), 600, 60).alias("s")).first()
    assert sorted(row["s"]) == list(range(60, 601, 60))
