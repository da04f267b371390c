import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gaugeworks.sources import layout, tables


def points(spark, n=60_000):
    return spark.range(n).select(
        F.col("id").alias("sensor_id"), (F.col("id") % 300).alias("sensor"), F.concat(F.lit("s"), F.col("id") % 3).alias("swimlane"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") % 5000).alias("ts"), (F.pmod(F.xxhash64("id"), F.lit(16000)) / 100 - 80).alias("lat"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(36000)) / 100 - 180).alias("lng"), F.concat(F.lit("m"), F.col("id") % 2).alias("measurement"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("x"), F.col("id") % 5)).alias("site"))


def touched(path, column, ranges):
    """Share of row groups whose statistics meet one of the ranges."""
    hit = total = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += any(stats.min <= hi and stats.max >= lo for lo, hi in ranges)
    assert total > 15
    return hit / total


@pytest.mark.parametrize("box", [(10.0, 20.0, 14.0, 27.0), (-0.5, -0.5, 0.5, 0.5), (-85.0, -180.0, 85.0, 180.0), (3.0, 4.0, 3.0, 4.0)])
def test_ranges_of_a_box_cover_it(spark, box):
    df = points(spark, 20_000).withColumn("curve", layout.curve(F.col("lat"), F.col("lng")))
    plain = df.where(F.col("lat").between(box[0], box[2]) & F.col("lng").between(box[1], box[3]))
    assert layout.in_box(df, box).exceptAll(plain).count() == 0 and plain.exceptAll(layout.in_box(df, box)).count() == 0
    ranges = layout.box_ranges(box)
    assert len(ranges) <= 64 and all(a[1] + 1 < b[0] for a, b in zip(ranges, ranges[1:]))


def test_box_and_sensor_reads_touch_a_share_of_the_row_groups(spark, tmp_path):
    small = {"parquet.block.size": "20000", "parquet.page.size.row.check.min": "100", "parquet.block.size.row.check.min": "100"}
    box = (10.0, 20.0, 14.0, 27.0)
    for aim in layout.AIMS:
        layout.write_clustered(points(spark), str(tmp_path / aim), aim, **small)
    found = layout.in_box(spark.read.parquet(str(tmp_path / "all")), box)
    assert found.count() == points(spark).where("lat between 10 and 14 and lng between 20 and 27").count() > 0
    assert touched(tmp_path / "all", "curve", layout.box_ranges(box)) < 0.25
    assert touched(tmp_path / "swimlane", "curve", layout.box_ranges(box)) < 0.4
    assert touched(tmp_path / "sensor", "sensor", [(7, 7)]) < 0.1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(curve" in plan
    with pytest.raises(ValueError):
        layout.write_clustered(points(spark), str(tmp_path / "no"), "label")


def test_partitioned_files_are_sorted_by_sensor(spark, tmp_path):
    spark.conf.set("parquet.block.size", "20000")
    try:
        tables.write_readings(points(spark).repartition(3), str(tmp_path / "t"), 10**6)
    finally:
        spark.conf.unset("parquet.block.size")
    for file in glob.glob(f"{tmp_path}/t/**/*.parquet", recursive=True):
        sensors = pq.ParquetFile(file).read(columns=["sensor"])["sensor"].to_pylist()
        assert sensors == sorted(sensors)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 60_000 and back.where("site is null").count() == 12_000
