import time

import pytest
from pyspark.sql import functions as F

from gaugeworks.sources import tables
from gaugeworks.streaming import keyed
from gaugeworks.streaming.jobs import ChainedJob, WindowJob
from gaugeworks.streaming.stopping import run_until

T0 = 1_700_000_000


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))


def test_sessions_across_a_restart_equal_batch(spark, tmp_path):
    """Rows out of order within the delay, a session that spans two runs, and state that is empty at the end."""
    first = rows_of(spark, [("a", T0), ("b", T0 + 3), ("a", T0 + 45), ("a", T0 + 20), ("a", T0 + 200)])
    second = rows_of(spark, [("a", T0 + 231), ("b", T0 + 400), ("b", T0 + 431), ("c", T0 + 420)])
    closer = rows_of(spark, [("z", T0 + 9000)])
    end = rows_of(spark, [("z", T0 + 9001)])
    job = keyed.session_job(["k"], "k string", 30, delay="60 seconds")
    for part in (first, second, closer, end):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(part.schema).parquet(str(tmp_path / "in"))
        job.start(stream, str(tmp_path / "cp"), str(tmp_path / "out")).awaitTermination(120)
    got = sorted((r["k"], r["start"], r["last"], r["n"]) for r in tables.read_batches(spark, str(tmp_path / "out")).collect())
    want = sorted((r["k"], r["start"], r["last"], r["n"]) for r in keyed.sessions(first.union(second), ["k"], 30).collect())
    assert got == want and ("a", T0 + 200, T0 + 200, 1) in got and ("a", T0, T0 + 45, 3) in got


def test_values_and_maps_of_a_key(spark, tmp_path):
    """An alarm that re-arms: the value state counts rows, the map state keeps the last second per label."""
    def on_rows(state, key, rows):
        n = (state.value() or (0,))[0] + len(rows)
        state.set_value((n,) if n < 5 else None)
        for t in rows["ts"]:
            state.set_entry((f"m{t.second % 2}",), (t.second,))
        return [(*key, n, len(list(state.entries())))] if n >= 3 else []

    job = keyed.KeyedJob("alarms", ["k"], "k string, n long, labels long", on_rows)
    for part in ([("a", T0), ("a", T0 + 1)], [("a", T0 + 2)], [("a", T0 + 3), ("a", T0 + 4)], [("a", T0 + 5)]):
        df = rows_of(spark, part).coalesce(1)
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
        job.start(stream, str(tmp_path / "cp"), str(tmp_path / "out")).awaitTermination(120)
    got = sorted(tuple(r) for r in tables.read_batches(spark, str(tmp_path / "out")).select("k", "n", "labels").collect())
    assert got == [("a", 3, 2), ("a", 5, 2)]


def test_chained_windows_in_one_query(spark, tmp_path):
    rows = rows_of(spark, [("ab"[i % 2], T0 - T0 % 100 + i) for i in range(0, 600)])
    rows.write.parquet(str(tmp_path / "in"))
    first = WindowJob("tens", 10, ["k"], result=lambda c: c, delay="0 seconds")
    job = ChainedJob("hundreds", 100, ["k"], result=lambda c: c, state={"most": F.max("n"), "parts": F.count("n")}, first=first)
    job.start(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), str(tmp_path / "cp"), str(tmp_path / "out")).awaitTermination(120)
    key = lambda r: (r["window_start"], r["k"], r["most"], r["parts"])
    got = sorted(key(r) for r in tables.read_batches(spark, str(tmp_path / "out")).collect())
    want = sorted(key(r) for r in job.run_batch(rows).collect())
    assert got and got == [w for w in want if w[0] < got[-1][0] + 100] and {w[2:] for w in got} == {(5, 10)}


@pytest.mark.parametrize("how", ["rows", "idle"])
def test_stop_after_rows_or_idle_time(spark, tmp_path, how):
    df = rows_of(spark, [("a", T0 + i) for i in range(40)])
    df.repartition(8).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = (stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp"))
             .trigger(processingTime="100 milliseconds").start())
    begin = time.monotonic()
    taken = run_until(query, rows=12) if how == "rows" else run_until(query, idle=4)
    assert not query.isActive and time.monotonic() - begin < 90
    assert 12 <= taken < 40 if how == "rows" else taken == 40
    with pytest.raises(ValueError):
        run_until(query)
