import json
from pathlib import Path
import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import bayes
from gaugeworks.plans import jobs, risk
from gaugeworks.sources import kafka, tables
from gaugeworks.session import shared_dir
from gaugeworks.streaming.jobs import WindowJob, chain, drop_report
from test_clusters import random_cpt

T0 = 1_700_000_040


def spiky(spark, n=120, late=False):
    rng = np.random.default_rng(1)
    rows = [(0, T0 + i, float(rng.integers(100, 200) if (i + 1) % 7 == 0 else rng.integers(1, 10)))
            for i in range(n)]
    return spark.createDataFrame(rows, "sensor long, s long, value double").withColumn(
        "ts", F.timestamp_seconds("s")).drop("s")


def write(df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))


def stream(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(path))


CLOSER = "SELECT 0L AS sensor, 1.0D AS value, timestamp_seconds({}) AS ts"


def test_outlier_stream_equals_batch(spark, tmp_path):
    rows = spiky(spark)
    for part in rows.randomSplit([0.5, 0.5], 1):
        pass
    for i in range(4):
        write(rows.where((F.unix_seconds("ts") - T0).between(i * 30, i * 30 + 29)), tmp_path / "in")
    write(spark.sql(CLOSER.format(T0 + 300)), tmp_path / "in")
    sent = []
    job = jobs.alert_job(10)
    scratch = Path(shared_dir(spark).removeprefix("file:")) / "scratch"
    before = set(scratch.glob("*"))
    q = job.start(stream(spark, tmp_path / "in", rows.schema), str(tmp_path / "cp"), str(tmp_path / "out"),
                  sinks=[lambda df, b: sent.extend(r["value"] for r in kafka.to_records(df).collect())])
    q.awaitTermination(120)
    assert set(scratch.glob("*")) == before
    got = tables.read_batches(spark, str(tmp_path / "out")).orderBy("window_start").collect()
    want = job.run_batch(rows).orderBy("window_start").collect()
    assert got == want and len(want) >= 10
    assert sorted(sent) == sorted(r["message"] for r in want)
    assert drop_report(spark, q).agg(F.sum("rows_in")).first()[0] == 121


def test_restart_and_late_rows(spark, tmp_path):
    rows = spiky(spark, 40)
    job = WindowJob("count", 10, ["sensor"], result=lambda c: c, delay="0 seconds")
    drops = []

    def run():
        q = job.start(stream(spark, tmp_path / "in", rows.schema, 10), str(tmp_path / "cp"),
                      str(tmp_path / "out"))
        q.awaitTermination(120)
        drops.append(drop_report(spark, q).agg(F.sum("rows_dropped")).first()[0])

    write(rows.where(F.unix_seconds("ts") < T0 + 25), tmp_path / "in")
    run()
    write(rows.where(F.unix_seconds("ts") >= T0 + 25), tmp_path / "in")
    write(spark.sql(CLOSER.format(T0)), tmp_path / "in")
    run()
    write(spark.sql(CLOSER.format(T0 + 100)), tmp_path / "in")
    run()
    got = {r["window_start"]: r["n"] for r in tables.read_batches(spark, str(tmp_path / "out")).collect()}
    assert got == {T0: 10, T0 + 10: 10, T0 + 20: 10, T0 + 30: 10}
    assert drops == [0, 1, 0]


def health(spark, instances=4, minutes=14):
    rng = np.random.default_rng(4)
    scale = {"ping": 600, "cpu": 0.7, "mem": 0.5, "reject": 0.6}
    rows = [(f"n{i}", t, T0 + 60 * m + 7 * i, float(rng.uniform(0, scale[t])))
            for i in range(instances) for t in scale for m in range(minutes)
            if not (i == 3 and t == "mem")]
    return spark.createDataFrame(rows, "instance string, type string, s long, value double").withColumn(
        "ts", F.timestamp_seconds("s")).drop("s")


def test_node_risk_batch_forms_agree_and_match_plain(spark):
    cpt, _ = random_cpt(spark, 3, (2, 3, 5, 5, 5, 2, 2))
    points = health(spark)
    direct = risk.node_risk(points, cpt)
    state = jobs.node_risk_job(cpt).closed_in_batch(points)
    # Every reading is in one pane only.
    assert state.where("window_start is null").agg(F.sum("n")).first()[0] == points.count()
    a = direct.toPandas().sort_values(["window_start", "instance"]).reset_index(drop=True)
    b = risk.node_risk_closed(state, cpt).toPandas().sort_values(
        ["window_start", "instance"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-9)
    assert set(a["instance"]) == {"n0", "n1", "n2"}
    now = risk.states_now(points).toPandas()
    pdf = points.toPandas()
    sec = pdf["ts"].astype("int64") // 10 ** (9 if "ns" in str(pdf["ts"].dtype) else 6)
    w = now.iloc[len(now) // 2]
    inside = pdf[(sec >= w["window_start"]) & (sec < w["window_start"] + 600) & (pdf["instance"] == w["instance"])]
    cpu = inside[inside["type"] == "cpu"].sort_values("ts")["value"].tail(5)
    states = np.searchsorted([0.10, 0.25, 0.40, 0.55], cpu)
    assert w["s2"] == int(np.floor(states.mean() + 0.5))


def test_chained_streams_equal_batch(spark, tmp_path):
    cpt, _ = random_cpt(spark, 3)
    points = health(spark, 3, 6)
    first, second = jobs.node_risk_job(cpt, 120, 60), jobs.cluster_status_job(60)
    write(points, tmp_path / "in")
    write(points.limit(1).withColumn("ts", F.timestamp_seconds(F.lit(T0 + 9000))), tmp_path / "in")
    q = first.start(stream(spark, tmp_path / "in", points.schema), str(tmp_path / "cp1"), str(tmp_path / "m"))
    q.awaitTermination(200)
    made = tables.read_batches(spark, str(tmp_path / "m"))
    want = first.run_batch(points)
    key = lambda r: (r["ts"], sorted(r["labels"].items()))
    made_rows, want_rows = sorted(made.collect(), key=key), sorted(want.collect(), key=key)
    assert [key(r) for r in made_rows] == [key(r) for r in want_rows] and want_rows
    assert [r["value"] for r in made_rows] == pytest.approx([r["value"] for r in want_rows])
    closer = spark.sql(f"""SELECT map('__name__','x') AS labels, timestamp_seconds({T0 + 20000}) AS ts,
                           0.0D AS value""").select(*made.columns)
    write(made, tmp_path / "m2")
    write(closer.withColumn("labels", F.create_map(
        F.lit("risk"), F.lit("ddos"), F.lit("when"), F.lit("now"), F.lit("instance"), F.lit("z"))),
        tmp_path / "m2")
    q = second.start(stream(spark, tmp_path / "m2", made.schema), str(tmp_path / "cp2"), str(tmp_path / "out"))
    q.awaitTermination(120)
    got = {r["ts"]: r["value"] for r in tables.read_batches(spark, str(tmp_path / "out")).collect()}
    batch = {r["ts"]: r["value"] for r in chain(first, second, lambda m: m)(points).collect()}
    assert got == batch and batch


def test_cluster_status(spark):
    rows = ([(f"s{i}", 0.1, 0.1) for i in range(3)] + [(f"o{i}", 0.2, 0.8 + i / 100) for i in range(3)]
            + [(f"d{i}", 0.9, 0.2 + i / 100) for i in range(4)] + [("b0", 0.6, 0.6)])
    peaks = spark.createDataFrame(rows, "instance string, ddos double, overload double").withColumn(
        "window_start", F.lit(60).cast("long"))
    status = risk.broadness(peaks).first()
    assert status["attack_broadness"] == pytest.approx(5 / 11)
    rep = risk.cluster_report(peaks).first()["report"]
    rep = json.loads(rep)
    assert rep["overloaded"] == {"n": 3, "members": ["o0", "o1", "o2"]} and rep["ddos"]["n"] == 4 and rep["both"]["members"] == ["b0"]
    assert [(c["size"], c["ddos"], c["overload"]) for c in rep["clusters"]][:1] == [(3, 0.1, 0.1)] and rep["clusters"][-1]["size"] == 4
    assert risk.broadness(peaks.where("instance like 's%'")).first()["attack_broadness"] == 0


def test_real_time_uses_arrival(spark, tmp_path):
    rows = spiky(spark, 5)
    job = WindowJob("arrivals", 10, ["sensor"], result=lambda c: c, real_time=True, save=False)
    assert "current_timestamp" in job.closed_in_stream(
        stream(spark, str(tmp_path), rows.schema))._jdf.queryExecution().logical().toString().lower()
    with pytest.raises(ValueError):
        WindowJob("x", 10, ["sensor"], result=lambda c: c).start(rows, "cp")


def test_kafka_options():
    assert kafka.source_options("h", 9092, "a; b")["subscribe"] == "a,b"
    assert kafka.sink_options("h", 1, "t", acks="all") == {
        "kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "all"}
    with pytest.raises(ValueError):
        kafka.source_options("h", 1, ";")
