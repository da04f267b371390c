import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import outliers, rbf, resample


def long_totals(spark, n=430):
    rng = np.random.default_rng(2)
    rows = [("a", 10 * i, float(v)) for i, v in enumerate(rng.normal(size=n))] + [("b", 10 * i, float(i)) for i in range(7)]
    rows += [(None, 10 * i, float(v)) for i, v in enumerate(rng.normal(size=215))]
    return spark.createDataFrame(rows, "k string, bucket long, total double").repartition(5)


# Not commutative: a stretch keeps a share of what was before it and adds a sum of its own.
SMOOTH = {
    "start": lambda: F.struct(F.lit(1.0).alias("keep"), F.lit(0.0).alias("add")),
    "step": lambda a, x: F.struct((a["keep"] * 0.9).alias("keep"), (a["add"] * 0.9 + x).alias("add")),
    "emit": lambda a: a["add"],
    "merge": lambda a, b: F.struct((a["keep"] * b["keep"]).alias("keep"), (a["add"] * b["keep"] + b["add"]).alias("add"))}


@pytest.mark.parametrize("merge,chunk", [(True, 10_000), (False, 10_000), (True, 100), (False, 100), (True, 5)])
def test_fold_in_chunks_equals_plain_fold(spark, merge, chunk):
    totals = long_totals(spark)
    out = resample.fold_buckets(totals, ["k"], SMOOTH["start"](), SMOOTH["step"], SMOOTH["emit"],
                                SMOOTH["merge"] if merge else None, chunk_rows=chunk)
    got = {(r["k"], r["bucket"]): r["value"] for r in out.collect()}
    want = {}
    for k, part in totals.toPandas().groupby("k", dropna=False):
        acc = 0.0
        for b, x in part.sort_values("bucket")[["bucket", "total"]].itertuples(index=False):
            acc = acc * 0.9 + x
            want[(k if isinstance(k, str) else None, b)] = acc
    assert got == pytest.approx(want)


def test_fold_keeps_arrays_within_a_chunk(spark):
    chunks = resample._chunks(resample.with_page(long_totals(spark), ["k"], ["bucket"], 100, name="_chunk"), ["k"])
    assert chunks.agg(F.max(F.size("_items"))).first()[0] == 100 and chunks.count() == 5 + 1 + 3


def test_resample_computes_its_sums_once(spark):
    df = spark.createDataFrame([("a", 5, 1.0), ("a", 95, 2.0), (None, 7, 3.0)], "k string, s long, value double").withColumn(
        "ts", F.timestamp_seconds("s"))
    for target in (None, 3, 1000):
        rows = resample.resample(df, ["k"], 10, F.col("value"), target_rows=target).orderBy("k", "bucket").collect()
        assert [r["value"] for r in rows] == [3.0, 1.0, 0.5, 0.333, 0.25, 0.2, 0.167, 0.143, 0.125, 0.111, 0.3]
    assert "Aggregate" not in resample.resample(df, ["k"], 10)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("kind", ["narrow", "wide", "two", "even"])
def test_median_by_selection(spark, kind):
    rng = np.random.default_rng(1)
    vals = {"narrow": 1e6 + rng.uniform(0, 1000, 20_001), "wide": np.exp(rng.uniform(-300, 300, 20_001)) * rng.choice([-1, 1], 20_001),
            "two": np.concatenate([1e6 + rng.uniform(0, 1e-3, 5001), 2e6 + rng.uniform(0, 1e-3, 5001)]), "even": np.arange(10_000.0)}[kind]
    pdf = pd.DataFrame({"k": ["x"] * len(vals) + [None] * 9, "value": [*vals, *range(9)]})
    counts = outliers.value_counts(spark.createDataFrame(pdf, "k string, value double"), ["k"], "value")
    got = {r["k"]: r["median"] for r in outliers.median(counts, ["k"], "value", large=True, target_rows=300).collect()}
    assert got[None] == 4.0 and got["x"] == pytest.approx(np.median(vals), rel=1e-15)
    open_, settled = outliers.narrowed(counts, ["k"], "value", 300)
    left = open_.groupBy("k").count().collect()
    assert all(r["count"] <= 300 for r in left) and len(left) + settled.count() == 1


def test_support_vectors_meet_their_optimality_conditions(spark):
    rng = np.random.default_rng(3)
    n, size = 40, 95
    t = -np.tile(np.arange(size, dtype=float), (n, 1))
    inside = np.arange(size) < rng.integers(1, size + 1, n)[:, None]
    y = rng.normal(size=(n, size)) * rng.choice([0.05, 1, 60], n)[:, None] * inside
    for c, eps, tol in ((20.0, 0.1, 1e-3), (1.0, 0.0, 1e-3), (20.0, 0.5, 1e-2)):
        beta = rbf.support_weights(t, y, np.ones_like(t), inside, 0.125, c, eps, tol)
        k = np.exp(-0.125 * (t[:, :, None] - t[:, None, :]) ** 2)
        residual = y - np.einsum("bij,bj->bi", k, beta)
        assert (np.abs(beta) <= c).all() and (beta[~inside] == 0).all()
        free, low, high = (np.abs(beta) < c) & (beta != 0) & inside, (beta == 0) & inside, (np.abs(beta) == c) & inside
        assert (np.abs(residual[low]) <= eps + tol + 1e-9).all()
        assert np.abs(residual[free] - eps * np.sign(beta[free])).max(initial=0) <= tol + 1e-9
        assert (residual[high] * np.sign(beta[high]) >= eps - tol - 1e-9).all()
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(rng.normal(size=300))] + [("b", 0, 7.0)], "k string, t long, value double")
    got = {(r["k"], r["h"]): r["forecast"] for r in rbf.support_forecast(df, ["k"], ["t"], n=90).collect()}
    assert len(got) == 180 and got[("b", 3)] == 7.0
    assert got[("a", 90)] == pytest.approx(df.where("k = 'a'").agg(F.avg("value")).first()[0])
