import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import series


@pytest.fixture(scope="module")
def skewed(spark):
    """One series holds most rows and is bunched in time; two are short."""
    rng = np.random.default_rng(3)
    t = np.concatenate([rng.integers(0, 50, 300), rng.integers(0, 5000, 300)])
    pdf = pd.DataFrame({"k": ["hot"] * 600 + ["a"] * 7 + ["b"],
                        "t": np.concatenate([t, np.arange(7), [3]]),
                        "value": rng.normal(size=608).round(3)})
    pdf["id"] = np.arange(len(pdf))
    return spark.createDataFrame(pdf).repartition(5).cache(), pdf.sort_values(["k", "t", "id"])


@pytest.mark.parametrize("target", [None, 1000, 40, 7])
@pytest.mark.parametrize("k", [1, 4, 25])
def test_lags_equal_pandas_shift(skewed, target, k):
    df, pdf = skewed
    got = series.with_lags(df, ["k"], ["t", "id"], "value", k, target).toPandas().set_index("id")["lags"]
    for _, g in pdf.groupby("k"):
        vals = g["value"].tolist()
        for i, row_id in enumerate(g["id"]):
            assert list(got[row_id]) == vals[max(0, i - k):i][::-1]


@pytest.mark.parametrize("target", [None, 40])
def test_running_totals(skewed, target):
    df, pdf = skewed
    got = series.with_running(df, ["k"], ["t", "id"], "value", target).toPandas().set_index("id")
    want_sum = pdf.groupby("k")["value"].cumsum()
    want_n = pdf.groupby("k").cumcount() + 1
    got = got.loc[pdf["id"]]
    assert np.allclose(got["running_sum"], want_sum)
    assert (got["running_count"].to_numpy() == want_n.to_numpy()).all()


def test_split_is_only_made_for_hot_series(skewed):
    df, _ = skewed
    split, hot = series.split_hot(df, ["k"], ["t"], 40)
    assert hot
    chunks = {r["k"]: r["n"] for r in split.groupBy("k").agg(F.count_distinct("_chunk").alias("n")).collect()}
    assert chunks["hot"] > 3 and chunks["a"] == chunks["b"] == 1
    assert not series.split_hot(df, ["k"], ["t"], 5000)[1]


def test_split_holds_under_bursts_and_far_times(spark):
    far = F.when(F.col("id") == 7, 10**15).when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 500)
    df = spark.range(50_000).select(F.lit("k").alias("k"), far.alias("t"), "id")
    split, _ = series.split_hot(df, ["k"], ["t", "id"], 1000)
    assert split.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 2000
    got = series.with_running(df, ["k"], ["t", "id"], target_rows=1000)
    assert got.select("running_count").distinct().count() == 50_000
    ahead = series.with_next(df.select("k", F.col("id").alias("t")), ["k"], "t", 1000)
    assert ahead.where("_next = t + 1").count() == 49_999


def test_lags_keep_null_values(spark):
    df = spark.createDataFrame([("a", i, None if i % 2 else float(i)) for i in range(9)],
                               "k string, t int, value double")
    for target in (None, 3):
        rows = series.with_lags(df, ["k"], ["t"], "value", 2, target).orderBy("t").collect()
        assert rows[4]["lags"] == [None, 2.0]


def test_hot_series_with_a_null_key(spark):
    df = spark.range(900).select(F.when(F.col("id") % 9 == 0, "a").alias("k"), F.when(F.col("id") % 2 == 0, 1).alias("j"),
                                 F.col("id").alias("t"), (F.col("id") % 7).cast("double").alias("value"))
    rows = lambda made: sorted(made.select(sorted(made.columns)).collect(), key=lambda r: r.t)
    for fn in (lambda n: series.with_lags(df, ["k", "j"], ["t"], "value", 3, n), lambda n: series.with_lags(df, ["k", "j"], ["t"], "value", 9, n),
               lambda n: series.with_running(df, ["k", "j"], ["t"], "value", n), lambda n: series.with_page(df, ["k", "j"], ["t"], 10, n),
               lambda n: series.with_next(df, ["k", "j"], "t", n), lambda n: series.difference(df, ["k", "j"], ["t"], "value", n)):
        assert rows(fn(40)) == rows(fn(None))
        assert fn(40).columns == fn(None).columns


def test_difference_and_back(skewed):
    df, pdf = skewed
    d = series.difference(df, ["k"], ["t", "id"], "value", 40)
    back = series.undo_difference(d.where("diff is not null"), ["k"], ["t", "id"], "diff", F.lit(0.0), 40)
    first = pdf.groupby("k")["value"].first()
    got = back.toPandas().set_index("id")["level"]
    for _, row in pdf.iterrows():
        if row["id"] in got.index:
            assert got[row["id"]] == pytest.approx(row["value"] - first[row["k"]], abs=1e-9)


def test_last_points_prune_before_the_shuffle(skewed):
    df, pdf = skewed
    last = series.last_points(df, ["k"], ["t", "id"], 5)
    want = pdf.groupby("k").tail(5)
    assert sorted(r["id"] for r in last.collect()) == sorted(want["id"])
    assert "WindowGroupLimit" in last._jdf.queryExecution().executedPlan().toString()


def test_number_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v")).repartition(6)
    got = series.number_in_order(df, ["v"], "no").collect()
    assert all(r["no"] == r["v"] for r in got)


def test_number_series_first_seen(spark):
    df = spark.createDataFrame([("b", 5), ("a", 9), ("c", 5), ("b", 7), ("a", 1)], "label string, t int")
    got = {r["label"]: r["sensor"] for r in series.number_series(df, "label", "t").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}
