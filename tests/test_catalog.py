"""Every registered query against its oracle on the smallest tables."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from conftest import SF
from oracle import connect, differs

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
# No cluster exists among the few users of the smallest tables.
EMPTY_AT_SMALLEST = {"e16_cluster_centroids", "g5_clusters_by_size"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    bad = differs(spark, con, QUERIES[name], ORACLES.get(name), SF)
    assert bad is None or (name in EMPTY_AT_SMALLEST and bad in ("both empty", "no rows"))


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["sensor", "label", "bucket", "total", "value"] and df.count() > 0


@pytest.mark.parametrize("name", ["k5_lag_sums", "k1_mad_outliers", "f3_running_totals"])
def test_result_does_not_depend_on_partitions(spark, name, monkeypatch):
    from catalog import analytics, base, grouping
    plain = sorted(map(str, QUERIES[name](spark, SF).collect()))
    module = grouping if name.startswith("f3") else analytics
    for n in (1, 8):
        monkeypatch.setattr(module, "readings", lambda s, sf: base.readings(s, sf).repartition(n, F.rand(n)))
        assert sorted(map(str, QUERIES[name](spark, SF).collect())) == plain
