import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import bayes, dbscan
from gaugeworks.operators.components import components


def plain_dbscan(pdf, r, n):
    xy = pdf[["x", "y"]].to_numpy()
    dx, dy = xy[:, None, 0] - xy[None, :, 0], xy[:, None, 1] - xy[None, :, 1]
    near = dx * dx + dy * dy <= r * r
    core = near.sum(axis=1) >= n
    label = np.where(core, pdf["id"], np.inf)
    while True:
        new = label.copy()
        for i in np.flatnonzero(core):
            new[i] = label[near[i] & core].min()
        if (new == label).all():
            break
        label = new
    for i in np.flatnonzero(~core):
        label[i] = label[near[i] & core].min() if (near[i] & core).any() else np.inf
    order = {v: i + 1 for i, v in enumerate(sorted(set(label[np.isfinite(label)])))}
    return {i: order.get(v, 0) for i, v in zip(pdf["id"], label)}, dict(zip(pdf["id"], core))


def cloud(kind, seed=0):
    rng = np.random.default_rng(seed)
    if kind == "uniform":
        xy = rng.uniform(0, 3, (400, 2))
    elif kind == "one hot cell":
        xy = np.vstack([rng.normal(1, 0.02, (300, 2)), rng.uniform(0, 2, (60, 2)), np.full((50, 2), 1.7)])
    elif kind == "chain":
        xy = np.column_stack([np.arange(120) * 0.19, np.zeros(120)])
    else:  # dense strips at a distance close to r, so that bounding boxes do not decide at once
        a = np.column_stack([rng.uniform(0, 0.3, 80), rng.uniform(0, 1, 80)])
        gap = {"strips apart": 0.2001, "strips touching": 0.1999}[kind]
        b = a[:60] * [-1, 1] + [-gap, 0]
        xy = np.vstack([a * [1, 1], b])
        xy[0], xy[80] = [0.0, 0.5], [-gap, 0.5]
    return pd.DataFrame({"id": rng.permutation(len(xy)), "x": xy[:, 0], "y": xy[:, 1]})


@pytest.mark.parametrize("kind", ["uniform", "one hot cell", "chain", "strips apart", "strips touching"])
def test_dbscan_equals_plain(spark, kind):
    pdf = cloud(kind)
    want, core = plain_dbscan(pdf, 0.2, 4 if kind == "one hot cell" else 3)
    n = 4 if kind == "one hot cell" else 3
    df = spark.createDataFrame(pdf).repartition(3)
    flags = dbscan.core_flags(dbscan.locations(df, [], 0.2), [], 0.2, n)
    got_core = {(r["x"], r["y"]): r["core"] for r in flags.collect()}
    assert all(got_core[(p.x, p.y)] == core[p.id] for p in pdf.itertuples())
    assert {r["id"]: r["cluster"] for r in dbscan.dbscan(df, 0.2, n).collect()} == want


def test_dbscan_per_key(spark):
    a, b = cloud("uniform", 1)[:150], cloud("one hot cell", 2)[:200]
    df = spark.createDataFrame(pd.concat([a.assign(k="a"), b.assign(k="b")]).assign(
        id=lambda d: d["k"] + d["id"].astype(str).str.zfill(5)))
    got = dbscan.dbscan(df, 0.2, 3, keys=["k"], numbered=False).toPandas()
    for k, pdf in (("a", a), ("b", b)):
        want, _ = plain_dbscan(pdf, 0.2, 3)
        part = got[got["k"] == k]
        mine = dict(zip(part["id"].str[1:].astype(int), part["cluster"]))
        groups = {}
        for i, c in want.items():
            groups.setdefault(c, set()).add(mine[i])
        assert all(len(v) == 1 for v in groups.values())
        assert len({next(iter(v)) for v in groups.values()}) == len(groups)


def test_components(spark):
    nodes = spark.range(60).select("id")
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 19] + [(50, 59)], "a long, b long")
    got = {r["id"]: r["label"] for r in components(nodes, edges).collect()}
    assert all(got[i] == 0 for i in range(20)) and all(got[i] == 20 for i in range(20, 41))
    assert got[59] == got[50] == 50 and got[45] == 45


def random_cpt(spark, seed=0, states=(2, 3, 5, 5, 5, 2, 2)):
    rng = np.random.default_rng(seed)
    parents = {0: [1, 2, 3, 4], 1: [5, 6], 2: [5, 6], 3: [5, 6], 4: [5, 6], 5: [], 6: []}
    table = {}
    for node, ps in parents.items():
        for combo in itertools.product(*[range(states[p]) for p in ps]):
            p = rng.dirichlet(np.ones(states[node]))
            for s in range(states[node]):
                table[(node, s, combo)] = float(p[s])
    rows = [(k[0], k[1], list(k[2]), p) for k, p in table.items()]
    return spark.createDataFrame(rows, "node int, state int, parents array<int>, p double"), table


def test_bayes_equals_enumeration(spark):
    cpt, table = random_cpt(spark)
    ev = [(0, 1, 4, 2), (2, 0, 0, 0), (1, 3, 3, 3)]
    df = spark.createDataFrame(ev, "s1 int, s2 int, s3 int, s4 int")
    for r in bayes.score(df, cpt).collect():
        e = (r["s1"], r["s2"], r["s3"], r["s4"])
        w = {(a, b): table[(5, a, ())] * table[(6, b, ())] * np.prod(
            [table[(i + 1, e[i], (a, b))] for i in range(4)]) for a in (0, 1) for b in (0, 1)}
        assert r["p_ddos"] == pytest.approx((w[1, 0] + w[1, 1]) / sum(w.values()))
        assert r["p_overload"] == pytest.approx((w[0, 1] + w[1, 1]) / sum(w.values()))
        assert r["p_crash"] == pytest.approx(table[(0, 1, e)])


def test_bayes_tables_are_checked(spark):
    raw = spark.createDataFrame([(5, {"0": 0.5, "1": 0.6}), (1, {"0,0,0": 0.25, "1,0,0": 0.75})],
                                "node int, table map<string,double>")
    cpt = bayes.cpt_from_tables(raw)
    assert [r["node"] for r in bayes.bad_columns(cpt).collect()] == [5]
    with pytest.raises(ValueError):
        bayes.refuse_bad(cpt)
    assert bayes.bad_columns(bayes.normalised(cpt)).isEmpty()
    assert {r["state"]: r["parents"] for r in cpt.where("node = 1").collect()} == {0: [0, 0], 1: [0, 0]}
