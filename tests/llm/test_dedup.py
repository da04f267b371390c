import math
import random
import re

import numpy as np
import pytest

from gaugeworks.llm import minmax_dedup, vector_forest
from gaugeworks.llm.links import components
from odd_documents import docs, nothing, texts  # noqa: F401


def shingles(text, width):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(zip(*[words[k:] for k in range(width)])) if len(words) >= width else frozenset([tuple(words)] if words else [])


def least_reachable(ids, linked):
    root = {i: i for i in ids}
    while True:
        before = dict(root)
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return root


def brute_force(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    linked = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k] if x and y and 100 * len(x & y) >= percent * len(x | y)]
    return least_reachable({i for i, _ in sets}, linked)


@pytest.mark.parametrize("width, percent, block", [(3, 85, 128), (5, 80, 2)])
def test_near_duplicates_are_exact(spark, docs, texts, width, percent, block):
    got = minmax_dedup.near_duplicates(docs, width=width, percent=percent, block=block).collect()
    want = brute_force([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], width, percent)
    assert len(got) == docs.count()
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        if r.doc_id is not None:
            assert r.n_shingles == len(shingles(texts[r.doc_id], width))


def test_chains_inside_one_bucket(spark):
    """Neighbours are linked, far ones are not: links between members other than the least one must be found, in blocks, too."""
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**9)}" for _ in range(400)]
    rows = [(i, " ".join(words[i * 8:i * 8 + 200])) for i in range(20)]
    rng.shuffle(rows)
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (1, 3, 128):
        got = {r.doc_id: r.component_id for r in minmax_dedup.near_duplicates(df, width=3, percent=85, rows=1, bands=30, block=block).collect()}
        assert got == brute_force(rows, 3, 85)


def test_empty_table(spark, nothing):
    assert minmax_dedup.near_duplicates(nothing).collect() == []


def test_signature_estimates_the_similarity():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2**63, 1000, np.uint64)
    a, b = np.unique(x[:900]), np.unique(x[100:])
    same = (minmax_dedup.minmax_signature(a, 400) == minmax_dedup.minmax_signature(b, 400)).mean()
    assert same == pytest.approx(0.8, abs=0.06)
    long = rng.integers(0, 2**63, 20_000, np.uint64)
    assert (minmax_dedup.minmax_signature(long, 8) == minmax_dedup.minmax_signature(np.sort(long), 8)).all()


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 160)]
    got = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = least_reachable({x for e in edges for x in e}, edges)
    assert all(got[i] == r for i, r in want.items() if i in got)
    assert all(i in got for i, r in want.items() if r != i)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def vectors(seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(150, 16))
    near = np.concatenate([base[:20] + 0.05 * rng.normal(size=(20, 16)), base[:5] + 0.05 * rng.normal(size=(5, 16))])
    tight = base[40] + 0.01 * rng.normal(size=(60, 16))
    return np.concatenate([base, near, tight, base[7:10], base[7:8], 3 * base[11:12]])


@pytest.mark.parametrize("block", [16, 1024])
def test_vector_links_against_all_pairs(spark, block):
    v = vectors()
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [None] + [1.0] * 15), (1005, [1.0, 2.0]),
           (1006, [2.0, 4.0]), (1007, [float("inf")] * 16), (1008, [1e300] * 16), (1009, [1e300] * 16), (None, v[0].tolist())]
    rows = [(i, x.tolist(), "z") for i, x in enumerate(v)] + [(i, x, None) for i, x in odd]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node string")
    got = {r.vec_id: r for r in vector_forest.vector_links(df, leaf=16, block=block).collect()}
    unit = v / np.linalg.norm(v, axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    linked = [(int(a), int(b)) for a, b in zip(*np.nonzero(close)) if a != b]
    root = least_reachable(range(len(v)), linked)
    assert len(got) == len(rows)
    for i in range(len(v)):
        assert (got[i].n_links, got[i].component_id) == (close[i].sum() - 1, root[i])
    assert [got[i].n_links for i in (1000, 1001, 1002, 1003, 1004, 1007, None)] == [0] * 7
    assert got[1006].component_id == 1005 and got[1009].component_id == 1008 and got[None].component_id is None


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_forest.vector_links(df).collect() == []
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert vector_forest.vector_links(df).collect()[0].n_links == 0


def test_tight_nodes_are_not_split():
    rng = np.random.default_rng(1)
    x = vector_forest.unit(rng.normal(size=(1, 16)) + 1e-4 * rng.normal(size=(500, 16)))
    tree = vector_forest.grow_tree(x, 16, 0.01, rng)
    assert len(tree.left) == 1 and tree.left[0] == -1


def test_forest_finds_links_in_any_dimension():
    rng, c = np.random.default_rng(0), 0.955
    for dim in (16, 64, 768):
        x = vector_forest.unit(rng.normal(size=(1500, dim)))
        y = x[:300]
        z = rng.normal(size=y.shape)
        z = vector_forest.unit(z - (z * y).sum(1)[:, None] * y)
        all_ = np.concatenate([x, c * y + math.sqrt(1 - c * c) * z])
        near = vector_forest.spill_of(dim, 0.95)
        trees = [vector_forest.grow_tree(all_, 64, near, np.random.default_rng((11, t))) for t in range(vector_forest.TREES)]
        rows, codes = vector_forest.Forest(trees, dim, near, 11).codes(all_)
        met = [set() for _ in all_]
        for r, code in zip(rows.tolist(), codes.tolist()):
            met[r].add(code)
        assert np.mean([bool(met[k] & met[1500 + k]) for k in range(300)]) >= 0.99
        assert len(rows) < 25 * len(all_) and all(len(t.left) > 20 for t in trees)


def test_work_per_vector_does_not_grow_with_the_input(spark):
    """Ten times the vectors on trees of the same sample: leaves are split on until they fit a block."""
    rng, block, near = np.random.default_rng(1), 100, vector_forest.spill_of(8, 0.95)
    sample = vector_forest.unit(rng.normal(size=(300, 8)))
    got = {}
    for n in (600, 6000):
        x = vector_forest.unit(rng.normal(size=(n, 8)))
        df = spark.createDataFrame([(v.tolist(),) for v in x], "v array<double>").repartition(4)
        forest = vector_forest.Forest([vector_forest.grow_tree(sample, 64, near, np.random.default_rng(t)) for t in range(3)], 8, near, 5)
        large = vector_forest.deepen(forest, df, block)
        codes = forest.codes(x)[1]
        sizes = np.unique(codes, return_counts=True)[1]
        assert sizes.max() <= block or large
        got[n] = len(codes) / n, float((sizes ** 2).sum()) / n
    assert got[6000][0] < 3 * got[600][0] and got[6000][1] < 3 * got[600][1]
    same = spark.createDataFrame([([1.0, 0.0],)] * 300, "v array<double>")
    tight = vector_forest.Forest([vector_forest.grow_tree(np.ones((4, 2)), 64, near, rng)], 2, near, 5)
    assert list(vector_forest.deepen(tight, same, block).values()) == [300]
