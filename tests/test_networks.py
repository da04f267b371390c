import itertools

import numpy as np
import pytest

from gaugeworks.operators import network

# A network of six nodes, and one whose nodes all hang together.
SIX = {0: [1, 2], 1: [4], 2: [4, 5], 3: [2], 4: [], 5: []}
SIX_SIZES = [2, 3, 2, 4, 2, 3]
CHAIN = {v: [v - 1] for v in range(1, 9)}


def tables(spark, graph, sizes, seed):
    rng, table = np.random.default_rng(seed), {}
    for v in range(len(sizes)):
        for combo in itertools.product(*[range(sizes[u]) for u in graph.get(v, [])]):
            p = rng.dirichlet(np.ones(sizes[v]))
            table |= {(v, s, combo): float(p[s]) for s in range(sizes[v])}
    rows = [(v, s, list(c), p) for (v, s, c), p in table.items()]
    return spark.createDataFrame(rows, "node int, state int, parents array<int>, p double"), table


def enumerated(graph, sizes, table, seen, target):
    out = np.zeros(sizes[target])
    for x in itertools.product(*map(range, sizes)):
        if all(x[v] == s for v, s in seen.items()):
            out[x[target]] += np.prod([table[(v, x[v], tuple(x[u] for u in graph.get(v, [])))] for v in range(len(sizes))])
    return (out / out.sum()).tolist() if out.sum() else [None] * sizes[target]


@pytest.mark.parametrize("graph,sizes", [(SIX, SIX_SIZES), (CHAIN, [2, 3, 2, 2, 3, 2, 2, 2, 2])])
def test_marginals_equal_enumeration(spark, graph, sizes):
    cpt, table = tables(spark, graph, sizes, 1)
    rows = [(0, None, 2), (1, 1, None), (None, None, None), (0, 0, 0), (0, 0, 0), (None, 1, None)]
    ev = spark.createDataFrame(rows, "a int, b int, c int")
    observed = {0: "a", 2: "b", 1: "c"}
    got = network.evaluate(ev, graph, sizes, cpt, observed, [5, 4, 3, 0]).collect()
    assert len(got) == len(rows)
    for r in got:
        seen = {v: r[c] for v, c in observed.items() if r[c] is not None}
        for t in (5, 4, 3, 0):
            assert r[f"p{t}"] == pytest.approx(enumerated(graph, sizes, table, seen, t))


def test_impossible_evidence_is_null(spark):
    graph, sizes = {1: [0]}, [2, 2]
    rows = [(0, 0, [], 1.0), (0, 1, [], 0.0), (1, 0, [0], 1.0), (1, 1, [0], 0.0), (1, 0, [1], 0.5), (1, 1, [1], 0.5)]
    cpt = spark.createDataFrame(rows, "node int, state int, parents array<int>, p double")
    ev = spark.createDataFrame([(1,), (0,), (7,)], "s int")
    got = {r["s"]: r["p0"] for r in network.evaluate(ev, graph, sizes, cpt, {1: "s"}, [0]).collect()}
    assert got == {1: [None, None], 0: [1.0, 0.0], 7: [None, None]}
    assert network.marginals(ev.where("false"), graph, sizes, cpt, {1: "s"}, [0]).count() == 0


def test_networks_are_checked():
    with pytest.raises(ValueError, match="cycle"):
        network.check_network({0: [1], 1: [0]}, [2, 2])
    for bad in ({0: [5]}, {9: []}, {0: [1, 1]}):
        with pytest.raises(ValueError, match="not in the network"):
            network.check_network(bad, [2, 2])


def test_elimination_is_cheap_where_the_network_is():
    chain = {v: [v - 1] for v in range(1, 40)}
    assert network.table_cells(chain, [3] * 40, {39}, 0) == 9
    tree = {v: [(v - 1) // 3] for v in range(1, 40)}
    assert network.table_cells(tree, [4] * 40, set(range(20, 40)), 7) <= 16
    ring = {1: [0], 2: [1], 3: [2, 0]}
    assert network.elimination_order([frozenset((v, *ring.get(v, []))) for v in range(4)], {0}) in ([1, 2, 3], [2, 1, 3], [2, 3, 1])
