"""Exact marginals of any discrete Bayesian network by variable elimination on factor tables.

A network is a map from node to parents, the number of states of each node, and long probability rows ``node, state, parents, p`` as in
``bayes.cpt_from_tables``. Evidence comes as rows with a column per observed node; a null leaves the node open in that row.
Each distinct row of evidence is solved once: factors that hold observed nodes are joined with the evidence rows and
carry their number from then on, so all rows are eliminated together by joins on shared nodes and sums. The plan depends on
the network and on which columns are null together, never on the number of rows.

Nodes that are neither asked for, nor observed, nor above such nodes sum to 1 and are left out. The others go in min-fill order: the node
whose removal joins the fewest pairs of nodes that no factor holds together yet. The greatest table is as large as the elimination
order makes it for one row of evidence (the states of the largest clique), which is what exact inference costs.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.session import cut

Graph = Mapping[int, Sequence[int]]


@dataclass(frozen=True)
class Factor:
    """A table ``p`` over the open nodes ``over`` (columns ``x<node>``), per evidence row ``_e`` where ``tied``."""

    over: frozenset[int]
    tied: bool
    df: DataFrame

    def columns(self) -> list[str]:
        return ["_e"] * self.tied + [f"x{v}" for v in sorted(self.over)]


def check_network(graph: Graph, sizes: Sequence[int]) -> dict[int, list[int]]:
    """The full parent map of nodes 0 .. len(sizes) - 1; refuses unknown nodes, repeated parents and cycles."""
    full = {v: list(graph.get(v, ())) for v in range(len(sizes))}
    for v, parents in [*full.items(), *((v, graph[v]) for v in graph if v not in full)]:
        if v not in full or any(u not in full for u in parents) or len(set(parents)) != len(parents):
            raise ValueError(f"node {v} or one of its parents {list(parents)} is not in the network")
    left = dict(full)
    while left:
        free = [v for v, parents in left.items() if not any(u in left for u in parents)]
        if not free:
            raise ValueError("the network has a cycle")
        for v in free:
            del left[v]
    return full


def above(graph: Graph, nodes: set[int]) -> set[int]:
    """The nodes with all their ancestors."""
    found, todo = set(), set(nodes)
    while todo:
        v = todo.pop()
        found.add(v)
        todo |= set(graph[v]) - found
    return found


def elimination_order(cliques: Sequence[frozenset[int]], keep: set[int]) -> list[int]:
    """Min-fill order of all nodes of ``cliques`` but ``keep``; ties by the size of the joined table, then by number."""
    near: dict[int, set[int]] = {}
    for clique in cliques:
        for v in clique:
            near.setdefault(v, set()).update(clique - {v})
    order = []
    while left := set(near) - keep:
        def fill(v: int) -> tuple[int, int, int]:
            around = sorted(near[v])
            return sum(b not in near[a] for k, a in enumerate(around) for b in around[k + 1:]), len(around), v
        v = min(left, key=fill)
        for u in near[v]:
            near[u] |= near[v] - {u}
            near[u].discard(v)
        del near[v]
        order.append(v)
    return order


def _product(a: Factor, b: Factor) -> Factor:
    shared = [f"x{v}" for v in sorted(a.over & b.over)] + ["_e"] * (a.tied and b.tied)
    joined = a.df.join(b.df.withColumnRenamed("p", "_q"), shared)
    out = Factor(a.over | b.over, a.tied or b.tied, joined)
    return Factor(out.over, out.tied, joined.select(*out.columns(), (F.col("p") * F.col("_q")).alias("p")))


def _without(factor: Factor, node: int) -> Factor:
    out = Factor(factor.over - {node}, factor.tied, factor.df)
    return Factor(out.over, out.tied, factor.df.groupBy(*out.columns()).agg(F.sum("p").alias("p")))


def _factor(cpt: DataFrame, node: int, parents: Sequence[int], rows: DataFrame, seen: Mapping[int, str]) -> Factor:
    """Table of one node, cut down to the evidence."""
    table = cpt.where(F.col("node") == node).select(
        F.col("state").alias(f"x{node}"), *[F.col("parents")[k].alias(f"x{u}") for k, u in enumerate(parents)], "p")
    held = [v for v in (node, *parents) if v in seen]
    over = frozenset((node, *parents)) - set(held)
    if held:
        table = table.join(rows.select("_e", *[F.col(seen[v]).alias(f"x{v}") for v in held]), [f"x{v}" for v in held])
    out = Factor(over, bool(held), table)
    return Factor(over, bool(held), table.select(*out.columns(), "p"))


def _marginal(graph: Graph, cpt: DataFrame, rows: DataFrame, seen: Mapping[int, str], target: int, states: int) -> DataFrame:
    """``_e, node, state, p`` of one open node for evidence rows in which just the nodes ``seen`` are observed."""
    used = above(graph, {target, *seen})
    factors = [_factor(cpt, v, graph[v], rows, seen) for v in sorted(used)]
    for v in elimination_order([f.over for f in factors], {target}):
        with_v = [f for f in factors if v in f.over]
        factors = [f for f in factors if v not in f.over] + [_without(reduce(_product, with_v), v)]
    # What is left holds the target, or is a number per evidence row; a plain number is 1.
    state = F.explode(F.sequence(F.lit(0), F.lit(states - 1))).alias(f"x{target}")
    weight = rows.select("_e", state).withColumn("p", F.lit(1.0))
    for f in factors:
        if f.over or f.tied:
            joined = weight.join(f.df.withColumnRenamed("p", "_q"), f.columns(), "left")
            weight = joined.select("_e", f"x{target}", (F.col("p") * F.coalesce("_q", F.lit(0.0))).alias("p"))
    total = weight.groupBy("_e").agg(F.sum("p").alias("_t"))
    return weight.join(total, "_e").select("_e", F.lit(target).alias("node"), F.col(f"x{target}").alias("state"),
                                           F.try_divide("p", "_t").alias("p"))


def marginals(evidence: DataFrame, graph: Graph, sizes: Sequence[int], cpt: DataFrame, observed: Mapping[int, str],
              targets: Sequence[int]) -> DataFrame:
    """``P(node = state | evidence)`` for each distinct row of evidence: its columns, ``node``, ``state``, ``p``.

    ``observed`` names the evidence column of a node. A column may be null: the node is summed over then. A target that is observed has
    probability 1 at its state. Evidence that the network rules out gives null.
    """
    full = check_network(graph, sizes)
    cols = list(dict.fromkeys(observed.values()))
    rows = cut(evidence.select(*cols).distinct().withColumn("_e", F.monotonically_increasing_id()))
    open_ = F.concat_ws(",", *[F.when(F.col(c).isNotNull(), F.lit(str(v))) for v, c in observed.items()]).alias("_seen")
    # At most one pattern per subset of the observed nodes, whatever the rows.
    patterns = sorted(r["_seen"] for r in rows.select(open_).distinct().collect())
    cpt, out = cut(cpt.select(F.col("node").cast("int"), F.col("state").cast("int"), F.col("parents").cast("array<int>"), F.col("p").cast("double"))), []
    for pattern in patterns:
        seen = {int(v): observed[int(v)] for v in pattern.split(",") if v}
        here = rows.withColumn("_seen", open_).where(F.col("_seen") == pattern).drop("_seen")
        for t in targets:
            if t in seen:
                state = F.explode(F.sequence(F.lit(0), F.lit(sizes[t] - 1)))
                out.append(here.select("_e", F.lit(t).alias("node"), state.alias("state"), F.col(seen[t]).alias("_s"))
                           .select("_e", "node", "state", (F.col("state") == F.col("_s")).cast("double").alias("p")))
            else:
                out.append(_marginal(full, cpt, here, seen, t, sizes[t]))
    empty = rows.select("_e", F.lit(0).alias("node"), F.lit(0).alias("state"), F.lit(0.0).alias("p")).where("false")
    return rows.join(reduce(DataFrame.unionByName, out, empty), "_e").select(*cols, "node", "state", "p")


def evaluate(evidence: DataFrame, graph: Graph, sizes: Sequence[int], cpt: DataFrame, observed: Mapping[int, str],
             targets: Sequence[int]) -> DataFrame:
    """``evidence`` with a column ``p<node>`` per target: the probabilities of its states, in order."""
    cols = list(dict.fromkeys(observed.values()))
    solved = marginals(evidence, graph, sizes, cpt, observed, targets)
    lists = solved.groupBy(*cols).agg(*[
        F.transform(F.array_sort(F.collect_list(F.when(F.col("node") == t, F.struct("state", "p")))), lambda s: s["p"]).alias(f"p{t}")
        for t in targets])
    same = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_of_{c}`")) for c in cols])
    return evidence.join(lists.withColumnsRenamed({c: f"_of_{c}" for c in cols}), same, "left").drop(*[f"_of_{c}" for c in cols])


def table_cells(graph: Graph, sizes: Sequence[int], observed: set[int], target: int) -> int:
    """Cells of the greatest table that elimination makes for one row of evidence."""
    full = check_network(graph, sizes)
    used = above(full, {target, *observed})
    sets, most = [frozenset((v, *full[v])) - observed for v in used], 1
    for v in elimination_order(sets, {target}):
        joined = frozenset().union(*[s for s in sets if v in s])
        most = max(most, math.prod(sizes[u] for u in joined))
        sets = [s for s in sets if v not in s] + [joined - {v}]
    return most
