"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the space by random hyperplanes at the median of a node; a vector close to a hyperplane goes to
both sides. How close is measured by the spread that the difference of two linked vectors has along a random direction,
``sqrt(2 (1 - least) / dimension)``, so trees are alike in any dimension. The upper trees are fitted on a sample of at most ``sample``
vectors (``trees * sample / leaf * 2`` hyperplanes); every vector is indexed. Their leaves grow with the input, so leaves beyond a
block are split further by the workers: one seeded direction a tree and level, at the median of a counted histogram of the
whole leaf, level by level until they fit a block. So the comparisons of a vector do not grow with the input. A leaf that is too tight to
be split is compared in blocks. The model holds a number per split leaf, ``SPLITS`` at most (32 MB); beyond that, which takes
some hundred million vectors, leaves are several blocks. Vectors of one leaf are compared in double
precision, all against all in blocks of bounded size, so a leaf of any size is compared completely. A pair that meets in several
leaves counts in the first of them only, so no list of pairs is needed to count links: a block gives counts per
vector and one chain of links per connected part.

Copies (equal vectors) are one node with a number of members. Defined cases: vectors that are null, empty, zero or hold a
null or non-finite component, and rows without an id, have no link; vectors of different length are never compared; rows with one id are vectors
of one component, and each counts the links of all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.links import components
from gaugeworks.session import cut

TREES, LEAF, SPILL, SAMPLE, BLOCK = 10, 64, 0.3, 20_000, 1024
DEEP, SPLITS = 22, 2_000_000
_PATH = 24
#: A node of which more than this share would go to both sides is not split.
MOST_SPILLED = 0.4


@dataclass
class Tree:
    """Nodes in preorder: hyperplane row, threshold and children; a leaf has no children (-1)."""
    plane: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaves(self, x: np.ndarray, spill: float) -> tuple[np.ndarray, np.ndarray]:
        """``(row, leaf)`` of every leaf that each row reaches."""
        rows, at = np.arange(len(x)), np.zeros(len(x), np.int64)
        done_rows, done_at = [], []
        while len(rows):
            leaf = self.left[at] < 0
            done_rows.append(rows[leaf])
            done_at.append(at[leaf])
            rows, at = rows[~leaf], at[~leaf]
            gap = np.einsum("ij,ij->i", x[rows], self.plane[at]) - self.cut[at]
            go_left, go_right = gap <= spill, gap > -spill
            rows, at = (np.concatenate([rows[go_left], rows[go_right]]),
                        np.concatenate([self.left[at[go_left]], self.right[at[go_right]]]))
        return np.concatenate(done_rows), np.concatenate(done_at)


def grow_tree(x: np.ndarray, leaf: int, spill: float, rng: np.random.Generator) -> Tree:
    """A tree over sample rows; nodes of at most ``leaf`` rows, and nodes too tight for the spill, are leaves."""
    plane, threshold, left, right = [], [], [], []

    def add(rows: np.ndarray) -> int:
        me = len(plane)
        line = rng.standard_normal(x.shape[1])
        line /= np.linalg.norm(line)
        plane.append(line)
        threshold.append(0.0)
        left.append(-1)
        right.append(-1)
        todo.append((me, rows))
        return me

    todo: list[tuple[int, np.ndarray]] = []
    add(np.arange(len(x)))
    while todo:
        me, rows = todo.pop()
        if len(rows) <= leaf:
            continue
        along = x[rows] @ plane[me]
        threshold[me] = float(np.median(along))
        side = along <= threshold[me]
        if side.all() or (np.abs(along - threshold[me]) <= spill).mean() > MOST_SPILLED:
            continue
        left[me], right[me] = add(rows[side]), add(rows[~side])
    return Tree(np.array(plane), np.array(threshold), np.array(left), np.array(right))


class Forest:
    """Trees, and below their leaves the splits that were counted on all vectors.

    A code names a leaf: tree, leaf of the tree, and the path below it (1, then a bit per split).
    """

    def __init__(self, trees: list[Tree], dim: int, spill: float, seed: int):
        self.trees, self.spill = trees, spill
        lines = np.random.default_rng((seed, len(trees), dim)).standard_normal((len(trees), DEEP, dim))
        self.lines = lines / np.linalg.norm(lines, axis=2, keepdims=True)
        self.split, self.cuts = np.zeros(0, np.int64), np.zeros(0)

    def add(self, codes: np.ndarray, cuts: np.ndarray) -> None:
        codes, cuts = np.concatenate([self.split, codes]), np.concatenate([self.cuts, cuts])
        order = np.argsort(codes)
        self.split, self.cuts = codes[order], cuts[order]

    def along(self, x: np.ndarray, rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Place of rows along the direction that splits their leaf."""
        level = np.floor(np.log2(codes & (1 << _PATH) - 1)).astype(np.int64)
        tree, out = codes >> 2 * _PATH, np.empty(len(rows))
        for k, d in set(zip(tree.tolist(), level.tolist())):
            here = (tree == k) & (level == d)
            out[here] = x[rows[here]] @ self.lines[k, d]
        return out

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, code)`` of every leaf that each row reaches."""
        met = [t.leaves(x, self.spill) for t in self.trees]
        rows = np.concatenate([m[0] for m in met])
        codes = np.concatenate([(k << _PATH | m[1]) << _PATH | 1 for k, m in enumerate(met)])
        done = []
        while len(rows):
            at = np.searchsorted(self.split, codes)
            hit = np.zeros(len(codes), bool)
            inside = at < len(self.split)
            hit[inside] = self.split[at[inside]] == codes[inside]
            done.append((rows[~hit], codes[~hit]))
            rows, codes, at = rows[hit], codes[hit], at[hit]
            gap = self.along(x, rows, codes) - self.cuts[at]
            left, right = gap <= self.spill, gap > -self.spill
            path = codes & (1 << _PATH) - 1
            rows, codes = np.concatenate([rows[left], rows[right]]), np.concatenate([(codes + path)[left], (codes + path + 1)[right]])
        return np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])


def spill_of(dim: int, least: float, spill: float = SPILL) -> float:
    """Distance from a hyperplane within which a unit vector goes to both sides."""
    return spill * float(np.sqrt(2.0 * (1.0 - min(least, 1.0)) / dim)) + 1e-12


def middle_of(bins: np.ndarray, counts: np.ndarray, width: float, spill: float) -> float | None:
    """Threshold at the middle of a histogram; none where a split would leave too much on both sides."""
    order = np.argsort(bins)
    bins, counts = bins[order], counts[order]
    half = int(np.searchsorted(np.cumsum(counts), counts.sum() / 2))
    at = (bins[half] + 1) * width
    near = np.abs((bins + 0.5) * width - at) <= spill + width / 2
    below = counts[bins < bins[half] + 1].sum()
    return None if below == counts.sum() or counts[near].sum() > MOST_SPILLED * counts.sum() else float(at)


def deepen(forest: Forest, nodes: DataFrame, block: int) -> dict[int, int]:
    """Split leaves beyond a block, level by level; the number of vectors in each leaf that stays beyond it."""
    context, width = nodes.sparkSession.sparkContext, forest.spill / 4

    def tally(pick, shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x = _unit(b.column(0))
                    rows, codes = shared.value.codes(x)
                    if pick is None:
                        codes, n = np.unique(codes, return_counts=True)
                        bins = np.zeros(len(codes), np.int64)
                    else:
                        kept = np.isin(codes, pick)
                        rows, codes = rows[kept], codes[kept]
                        bins = np.floor(shared.value.along(x, rows, codes) / width).astype(np.int64)
                        (codes, bins), n = np.unique(np.stack([codes, bins]), axis=1, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(bins), pa.array(n)], ["code", "bin", "n"])

        rows = nodes.select("v").mapInArrow(run, "code long, bin long, n long")
        return rows.groupBy("code", "bin").agg(F.sum("n").alias("n"))

    def middle(pdf: pd.DataFrame) -> pd.DataFrame:
        at = middle_of(pdf["bin"].to_numpy(), pdf["n"].to_numpy(), width, spill)
        return pd.DataFrame({"code": pdf["code"].iloc[:1], "at": [at]}).astype({"at": "float64"})

    spill, tight = forest.spill, set()
    while True:
        # At most one row per leaf of the model; a histogram has a bounded number of bins and stays on the workers.
        large = {r.code: r.n for r in tally(None, context.broadcast(forest)).where(F.col("n") > block).select("code", "n").collect()}
        open_ = sorted(c for c in large if c not in tight and (c & (1 << _PATH) - 1) < 1 << DEEP - 1)
        if not open_ or len(forest.split) + len(open_) > SPLITS:
            return large
        cuts = tally(np.array(open_), context.broadcast(forest)).groupBy("code").applyInPandas(middle, "code long, at double").collect()
        good = [(r.code, r.at) for r in cuts if r.at is not None and not np.isnan(r.at)]
        tight.update(set(open_) - {c for c, _ in good})
        if good:
            forest.add(*(np.array(c) for c in zip(*good)))


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision; scaled first, so that no square over- or underflows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit(flat.reshape(len(column), -1)) if len(column) else np.zeros((0, 1))


def unit(x: np.ndarray) -> np.ndarray:
    if not x.size:
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def vector_links(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.95, trees: int = TREES,
                 leaf: int = LEAF, spill: float = SPILL, sample: int = SAMPLE, block: int = BLOCK, seed: int = 11) -> DataFrame:
    """``vec_id, n_links, component_id``: one row per row of ``vectors``; links are pairs with a cosine of at least ``least``."""
    v = F.col("v")
    rows = cut(vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{embedding}`").alias("v")))
    inf = float("inf")
    sound = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (x == inf) | (x == -inf)) & F.exists(v, lambda x: x != 0)
    nodes = cut(rows.where(sound & F.col("vec_id").isNotNull()).groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("members"))
                .withColumn("dim", F.size("v")))
    parts = [_links_of(nodes.where(F.col("dim") == d), least, trees, leaf, spill, sample, block, seed)
             for d in sorted(r[0] for r in nodes.select("dim").distinct().collect())]
    usable = F.coalesce(sound & F.col("vec_id").isNotNull(), F.lit(False))
    named = (rows.where(usable).withColumnRenamed("v", "_v")
             .join(nodes, (F.col("_v") == F.col("v")), "left").select("vec_id", "node", "members"))
    none = [F.lit(None).cast("long").alias(c) for c in ("node", "members")]
    named = named.unionByName(rows.where(~usable).select("vec_id", *none))
    if not parts:
        return named.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    counts, links = parts[0]
    for more_counts, more_links in parts[1:]:
        counts, links = counts.unionByName(more_counts), links.unionByName(more_links)
    counts = counts.groupBy(F.col("node").alias("_n")).agg(F.sum("linked").alias("linked"))
    copies = named.where("vec_id <> node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    roots = components(links.union(copies)).select(F.col("id").alias("_id"), "root")
    return (named.join(counts, F.col("node") == F.col("_n"), "left").join(roots, F.col("vec_id") == F.col("_id"), "left")
            .select("vec_id", (F.coalesce("linked", F.lit(0)) + F.coalesce(F.col("members") - 1, F.lit(0))).alias("n_links"),
                    F.coalesce("root", "vec_id").alias("component_id")))


def _links_of(nodes: DataFrame, least: float, trees: int, leaf: int, spill: float, sample: int, block: int,
              seed: int) -> tuple[DataFrame, DataFrame]:
    """``(node, linked)`` and ``(a, b)`` among the distinct vectors of one length."""
    total = nodes.count()
    pick = nodes if total <= sample else nodes.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < int(1_000_000 * sample / total))
    x = unit(np.array([r[0] for r in pick.select("v").orderBy("node").limit(sample).collect()], np.float64))
    context, near = nodes.sparkSession.sparkContext, spill_of(x.shape[-1], least, spill)
    grown = Forest([grow_tree(x, leaf, near, np.random.default_rng((seed, t))) for t in range(trees)], x.shape[-1], near, seed)
    blocks = context.broadcast({code: -(-n // block) for code, n in deepen(grown, nodes, block).items()})
    forest = context.broadcast(grown)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each vector once per leaf and per block that it meets there, with all its leaves in order."""
        for b in batches:
            if not b.num_rows:
                continue
            v, node = _unit(b.column(2)), b.column(0).to_numpy()
            rows, leaves = forest.value.codes(v)
            order = np.lexsort((leaves, rows))
            rows, leaves = rows[order], leaves[order]
            ends = np.searchsorted(rows, np.arange(b.num_rows + 1)).astype(np.int32)
            codes = pa.ListArray.from_arrays(ends, pa.array(leaves))
            n = np.fromiter((blocks.value.get(c, 1) for c in leaves.tolist()), np.int64, len(leaves))
            mine = (node.view(np.uint64)[rows] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n
            again = np.repeat(np.arange(len(rows)), n)
            other = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
            at = pa.array(rows[again])
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves[again]), pa.array(np.minimum(mine[again], other)), pa.array(np.maximum(mine[again], other)),
                 pa.array(mine[again]), b.column(0).take(at), b.column(1).take(at), b.column(2).take(at), codes.take(at)],
                ["leaf", "b1", "b2", "own", "node", "members", "v", "codes"])

    kind = nodes.schema["v"].dataType.simpleString()
    dealt = nodes.select("node", "members", "v").mapInArrow(
        assign, f"leaf long, b1 long, b2 long, own long, node long, members long, v {kind}, codes array<long>")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        leaf_, b1, b2 = pdf[["leaf", "b1", "b2"]].iloc[0]
        x = unit(np.stack(pdf["v"].to_numpy()).astype(np.float64))
        node, members, codes, side = pdf["node"].to_numpy(), pdf["members"].to_numpy(), pdf["codes"].to_numpy(), pdf["own"].to_numpy()
        one, two = np.flatnonzero(side == b1), np.flatnonzero(side == b2)
        linked = np.zeros(len(pdf), np.int64)
        i, j = np.nonzero(x[one] @ x[two].T >= least)
        i, j = one[i], two[j]
        if b1 == b2:
            i, j = i[i < j], j[i < j]
        # Codes are sorted, so the first common one of a pair tells the leaf in which it counts.
        width = max(map(len, codes))
        padded = np.full((len(pdf), width), -1, np.int64)
        for r, c in enumerate(codes):
            padded[r, :len(c)] = c
        for k in range(0, len(i), 200_000):
            a, b = i[k:k + 200_000], j[k:k + 200_000]
            first = _first_common(padded[a], padded[b])
            a, b = a[first == leaf_], b[first == leaf_]
            np.add.at(linked, a, members[b])
            np.add.at(linked, b, members[a])
        # Every vector of a connected part is tied to the first one of the part.
        label, last = np.arange(len(pdf)), None
        while last is None or (label != last).any():
            last = label.copy()
            np.minimum.at(label, i, label[j])
            np.minimum.at(label, j, label[i])
            label = label[label]
        tied, got = np.flatnonzero(label != np.arange(len(pdf))), np.flatnonzero(linked)
        return pd.DataFrame({"a": np.concatenate([node[tied], node[got]]), "b": np.concatenate([node[label[tied]], node[got]]),
                             "linked": np.concatenate([np.zeros(len(tied), np.int64), linked[got]])}).astype("int64")

    found = cut(dealt.groupBy("leaf", "b1", "b2").applyInPandas(compare, "a long, b long, linked long"))
    return (found.where("linked > 0").select(F.col("a").alias("node"), "linked"), found.where("linked = 0").select("a", "b"))


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least common code of each pair of rows of sorted codes, padded with -1."""
    out = np.full(len(a), np.iinfo(np.int64).max)
    for k in range(a.shape[1]):
        here = (a[:, k, None] == b).any(axis=1) & (a[:, k] >= 0)
        out = np.where(here, np.minimum(out, a[:, k]), out)
    return out
