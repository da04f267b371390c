"""Near-duplicate documents by min-max hashing.

Every document becomes the set of its distinct word shingles. Each permutation is evaluated once per shingle and gives
two signature values, its minimum and its maximum: both are equal for two documents with probability their Jaccard
similarity, so half as many hash evaluations fill the signature. Bands of the signature give candidates, and every
link is confirmed on the full sets.

Copies (equal sets) are one node from the start. In a bucket of m nodes each node is first compared with the least node
only. Two nodes of a bucket that neither of these comparisons nor any other link has joined are then compared in
blocks; a block holds a bounded number of nodes whatever the bucket, and pairs are never written out.

Defined cases: a null or empty text, or one without words, has an empty set and no link; with fewer words than the
width of a shingle the whole sequence is one shingle. Rows with one ``doc_id`` are one document: the links of each count
for all. Rows with a null ``doc_id`` have no link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.links import components
from gaugeworks.llm.text import map_texts, mix64, shingle_hashes, word_hashes, words_of
from gaugeworks.session import cut

#: Signature values per band, and bands: a pair of similarity 0.85 shares no band with probability 8e-6, one of 0.8 with
#: probability 4e-4.
BAND_ROWS, BANDS = 5, 20
#: Nodes on each side of a block.
BLOCK = 128
#: Bits of the bitmap of nodes: at most 131,072 words are broadcast.
_BITMAP = 2**23
_CHUNK = 8192


def shingle_set(raw: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text, A-Z lower-cased."""
    return np.unique(shingle_hashes(word_hashes(words_of(raw and raw.lower())), width))


def minmax_signature(x: np.ndarray, perms: int, seed: int = 1) -> np.ndarray:
    """Minimum and maximum of a non-empty set of 64-bit values under each of ``perms`` permutations, interleaved."""
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 2**63, perms, np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, perms, np.uint64)
    low, high = np.full(perms, 2**64 - 1, np.uint64), np.zeros(perms, np.uint64)
    for k in range(0, len(x), _CHUNK):
        h = x[k:k + _CHUNK, None] * a + b
        np.minimum(low, h.min(axis=0), out=low)
        np.maximum(high, h.max(axis=0), out=high)
    return np.stack([low, high], axis=1).ravel()


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    """One key per band; the number of the band is part of it."""
    key = np.arange(1, bands + 1, dtype=np.uint64)
    for column in signature[:rows * bands].reshape(bands, rows).T:
        key = mix64(key + column)
    return key.view(np.int64)


def sketches(docs: DataFrame, text: str, keep: list[str], width: int, rows: int = BAND_ROWS,
             bands: int = BANDS) -> DataFrame:
    """``keep`` and ``n_shingles long, digest binary, bands array<long>`` of every whole text (digest null for an empty set)."""
    perms = -(-rows * bands // 2)

    def run(texts: list[bytes | None]) -> list[pa.Array]:
        n, digest, keys = [], [], []
        for raw in texts:
            x = shingle_set(raw, width)
            n.append(len(x))
            digest.append(xxhash.xxh3_128_digest(x.tobytes()) if len(x) else None)
            keys.append(band_keys(minmax_signature(x, perms), rows, bands) if len(x) else [])
        return [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]

    return map_texts(docs, text, "n_shingles long, digest binary, bands array<long>", run, keep)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80,
                    rows: int = BAND_ROWS, bands: int = BANDS, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their sets; ``component_id`` is the least
    ``doc_id`` that links reach.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    drawn = cut(sketches(source, "text", ["doc_id"], width, rows, bands))
    sets = drawn.where("doc_id is not null and digest is not null")
    repeated = cut(sets.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")).where("n > 1")
                   .select(F.col("digest").alias("_d"), "node"))
    named = (sets.join(repeated, F.col("digest") == F.col("_d"), "left")
             .select("doc_id", F.coalesce("node", "doc_id").alias("node"), "n_shingles", "bands"))
    copies = named.where("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    # Dealt by band once: the two aggregates and the join below need no further shuffle.
    members = (named.where("doc_id = node").select("node", "n_shingles", F.explode("bands").alias("band")).repartition("band")
               .groupBy("band", "node").agg(F.max("n_shingles").alias("size"), F.min("n_shingles").alias("least")))
    buckets = members.groupBy("band").agg(F.count("*").alias("m"), F.min("node").alias("center")).where("m > 1")
    crowd = cut(members.join(buckets.withColumnRenamed("band", "_b"), F.col("band") == F.col("_b")).drop("_b"))

    texts = _texts_of(source, crowd)
    linked = cut(_against_center(crowd, texts, width, percent))
    found = components(linked)
    more = _within_blocks(crowd, found, texts, width, percent, block)
    links = linked.union(copies) if more is None else linked.union(more).union(copies)
    roots = components(links).select(F.col("id").alias("_id"), "root")
    return (drawn.join(roots, F.col("doc_id") == F.col("_id"), "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")))


def _texts_of(source: DataFrame, crowd: DataFrame) -> DataFrame:
    """``node, text`` of the nodes that share a bucket.

    A bitmap of their hashes, of fixed size and therefore broadcast, leaves out most other texts before the shuffle.
    """
    nodes = crowd.select("node").distinct()
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(_BITMAP))
    bit = F.expr("shiftleft(1L, cast(spot % 64 as int))")
    bitmap = (nodes.select(spot("node").alias("spot")).groupBy(F.floor(F.col("spot") / 64).alias("word"))
              .agg(F.bit_or(bit).alias("bits")))
    likely = (source.withColumn("spot", spot("doc_id")).join(F.broadcast(bitmap), F.floor(F.col("spot") / 64) == F.col("word"))
              .where(F.col("bits").bitwiseAND(bit) != 0).select("doc_id", "text"))
    return cut(nodes.join(likely, F.col("node") == F.col("doc_id")).select("node", "text"))


def _sizes_fit(percent: int):
    """Whether two sets of these sizes can reach the similarity: the smaller one against the larger one."""
    return F.least("size", "size2") * 100 >= F.greatest("least", "least2") * percent


def _against_center(crowd: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Confirmed links ``a, b`` of bucket members with the least member of their bucket."""
    centers = crowd.where("node = center").groupBy(F.col("center").alias("c")).agg(
        F.max("size").alias("size2"), F.min("least").alias("least2"))
    pairs = (crowd.where("node <> center").groupBy("node", "center").agg(F.max("size").alias("size"), F.min("least").alias("least"))
             .join(centers, F.col("center") == F.col("c")).where(_sizes_fit(percent)).select("node", "center"))
    other = texts.select(F.col("node").alias("c"), F.col("text").alias("text2"))
    rows = pairs.join(texts, "node").join(other, F.col("center") == F.col("c")).select("node", "center", "text", "text2")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, against = None, None
        for b in batches:
            keep = []
            mine, theirs = b.column(2).cast(pa.binary()), b.column(3).cast(pa.binary())
            for i in range(b.num_rows):
                raw = theirs[i].as_py()
                if raw != last or against is None:
                    last, against = raw, shingle_set(raw, width)
                keep.append(similar(shingle_set(mine[i].as_py(), width), against, percent))
            yield pa.RecordBatch.from_arrays(b.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(confirm, "a long, b long").distinct()


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    if not len(x) or not len(y) or 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _within_blocks(crowd: DataFrame, found: DataFrame, texts: DataFrame, width: int, percent: int, block: int) -> DataFrame | None:
    """Links between members of a bucket that are still in different components, apart from those with its least member.

    Per bucket, the members outside its largest component meet all members. Buckets with the same members count once.
    """
    at = found.select(F.col("id").alias("_id"), "root")
    rest = (crowd.where("node <> center and m > 2").join(at, F.col("node") == F.col("_id"), "left")
            .select("band", "node", "size", F.coalesce("root", "node").alias("comp")))
    parts = rest.groupBy("band", "comp").agg(F.count("*").alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("h"))
    open_ = (parts.groupBy("band").agg(F.count("*").alias("k"), F.sum("n").alias("total"), F.sum("h").alias("h"),
                                       F.max(F.struct("n", "comp")).alias("top")).where("k > 1")
             .groupBy("total", "h").agg(F.min(F.struct("band", "top")).alias("s"))
             .select(F.col("s.band").alias("_band"), F.col("s.top.comp").alias("main"), "total",
                     (F.col("total") - F.col("s.top.n")).alias("few")))
    open_ = cut(open_)
    if open_.isEmpty():
        return None
    mine = rest.join(open_, F.col("band") == F.col("_band"))
    nx, ny = (F.ceil(F.col(c) / block).cast("int") for c in ("few", "total"))
    spot = F.abs(F.xxhash64("node") % 1_000_003)
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = mine.where("comp <> main").select("band", "node", "comp", (spot % nx).cast("int").alias("bx"), every(ny).alias("by"),
                                             F.lit(True).alias("asks"))
    right = mine.select("band", "node", "comp", every(nx).alias("bx"), (spot % ny).cast("int").alias("by"), F.lit(False).alias("asks"))
    rows = left.unionByName(right).join(texts, "node")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = {}
        for node, text in zip(pdf["node"], pdf["text"]):
            sets.setdefault(node, []).append(shingle_set(text.encode("utf-8", "surrogatepass") if text else b"", width))
        parent = {}

        def root(c: int) -> int:
            while parent.get(c, c) != c:
                c = parent[c]
            return c

        ask = list(dict.fromkeys(zip(pdf["node"][pdf["asks"]], pdf["comp"][pdf["asks"]])))
        all_ = list(dict.fromkeys(zip(pdf["node"][~pdf["asks"]], pdf["comp"][~pdf["asks"]])))
        out = []
        for a, ca in ask:
            for b, cb in all_:
                if a != b and root(ca) != root(cb) and any(similar(x, y, percent) for x in sets[a] for y in sets[b]):
                    parent[root(ca)] = root(cb)
                    out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return cut(rows.groupBy("band", "bx", "by").applyInPandas(compare, "a long, b long"))
