"""Best-fit packing of documents into training sequences under conflicts.

A bin holds ``capacity`` words. A text longer than that is cut: its full pieces fill bins of their own, its rest is an
item like any other, so no word is lost. Two members of one duplicate cluster never share a bin, and no bin holds more
than ``per_source`` items of one source. Bins are ordered by their residual; each carries a bitmap of its duplicate
clusters and ``per_source`` bitmaps of its sources (the k-th marks the sources with at least k items). An item goes to
the tightest bin it fits in; if that one conflicts the search goes on to its successors, and only if none is compatible a
bin is opened.

Items are dealt at random into shards of bounded size, and each shard is packed on its own: a hot source or cluster is
spread over all shards like any other row, and all that a shard loses is its last, half-empty bins.

Defined cases: a text that is null or without words has one row with ``words`` 0 and no bin; a null source counts as a source;
equal rows are separate items of one cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.text import word_count
from gaugeworks.session import cut

CAPACITY, PER_SOURCE, SHARD_ITEMS = 2048, 4, 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def same_words_key(text: Column) -> Column:
    """A 64-bit key of the lower-cased words of a text: the duplicate cluster where none is given."""
    plain = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), r"[\x20\x09-\x0D]+", " ")
    return F.xxhash64(F.trim(plain))


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int, per_source: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item, taken in the given order; sizes are 1..capacity."""
    known: dict = {}
    source_bit = [1 << known.setdefault(s, len(known)) for s in sources]
    repeated: dict = {}
    for c in clusters:
        repeated[c] = repeated.get(c, 0) + 1
    bits: dict = {}
    cluster_bit = [1 << bits.setdefault(c, len(bits)) if repeated[c] > 1 else 0 for c in clusters]
    levels: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = 0  # bit r: some bin has residual r
    planes: list[list[int]] = []
    members: list[int] = []
    bins, offsets = [], []
    for size, src, dup in zip(sizes, source_bit, cluster_bit):
        rest, found = filled >> size, -1
        while rest and found < 0:
            low = rest & -rest
            level = levels[size + low.bit_length() - 1]
            for at, b in enumerate(level):
                if not (members[b] & dup or planes[b][-1] & src):
                    found, residual = b, size + low.bit_length() - 1
                    level[at] = level[-1]
                    level.pop()
                    if not level:
                        filled &= ~(1 << residual)
                    break
            rest ^= low
        if found < 0:
            found, residual = len(members), capacity
            members.append(0)
            planes.append([0] * per_source)
        members[found] |= dup
        carry = src
        for k, plane in enumerate(planes[found]):
            planes[found][k], carry = plane | carry, plane & carry
        bins.append(found)
        offsets.append(capacity - residual)
        if residual > size:
            levels[residual - size].append(found)
            filled |= 1 << (residual - size)
    return bins, offsets


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", cluster: str | None = None,
         capacity: int = CAPACITY, per_source: int = PER_SOURCE, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """``doc_id, source, piece, first_word, words, shard, bin, offset, bin_words``: one row per piece of each document,
    ``offset`` and ``bin_words`` in words. ``cluster`` names a column with the duplicate cluster; else equal words are one."""
    words = F.col(f"`{text}`")
    dup = same_words_key(words) if cluster is None else F.xxhash64(F.col(f"`{cluster}`"))
    items = cut(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                            word_count(words).alias("size"), dup.alias("cluster"), F.monotonically_increasing_id().alias("row")))
    shards = max(1, -(-items.count() // shard_items))
    kind = items.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, source string, piece long, first_word long, words long, shard int, bin long, offset long, bin_words long"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "row"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
        size = pdf["size"].to_numpy(np.int64)
        rest, full = size % capacity, size // capacity
        item = np.flatnonzero(rest)
        item = item[np.argsort(-rest[item], kind="stable")]
        bins, offsets = best_fit(rest[item].tolist(), [None if pd.isna(s) else s for s in pdf["source"].to_numpy(object)[item]],
                                 pdf["cluster"].to_numpy()[item].tolist(), capacity, per_source)
        bins = np.array(bins, np.int64)
        used = np.bincount(bins, weights=rest[item]).astype(np.int64) if len(item) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(pdf)), full)
        piece = np.arange(len(owner)) - np.repeat(np.cumsum(full) - full, full)
        at = np.concatenate([item, owner])
        out = pdf.iloc[at][["doc_id", "source"]].reset_index(drop=True)
        out["piece"] = np.concatenate([full[item], piece])
        out["first_word"] = out["piece"] * capacity
        out["words"] = np.concatenate([rest[item], np.full(len(owner), capacity)])
        out["shard"] = int(pdf["shard"].iloc[0])
        out["bin"] = np.concatenate([bins, len(used) + np.arange(len(owner))])
        out["offset"] = np.concatenate([np.array(offsets, np.int64), np.zeros(len(owner), np.int64)])
        out["bin_words"] = np.concatenate([used[bins], np.full(len(owner), capacity)])
        return out

    dealt = items.where("size > 0").withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    placed = dealt.groupBy("shard").applyInPandas(run, shape)
    nothing = F.lit(None)
    empty = items.where("size = 0").select(
        "doc_id", "source", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("first_word"), F.lit(0).cast("long").alias("words"),
        nothing.cast("int").alias("shard"), *[nothing.cast("long").alias(c) for c in ("bin", "offset", "bin_words")])
    return placed.unionByName(empty)
