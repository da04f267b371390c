"""Language-model scores from a log-frequency Bloom filter.

Counts of words and of word pairs over all training texts are quantised on a logarithmic scale, and an n-gram of level q is
entered q times (with 1 .. q mixed into its hash). A count is read back by repeated membership probes until the first
miss, so wrong reads only ever come out too high and geometrically rarely; a pair is taken to be no more frequent than
its words. The filter is cut into segments by the hash of the n-gram: a segment is filled by one task from counts that were summed
before, and all segments together have a fixed greatest size (``max_bits``), which bounds the broadcast. If the
n-grams need more room, the filter holds the most frequent ones, words first, by thresholds from the counts of words and of
a 1 in 256 sample of all pair keys; the others stay in a table (``Model.rest``) that grows with the corpus. An n-gram read
below the level of its threshold is looked up there by a join, so every n-gram counts whatever their number.

P(w | h) = (c(h w) + mu * P(w)) / (c(h) + mu) with P(w) = (c(w) + 1) / (N + V + 1); the first word of a text follows
an end. Words are known by 64-bit hashes. Defined cases: a null or empty text is one end; without training texts N and V are
0; equal rows are texts of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeworks.llm.text import encoded, mix64, slices, word_hashes, words_of
from gaugeworks.session import cut

BASE, HASHES, BITS_PER_ENTRY, MAX_BITS, MU = 1.5, 6, 8, 2**31, 200.0
#: Words whose exact counts every worker holds; the rest are joined.
FREQUENT = 2**18
_SEGMENT_BITS = 2**16
_SAMPLE = 256
#: Tokens of a group of texts; pairs that a task holds before it passes them on.
_GROUP, _HELD = 1_000_000, 2_500_000
#: Added to the count of a word, by which it is told from a pair; above any count of a pair.
_WORD = 2**62
#: No word is a blank.
_END = b" "
_MOST_LEVELS = 128


def level_of(counts: np.ndarray) -> np.ndarray:
    """Quantised level of positive counts: 1 + floor(log_base(count))."""
    return 1 + np.floor(np.log(counts) / np.log(BASE) + 1e-9).astype(np.int64)


def count_of_level() -> np.ndarray:
    """Count that a level stands for: the geometric mean of the least and greatest integer on it (0 for level 0)."""
    edges = np.ceil(BASE ** np.arange(_MOST_LEVELS + 1) - 1e-9)
    return np.concatenate([[0.0], np.sqrt(edges[:-1] * np.maximum(edges[:-1], edges[1:] - 1))])


def pair_keys(h: np.ndarray, end: np.uint64) -> np.ndarray:
    """Keys of each token with its predecessor. Each text ends with an end, so the first token of a text follows one."""
    before = np.concatenate([[end], h[:-1]]).astype(np.uint64)
    return mix64(mix64(before) + h + np.uint64(1))


def _positions(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(keys + np.uint64(level * 0xD1B54A32D192ED03 % 2**64))
    return h & np.uint64(0xFFFFFFFF), h >> np.uint64(32) | np.uint64(1)


def _bit(first: np.ndarray, step: np.ndarray, i: int) -> np.ndarray:
    return (first + np.uint64(i) * step & np.uint64(_SEGMENT_BITS - 1)).astype(np.int64)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    return (keys >> np.uint64(24)).astype(np.int64) % segments


def fill_segment(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bytes of one segment from its n-grams."""
    bits = np.zeros(_SEGMENT_BITS, bool)
    levels, j = level_of(counts), 1
    while len(keys):
        first, step = _positions(keys, j)
        for i in range(HASHES):
            bits[_bit(first, step, i)] = True
        j += 1
        keys, levels = keys[levels >= j], levels[levels >= j]
    return np.packbits(bits, bitorder="little")


@dataclass
class Filter:
    """All segments, one after the other."""
    data: np.ndarray
    segments: int

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each key by probes: the last one before the first miss."""
        out, at, j = np.zeros(len(keys), np.int64), np.arange(len(keys)), 1
        base = segment_of(keys, self.segments) * (_SEGMENT_BITS // 8) if self.segments else None
        while len(at) and self.segments and j < _MOST_LEVELS:
            first, step = _positions(keys[at], j)
            hit = np.arange(len(at))
            for i in range(HASHES):
                bit = _bit(first[hit], step[hit], i)
                hit = hit[(self.data[base[at[hit]] + (bit >> 3)] >> (bit & 7).astype(np.uint8) & 1).astype(bool)]
            at = at[hit]
            out[at] = j
            j += 1
        return out


@dataclass
class Model:
    filter: Filter
    tokens: int
    distinct: int
    end: int
    frequent: np.ndarray
    frequent_counts: np.ndarray
    mu: float
    #: Least levels of words and of pairs in the filter, and ``key, n`` of all other n-grams, None if there are none.
    least_word: int = 1
    least_pair: int = 1
    rest: DataFrame | None = None


def _tokens(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Groups of rows with the hashes of all their tokens and the number of tokens of each row."""
    for b in (part for whole in batches for part in slices(whole, 2048)):
        at = 0
        parts, lens = [], []
        size = 0
        for i, raw in enumerate(encoded(b.column(column))):
            words = words_of(raw and raw.lower())
            words.append(_END)
            parts.append(word_hashes(words))
            lens.append(len(words))
            size += len(words)
            if size >= _GROUP:
                yield b.slice(at, i + 1 - at), np.concatenate(parts), np.array(lens)
                at, parts, lens, size = i + 1, [], [], 0
        if parts:
            yield b.slice(at), np.concatenate(parts), np.array(lens)


def _fitting(shape: list[tuple[int, int]], room: int) -> tuple[int, int]:
    """Least count for which all n-grams of at least that count fit into ``room`` entries (1 if all do, ``_WORD`` if none does),
    and their entries. ``shape``: count and number of n-grams with that count."""
    least, used = _WORD, 0
    for n, k in sorted(shape, reverse=True):
        more = int(level_of(np.array([n]))[0]) * k
        if used + more > room:
            return least, used
        least, used = n, used + more
    return 1, used


def _summed(held: list[np.ndarray], counts: list[np.ndarray], segments: int) -> pa.RecordBatch:
    """Counts of n-grams from several groups, one row per n-gram."""
    keys, n = np.concatenate(held), np.concatenate(counts)
    sort = np.argsort(keys, kind="stable")
    keys, n = keys[sort], n[sort]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    keys = keys[first]
    return pa.RecordBatch.from_arrays([pa.array(segment_of(keys, segments).astype(np.int32)), pa.array(keys.view(np.int64)),
                                       pa.array(np.add.reduceat(n, first))], ["segment", "key", "n"])


def learn(docs: DataFrame, text: str = "text", max_bits: int = MAX_BITS, frequent: int = FREQUENT, mu: float = MU) -> tuple[Model, DataFrame]:
    """``(model, word counts)``; the counts are ``key, n``, one row per distinct token."""
    source = docs.select(F.col(f"`{text}`").alias("text"))
    end = word_hashes([_END])[0]

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, _ in _tokens(batches, 0):
            pairs = pair_keys(h, end)
            pairs = pairs[pairs % np.uint64(_SAMPLE) == 0]
            for kind, keys in ((1, h), (2, pairs)):
                keys, n = np.unique(keys, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.view(np.int64)), pa.array(n)],
                                                 ["kind", "key", "n"])

    counted = cut(source.mapInArrow(words, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    # A few thousand rows at most: counts on a logarithmic scale, exact below 100.
    step = F.when(F.col("n") < 100, F.col("n")).otherwise(F.floor(F.pow(F.lit(1.02), F.floor(F.log(F.col("n")) / np.log(1.02)))))
    shape = counted.groupBy("kind", step.alias("n")).agg(F.count("*").alias("k"), F.sum("n").alias("total")).collect()
    tokens, distinct = (sum(r[c] for r in shape if r.kind == 1) for c in ("total", "k"))
    by_count = sorted(((r.n, r.k) for r in shape if r.kind == 1), reverse=True)
    least_frequent, room = 1, frequent
    for n, k in by_count:
        if k > room:
            break
        least_frequent, room = n, room - k
    least_word, entries = _fitting(by_count, max_bits // BITS_PER_ENTRY)
    least_pair, more = _fitting([(r.n, r.k * _SAMPLE) for r in shape if r.kind == 2], max_bits // BITS_PER_ENTRY - entries)
    if least_word > 1:
        least_pair, more = _WORD, 0
    entries += more
    segments = max(1, min(max_bits, entries * BITS_PER_ENTRY) // _SEGMENT_BITS + 1)

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, size = [], [], 0
        for _, h, _ in _tokens(batches, 0):
            keys, n = np.unique(pair_keys(h, end), return_counts=True)
            held.append(keys)
            counts.append(n)
            size += len(keys)
            if size > _HELD:
                yield _summed(held, counts, segments)
                held, counts, size = [], [], 0
        if held:
            yield _summed(held, counts, segments)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy().view(np.uint64)
            flagged = pa.array(b.column(1).to_numpy() + _WORD)
            yield pa.RecordBatch.from_arrays([pa.array(segment_of(keys, segments).astype(np.int32)), b.column(0), flagged], ["segment", "key", "n"])

    shape_ = "segment int, key long, n long"
    vocabulary = counted.where("kind = 1").select("key", "n")
    rows = source.mapInArrow(grams, shape_).unionByName(vocabulary.mapInArrow(place, shape_))
    # Segments are small, so that tens of thousands of tasks can share the count.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), segments // 128)
    summed = rows.repartition(parts, "segment").groupBy("segment", "key").agg(F.sum("n").alias("n"))
    rest = None
    if least_pair > 1:
        held = F.when(F.col("n") >= _WORD, F.col("n") - _WORD >= least_word).otherwise(F.col("n") >= least_pair)
        split = cut(summed.withColumn("held", held))
        summed, rest = split.where("held").drop("held"), split.where(~F.col("held")).select("key", F.pmod("n", F.lit(_WORD)).alias("n"))
    summed = summed.withColumn("n", F.pmod("n", F.lit(_WORD)))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        data = fill_segment(pdf["key"].to_numpy(np.int64).view(np.uint64), pdf["n"].to_numpy())
        return pd.DataFrame({"segment": [pdf["segment"].iloc[0]], "data": [data.tobytes()]})

    data = np.zeros(segments * (_SEGMENT_BITS // 8), np.uint8)
    filled = cut(summed.groupBy("segment").applyInPandas(build, "segment int, data binary"))
    for r in filled.toLocalIterator():
        at = r.segment * (_SEGMENT_BITS // 8)
        data[at:at + _SEGMENT_BITS // 8] = np.frombuffer(r.data, np.uint8)
    top = vocabulary.where(F.col("n") >= least_frequent).orderBy("key").toArrow() if tokens else None
    keys = top.column("key").to_numpy().view(np.uint64) if tokens else np.zeros(0, np.uint64)
    sort = np.argsort(keys, kind="stable")
    counts = top.column("n").to_numpy()[sort] if tokens else np.zeros(0, np.int64)
    rare = vocabulary.where(F.col("n") < least_frequent)
    return Model(Filter(data, segments if tokens else 0), tokens, distinct, int(end), keys[sort], counts, mu,
                 *(int(level_of(np.array([n]))[0]) for n in (least_word, least_pair)), rest), rare


def _levels(model: Model, keys: np.ndarray, least: int, found: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Levels of keys from the filter or, below its least level, from the sorted keys and levels that were looked up."""
    levels = model.filter.levels(keys)
    if found is not None:
        at = np.minimum(np.searchsorted(found[0], keys), max(len(found[0]) - 1, 0))
        there = found[0][at] == keys if len(found[0]) else np.zeros(len(keys), bool)
        levels = np.where(levels >= least, levels, np.where(there, found[1][at], 0) if len(found[0]) else 0)
    return levels


def _looked_up(docs: DataFrame, sent: Broadcast, rest: DataFrame) -> DataFrame:
    """``docs`` (the last column is the text) with ``_keys`` and ``_counts`` of the n-grams of a text that are in ``rest``."""
    fixed = cut(docs.withColumn("_row", F.monotonically_increasing_id()))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        end = np.uint64(m.end)
        for b, h, lens in _tokens(batches, 1):
            owner = np.repeat(np.arange(len(lens)), lens)
            rows, keys = [], []
            for grams, least in ((h, m.least_word), (pair_keys(h, end), m.least_pair)):
                distinct, back = np.unique(grams, return_inverse=True)
                open_ = np.flatnonzero((m.filter.levels(distinct) < least)[back])
                codes = np.unique(owner[open_] * len(distinct) + back[open_])
                rows.append(codes // len(distinct))
                keys.append(distinct[codes % len(distinct)])
            ids = b.column(0).to_numpy()[np.concatenate(rows)]
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(np.concatenate(keys).view(np.int64))], ["_id", "_key"])

    asked = fixed.select("_row", fixed.columns[-2]).mapInArrow(ask, "_id long, _key long")
    found = (asked.join(rest, F.col("_key") == F.col("key")).groupBy("_id")
             .agg(F.collect_list(F.struct("key", "n")).alias("_found"))
             .select("_id", F.col("_found.key").alias("_keys"), F.col("_found.n").alias("_counts")))
    return fixed.join(found, F.col("_row") == F.col("_id"), "left").select(*docs.columns[:-1], "_keys", "_counts", docs.columns[-1])


def _found(b: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their levels from two list columns of a batch. A key has one count, whichever text asks."""
    keys, counts = (b.column(k).flatten().to_numpy(zero_copy_only=False) for k in (at, at + 1))
    keys, first = np.unique(keys.astype(np.int64).view(np.uint64), return_index=True)
    return keys, level_of(counts[first].astype(np.int64))


def score(docs: DataFrame, model: Model, rare: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``n_tokens, n_known, train_tokens long, base_score, score double`` of every whole text. A kept column
    with one of these names gives way to it.

    Exact counts of frequent words are at hand; the other words of a text are joined with their counts, by hash.
    """
    made = {"n_tokens", "n_known", "train_tokens", "base_score", "score"}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    passed = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in keep], F.col(f"`{text}`").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(replace(model, rest=None))
    names, more = passed.columns[:-1], 0
    if model.rest is not None:
        passed, more = _looked_up(passed, sent, model.rest), 2
    out = "row long, n_tokens long, known long, logs double, score double, words array<long>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        value, total = count_of_level(), float(m.tokens + m.distinct + 1)
        end = np.uint64(m.end)
        for b, h, lens in _tokens(batches, len(keep) + more):
            found = _found(b, len(keep)) if more else None
            starts = np.cumsum(lens) - lens
            owner = np.repeat(np.arange(len(lens)), lens)
            words, back = np.unique(h, return_inverse=True)
            n_words = value[_levels(m, words, m.least_word, found)]
            before = np.concatenate([[np.searchsorted(words, end)], back[:-1]])
            keys, pair = np.unique(pair_keys(h, end), return_inverse=True)
            seen = np.minimum(value[_levels(m, keys, m.least_pair, found)][pair], np.minimum(n_words[back], n_words[before]))
            p = (seen + m.mu * (n_words[back] + 1) / total) / (n_words[before] + m.mu)
            model_score = np.add.reduceat(np.log10(p), starts)
            at = np.minimum(np.searchsorted(m.frequent, words), max(len(m.frequent) - 1, 0))
            hit = m.frequent[at] == words if len(m.frequent) else np.zeros(len(words), bool)
            logs = np.where(hit, np.log10(m.frequent_counts[at] + 1.0) if len(m.frequent) else 0.0, 0.0)
            other = np.flatnonzero(~hit[back])
            codes, times = np.unique(owner[other] * len(words) + back[other], return_counts=True)
            ends = np.searchsorted(codes // len(words), np.arange(len(lens) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                b.columns[:len(keep)] + [
                    pa.array(np.zeros(len(lens), np.int64)), pa.array(lens), pa.array(np.add.reduceat(hit[back].astype(np.int64), starts)),
                    pa.array(np.add.reduceat(logs[back], starts)), pa.array(model_score),
                    pa.ListArray.from_arrays(ends, pa.array(words[codes % len(words)].view(np.int64))),
                    pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))],
                names + ["row", "n_tokens", "known", "logs", "score", "words", "times"])

    schema = StructType(list(passed.schema.fields[:len(keep)]) + list(StructType.fromDDL(out).fields))
    scored = cut(passed.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))
    pairs = scored.select("row", F.inline(F.arrays_zip("words", "times"))).select("row", F.col("words").alias("word"), F.col("times").alias("times"))
    found = (pairs.join(rare, F.col("word") == F.col("key"))
             .groupBy(F.col("row").alias("_row")).agg(F.sum(F.log10(F.col("n") + 1.0) * F.col("times")).alias("more"), F.sum("times").alias("also")))
    total = float(np.log10(model.tokens + model.distinct + 1))
    return scored.join(found, F.col("row") == F.col("_row"), "left").select(
        *[F.col(f"`in_{c}`").alias(c) for c in keep], "n_tokens", (F.col("known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * total).alias("base_score"), "score")
