import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import mixing, packing
from odd_documents import docs, nothing, texts  # noqa: F401


def fair(sizes, weights, passes=3):
    """Targets by dealing the excess out again until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        left = total - sum(capped.values())
        rest = [s for s in order if s not in capped]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s: passes * sizes[s] for s in rest if share[s] > passes * sizes[s]}
        if not over:
            return {**share, **capped}
        capped.update(over)


@pytest.mark.parametrize("block_words", [7, 1024])
def test_mix_meets_its_targets(spark, docs, block_words):
    m = mixing.mix(docs, [5, 2, 1], block_words=block_words)
    rows = mixing.taken(m).collect()
    sizes = defaultdict(int)
    for r in docs.select("source", "text").collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    want, taken = fair(sizes, [5, 2, 1]), defaultdict(int)
    assert len(rows) == docs.count()
    source = {r.sid: r.source for r in m.sources.collect()}
    words = m.pieces.groupBy("sid").agg(F.sum("words").alias("w")).collect()
    for r in words:
        taken[source[r.sid]] = r.w
    for r in m.sources.collect():
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert abs(taken[r.source] - r.target) <= 0.5
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    assert sum(r.taken for r in rows) == sum(taken.values())


def test_schedule_is_even_and_complete(spark):
    layout = spark.createDataFrame([(0, 5000), (1, 2000), (2, 1000), (3, 1), (4, 0)], "sid int, slots long")
    rows = mixing.schedule(layout).orderBy("slot").collect()
    got = defaultdict(list)
    for r in rows:
        got[r.sid].append((r.slot, r.nth))
    assert {s: len(v) for s, v in got.items()} == {0: 5000, 1: 2000, 2: 1000, 3: 1}
    assert all([n for _, n in v] == list(range(len(v))) for v in got.values())
    assert len({r.slot for r in rows}) == len(rows)
    for share, s in ((5 / 8, 0), (2 / 8, 1), (1 / 8, 2)):
        seen = 0
        for k, r in enumerate(rows[:8000]):
            seen += r.sid == s
            assert abs(seen - share * (k + 1)) < 8


def test_blocks_are_equal_and_reruns_agree(spark, docs):
    a, b = (mixing.mix(docs.repartition(n), [5, 2, 1], block_words=64) for n in (1, 5))
    key = lambda m: sorted(map(tuple, m.pieces.collect()))
    assert key(a) == key(b)
    full = a.pieces.groupBy("sid", "pass", "slot").agg(F.sum("words").alias("w")).groupBy("sid").agg(F.collect_list("w").alias("w")).collect()
    for r in full:
        assert len([w for w in r.w if w < max(r.w) - 1]) <= 1


def test_mix_of_nothing(spark, nothing, docs):
    assert mixing.taken(mixing.mix(nothing, [5, 2, 1])).collect() == []
    wordless = docs.where("text is null or trim(text) = ''")
    assert mixing.taken(mixing.mix(wordless, [1])).where("taken <> 0 or target <> 0").isEmpty()


def test_every_item_goes_to_a_tightest_compatible_bin():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 60) for _ in range(300)), reverse=True)
    sources = [rng.choice("aaab") for _ in sizes]
    clusters = [rng.randrange(40) if rng.random() < 0.5 else 100 + i for i in range(len(sizes))]
    got, offsets = packing.best_fit(sizes, sources, clusters, 100, 3)
    bins = []
    for k, b in enumerate(got):
        fits = {n: x for n, x in enumerate(bins) if x["free"] >= sizes[k] and clusters[k] not in x["clusters"] and x["sources"].count(sources[k]) < 3}
        if fits:
            assert b in fits and fits[b]["free"] == min(x["free"] for x in fits.values())
        else:
            assert b == len(bins)
            bins.append({"free": 100, "clusters": set(), "sources": []})
        assert offsets[k] == 100 - bins[b]["free"]
        bins[b]["free"] -= sizes[k]
        bins[b]["clusters"].add(clusters[k])
        bins[b]["sources"].append(sources[k])


def check_packing(rows, docs, capacity, per_source):
    words = defaultdict(int)
    for r in docs.select("doc_id", "text").collect():
        words[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    got, bins = defaultdict(int), defaultdict(list)
    for r in rows:
        got[r.doc_id] += r.words
        if r.words:
            bins[r.shard, r.bin].append(r)
        else:
            assert r.bin is None
    assert got == words
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.words
        assert at == own[0].bin_words <= capacity
        by = defaultdict(int)
        for r in own:
            by[r.source] += 1
        assert max(by.values()) <= per_source or len(own) == 1


def test_packing_keeps_every_word(spark, docs, nothing):
    rows = packing.pack(docs, capacity=500, per_source=2, shard_items=50).collect()
    check_packing(rows, docs, 500, 2)
    text = {r.doc_id: r.text for r in docs.collect()}
    by_bin = defaultdict(list)
    for r in rows:
        if r.words and r.words < 500:
            by_bin[r.shard, r.bin].append(" ".join((text[r.doc_id] or "").lower().split()))
    assert all(len(set(v)) == len(v) for v in by_bin.values())
    assert packing.pack(nothing).collect() == []
