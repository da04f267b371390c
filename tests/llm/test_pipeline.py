import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from odd_documents import SF, docs, nothing, texts  # noqa: F401
from test_dedup import brute_force
from test_mixing_packing import check_packing, fair
from test_quality import by_hand

SF01 = SF.replace("sf0.001", "sf0.01")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and what it returned, on the whole table."""
    out, docs = [], spark.read.parquet(f"{SF01}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "rows")
        stage(spark, docs, SF01).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "minhash_near_dedup", "source_mix", "best_fit_packing"]
    for before, after in stages[:4]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"] == before.columns


def test_classifier_drops_bad_rows_and_keeps_good_ones(spark, stages):
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    before, after = (Counter(r.quality for r in d.join(labels, "doc_id").select("quality").collect()) for d in stages[0])
    assert after[1] >= 0.95 * before[1] and after[0] <= 0.1 * before[0]


def test_rules_keep_what_passes_the_base(stages):
    before, after = ({r.doc_id: r.text for r in d.collect()} for d in stages[1])
    base = {i for i, t in before.items() if (c := by_hand(t))[0] >= 50 and 100 * c[4] <= 50 * c[0]}
    assert set(after) <= base and len(after) >= 0.95 * len(base)


def test_one_document_of_each_group_stays(stages):
    before, after = ([(r.doc_id, r.text) for r in d.collect()] for d in stages[2])
    root = brute_force(before, 5, 80)
    assert sorted(after) == sorted((i, t) for i, t in before if root[i] == i)


def test_mix_repeats_documents_to_the_targets(stages):
    before, after = ([(r.doc_id, r.text, r.source) for r in d.collect()] for d in stages[3])
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in before}
    total = defaultdict(int)
    for i, _, s in before:
        total[s] += size[i]
    times = Counter(after)
    assert set(times) <= set(before) and max(times.values()) <= 3
    for s, target in fair(dict(total), [5, 2, 1]).items():
        assert abs(sum(size[i] * n for (i, _, own), n in times.items() if own == s) - target) <= max(size[i] for i, _, own in before if own == s)


def test_packing_holds_every_word(stages):
    before, after = stages[4]
    check_packing(after.collect(), before, 2048, 4)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    key = lambda d: sorted(map(str, d.drop("shard", "bin", "offset", "bin_words").collect()))
    assert corpus_pipeline.ORACLE_SQL is None
    assert key(corpus_pipeline.run(spark, SF01)) == key(stages[4][1])


def test_stages_on_odd_and_empty_documents(spark, docs, nothing):
    for given in (docs, nothing):
        for _, stage in corpus_pipeline.STAGES[:4]:
            got = stage(spark, given, SF)
            assert got.columns == given.columns and got.count() <= 3 * given.count()
        pieces = corpus_pipeline.STAGES[4][1](spark, given, SF)
        assert pieces.where(F.col("words") == 0).count() + pieces.where("bin is not null").count() == pieces.count()
