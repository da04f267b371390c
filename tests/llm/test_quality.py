import re
from collections import Counter
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import quality_qda, quality_rules, queries
from odd_documents import SF, docs, nothing, texts  # noqa: F401
from gaugeworks.llm.stats import NAMES, text_stats, with_stats
from gaugeworks.llm.text import crc_mod

SF01 = SF.replace("sf0.001", "sf0.01")


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(inside)


def test_counts(spark, docs, texts):
    for t in texts:
        got = dict(zip(NAMES, text_stats(None if t is None else t.encode())))
        assert tuple(got[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == by_hand(t)
    rows = with_stats(docs, keep=["doc_id"]).collect()
    assert len(rows) == docs.count()
    assert {r.doc_id: r.n_words for r in rows if r.doc_id is not None} == {i: by_hand(t)[0] for i, t in enumerate(texts)}


@pytest.mark.parametrize("k, n, p", [(0, 10, 0.1), (3, 20, 0.2), (10, 10, 0.5), (5, 1000, 0.004), (900, 1000, 0.9)])
def test_binomial_tail(k, n, p):
    exact = sum(comb(n, i) * p**i * (1 - p)**(n - i) for i in range(k + 1))
    assert quality_rules.binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-8)
    assert 0 <= quality_rules.binomial_tail(10**6, 10**9, 0.0011) <= 1


def test_cutoff_is_the_last_before_a_failed_test():
    cells = {0: 3000, 5: 3, 9: 1, 60: 1}
    found = quality_rules.lowest_cutoff(cells, 50, 0.004, 0.01)
    n = sum(cells.values())
    above = lambda j: sum(v for c, v in cells.items() if c > j)
    passed = [quality_rules.binomial_tail(above(j), n, 0.004) <= 0.01 for j in range(51)]
    assert all(passed[found:]) and not passed[found - 1]
    assert quality_rules.lowest_cutoff({0: 50}, 50, 0.004, 0.01) is None and quality_rules.lowest_cutoff({}, 50, 0.004, 0.01) is None


def test_rules_hold_the_risk_and_pool_small_strata(spark):
    n = F.col("id")
    bad = n % 20 == 0
    stats = spark.range(6000).select(
        n.alias("doc_id"), F.when(n % 3 == 0, "big").when(n % 3 == 1, F.concat(F.lit("small"), n % 5)).alias("lang"),
        *[F.when(bad, 300).otherwise(0).alias(c) if c == "n_symbols" else F.lit(400 if c == "n_words" else 0).alias(c) for c in NAMES])
    labels = spark.range(6000).select(n.alias("doc_id"), (~bad).alias("good"))
    cutoffs = quality_rules.learn_cutoffs(stats, labels, "lang")
    rows = {r.stratum: r for r in cutoffs.collect()}
    assert rows["big"].cutoffs["symbols"] == 0 and rows["small1"].pooled and not rows["big"].pooled and None in rows
    verdicts = quality_rules.with_verdict(stats, cutoffs, "lang").groupBy((F.col("doc_id") % 20 == 0).alias("bad"), "kept").count().collect()
    assert {(r.bad, r.kept) for r in verdicts} == {(True, False), (False, True)}


def test_a_small_stratum_does_not_pay_for_the_pool(spark):
    # 70 small languages of 99 good rows; in one of them 14 good rows have as many symbols as the bad rows have.
    n = F.col("id")
    bad, lang = n % 100 == 0, F.floor(n / 100) % 70
    stats = spark.range(7000).select(
        n.alias("doc_id"), F.concat(F.lit("small"), lang.cast("string")).alias("lang"),
        *[F.when(bad | ((lang == 3) & (n % 100 < 15)), 300).otherwise(0).alias(c) if c == "n_symbols" else F.lit(400 if c == "n_words" else 0).alias(c) for c in NAMES])
    cutoffs = quality_rules.learn_cutoffs(stats, spark.range(7000).select(n.alias("doc_id"), (~bad).alias("good")), "lang")
    rows = {r.stratum: r for r in cutoffs.collect()}
    assert all(r.pooled and r.good == 99 for r in rows.values()) and len(rows) == 70
    assert (rows["small3"].lost, rows["small3"].cutoffs) == (14, None) and rows["small4"].lost == 0
    judged = quality_rules.with_verdict(stats, cutoffs, "lang").withColumn("good", F.col("doc_id") % 100 != 0)
    assert judged.where("good and not kept").isEmpty() and judged.where("kept and not good").select("lang").distinct().count() == 1


def test_rules_on_odd_and_empty_tables(spark, docs, nothing):
    labels = spark.createDataFrame([(0, True), (1, None), (None, True)], "doc_id long, good boolean")
    for d in (docs, nothing):
        stats = with_stats(d, keep=["doc_id", "lang"])
        judged = quality_rules.with_verdict(stats, quality_rules.learn_cutoffs(stats, labels, "lang"), "lang")
        assert judged.count() == d.count()
        assert judged.where("kept and n_words < 50").isEmpty()


def test_model_is_the_density_difference():
    rng = np.random.default_rng(0)
    k = quality_qda.N_FEATURES
    x = [rng.normal(size=(200, k)), rng.normal(1, 2, size=(300, k))]
    n, s, ss = np.array([200.0, 300.0]), np.stack([a.sum(0) for a in x]), np.stack([a.T @ a for a in x])
    m = quality_qda.model_from_sums(n, s, ss, 0, 0)
    point = rng.normal(size=(1, k))
    want = []
    for c in range(2):
        cov = np.cov(x[c].T, bias=True) + 1e-6 * np.eye(k)
        d = point[0] - x[c].mean(0)
        want.append(np.log(n[c] / 500) - 0.5 * (np.linalg.slogdet(cov)[1] + d @ np.linalg.solve(cov, d)))
    assert quality_qda._density(m.good, point)[0] - quality_qda._density(m.bad, point)[0] == pytest.approx(want[1] - want[0])


def test_classifier_on_held_out_rows(spark):
    got = queries.op3_quality_classifier(spark, SF01).join(queries.quality_labels(spark, SF01), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert n > 40 and right / n > 0.9
    every = queries.op3_quality_classifier(spark, SF01)
    assert every.count() == 1000 and every.where("score < 0 or score > 1 or score is null or predicted <> cast(score >= 0.3 as int)").isEmpty()


def test_classifier_without_labels_and_on_odd_rows(spark, docs, nothing):
    for d in (docs, nothing):
        stats = with_stats(d, keep=["doc_id"])
        model = quality_qda.fit(stats.withColumn("quality", F.lit(1)).limit(0), "quality")
        assert model.good is None and model.share == 0.5
        assert quality_qda.with_score(stats, model).where("score = 0.5").count() == d.count()
        labelled = stats.withColumn("quality", F.when(F.col("n_words") > 100, 1).otherwise(0))
        scored = quality_qda.with_score(stats, quality_qda.fit(labelled, "quality"))
        assert scored.where("score between 0 and 1").count() == d.count()


def test_remainders_follow_crc32(spark):
    import zlib
    rows = spark.range(50).select("id", crc_mod(F.col("id"), 5).alias("m")).collect()
    assert all(r.m == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
