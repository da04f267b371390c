import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import periodic_runs, queries
from odd_documents import SF, docs, nothing, texts  # noqa: F401


def plain_runs(words):
    """Every period by itself: stretches of equal words one period apart, the least period of each stretch."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(20))
def test_runs_equal_plain_search(seed):
    rng, many = random.Random(seed), []
    for _ in range(40):
        k, n = rng.choice([1, 2, 2, 3, 5]), rng.choice([0, 1, 4, 5, 6, 7, 20, 60, 150])
        words = [b"%d" % rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + (n - a) // rng.randint(3, 10)
            words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        many.append(words)
    assert periodic_runs.runs_of(many) == [plain_runs(w) for w in many]


def test_long_periodic_texts_stay_linear():
    for period in (1, 2, 7):
        words = [b"w%d" % (i % period) for i in range(60_000)]
        assert periodic_runs.runs_of([words]) == [[(0, 60_000, period)]]
    often = [w for k in range(4000) for w in (b"new%d" % k, *(b"same%d" % j for j in range(10)))]
    assert periodic_runs.runs_of([often]) == [[]]


def test_slices_do_not_change_runs(monkeypatch):
    rng = random.Random(3)
    texts = [b" ".join(rng.choice([b"a", b"b"]) for _ in range(rng.randint(0, 90))) for _ in range(60)]
    whole = [c.to_pylist() for c in periodic_runs._columns(texts)]
    monkeypatch.setattr(periodic_runs, "SLICE_WORDS", 50)
    assert [c.to_pylist() for c in periodic_runs._columns(texts)] == whole


def test_operator_on_odd_documents(docs, nothing):  # noqa: F811
    rows = periodic_runs.with_runs(docs.drop("row")).collect()
    assert len(rows) == docs.count()
    for r in rows:
        words = (r["text"] or "").encode().split()
        runs = [tuple(x) for x in r["runs"]]
        if len(words) < 1000:
            assert runs == plain_runs(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["collapsed"].encode() == b" ".join(w for i, w in enumerate(words) if i not in gone)
    assert {"score", "Kept", "source"} <= set(rows[0].asDict())
    clash = docs.select("doc_id", "text", F.lit(1).alias("runs"), F.lit(2).alias("Collapsed"))
    assert periodic_runs.with_runs(clash).columns == ["doc_id", "text", "runs", "collapsed"]
    assert periodic_runs.with_runs(nothing).count() == 0


def by_hand(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (len(runs), *best, best[1] and 1000 * best[1] // best[2], sha(b"".join(b"%d,%d,%d\n" % r for r in runs)),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_plain_search(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("ab") if i % 3 else rng.choice("abcdefgh") for _ in range(rng.randint(0, 80)))) for i in range(300)]
    rows += [(rows[5][0], rows[5][1]), (None, "a " * 9), (None, None), (10**12, ""), (-7, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op11_periodic_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()
    want = [(i, *by_hand(i, t)) for i, t in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[1] > 0 for w in want) > 50
