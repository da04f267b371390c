import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gaugeworks.llm import prefix_trie, queries
from odd_documents import SF  # noqa: F401


def plain_trie(paths):
    """All prefixes in a dictionary; sums over subtrees by walking up from every node."""
    members, ends, kids = defaultdict(set), defaultdict(list), defaultdict(set)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].add(c)
            if d:
                kids[turns[:d - 1]].add(turns[:d])
        ends[turns].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        gain = (len(members[node]) - 1) * len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += gain
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def as_tuples(df):
    return sorted(map(tuple, df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()))


def built(turns, members, **options):
    nodes, ends = prefix_trie.prefix_trie(turns, members, **options)
    return nodes.join(prefix_trie.ends_digests(ends), ["depth", "key"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def random_rows(rng, convs, depth, kinds):
    return [(c, t, rng.choice(["user", "bot"]), "word " * rng.randrange(kinds)) for c in convs for t in range(rng.randint(1, depth))]


@pytest.mark.parametrize("seed", range(3))
def test_trie_equals_dictionary(spark, seed):
    rng = random.Random(seed)
    rows = random_rows(rng, rng.sample(range(-50, 10**6), 120), 7, 2 + seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = prefix_trie.numbered(prefix_trie.turn_digests(df), ["turn"])
    paths = defaultdict(tuple)
    for c, t, role, text in rows:
        paths[c] += ((role, text),)
    empty = max(paths) + 5
    paths[empty] = ()
    members = turns.select("conv").distinct().union(spark.createDataFrame([(empty,)], "conv long"))
    assert as_tuples(built(turns, members)) == plain_trie(paths)


def test_one_very_long_conversation_and_many_copies(spark):
    """Lone tails take no rounds; a conversation beyond the row limit is numbered and summed in parts."""
    rows = [(1, t, "u", f"turn {t}") for t in range(2000)] + [(c, t, "u", f"turn {t}") for c in range(2, 9002) for t in range(2)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    turns = prefix_trie.numbered(prefix_trie.turn_digests(df), ["turn"], target_rows=300)
    paths = defaultdict(tuple)
    for c, _, role, text in rows:
        paths[c] += ((role, text),)
    members = turns.select("conv").distinct()
    got = {(r[1], r[0]): r for r in as_tuples(built(turns, members, target_rows=300))}
    ends = hashlib.sha256(",".join(map(str, range(2, 9002))).encode()).hexdigest()
    none = hashlib.sha256(b"").hexdigest()
    assert got[(0, 1)] == (1, 0, None, 9001, 1, 1, 9000 * 4, none) and got[(1, 1)] == (1, 1, 1, 9001, 1, 1, 9000 * 4, none)
    assert got[(2, 1)] == (1, 2, 1, 9001, 1, 1, 9000 * 2, ends) and got[(1999, 1)] == (1, 1999, 1, 1, 1, 1, 0, none)
    assert got[(2000, 1)][4] == 0 and len(got) == 2001
    pages = prefix_trie.prefix_trie(turns, members)[1]
    assert pages.agg(F.max(F.size("conv_ids"))).first()[0] <= prefix_trie.PAGE_IDS and pages.where("depth = 2").count() == 3


def rebuilt(rows):
    turns = defaultdict(list)
    order = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest())
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        turns[r[0]].append((r[2] or "", r[3] or ""))
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
    return out


@pytest.mark.parametrize("kind", ["odd", "given", "empty"])
def test_query_equals_dictionary(spark, tmp_path, kind):
    rng = random.Random(4)
    rows = random_rows(rng, list(range(0, 90)) + [10**9 + 3, 10**9 + 4], 4, 3)
    rows += [(7, None, None, None), (7, None, None, "x"), (7, 3, "user", None), (7, 3, "user", None), (None, 1, "user", "lost"), (200, 0, "", "")]
    if kind == "given":
        rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    df = spark.createDataFrame([] if kind == "empty" else rows, "conv_id long, turn long, role string, text string")
    df.withColumn("depth", F.lit(9)).withColumn("key", F.lit("k")).write.parquet(str(tmp_path / "conversations.parquet"))
    got = as_tuples(queries.op13_prefix_trie(spark, str(tmp_path)))
    assert got == ([] if kind == "empty" else plain_trie(rebuilt(rows)))
