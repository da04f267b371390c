"""Prefix trie of conversations by peeling turns off from the deepest level up.

A node is a distinct sequence of first turns. Turns are known by digests of their whole role and text, prefixes by sums over
their turns of a hash of place and digest, so stripping the last turn is a subtraction, and the prefixes of a conversation of any
length follow from running sums. Prefixes carry 94 bits: among ten billion nodes two agree by chance with a probability
of three in a billion.

Tails that one conversation has alone need no merging: a count of prefixes tells where they begin, and they come off in one
step. From the deepest shared level on, each round takes the conversations that come in at this level (they end here, or
their lone tail begins below) together with the nodes that survived from the level below, groups them by prefix,
and has with this one aggregation the nodes of the level, their members, children, leaves and sums over subtrees. Then the
last turn is stripped. There are as many rounds as shared levels; each is written below the shared folder and the next one
reads it. The rounds group by partial aggregates, so a turn or a conversation that most have in common is no hot spot.

Defined cases: rows without a conversation number belong to none and are left out; a null role or text is empty; turns without a number
come first, equal numbers in the order of the digests; without any conversation there is no node, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.text import word_count
from gaugeworks.operators import series
from gaugeworks.session import cut, scratch_path

#: Conversation numbers per page of a list of ends.
PAGE_IDS = 4096
SALTS = 16
_KEY = "decimal(38,0)"
_DIGESTS = "depth long, key decimal(38,0), ends_sha256 string"


def turn_digests(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, digest, words`` of every turn of a conversation: its texts go no further than this."""
    who, what = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    whole = F.concat(F.length(who).cast("string"), F.lit(":"), who, what)
    return df.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.unhex(F.md5(whole)).alias("digest"), word_count(what).alias("words"))


def numbered(turns: DataFrame, order: Sequence[str], target_rows: int = series.TARGET_ROWS) -> DataFrame:
    """``conv, pos, digest, words``: turns numbered from 1 in the order of the given columns. A conversation beyond
    ``target_rows`` is numbered in parts."""
    placed = series.with_running(turns, ["conv"], [*order, "digest", "words"], target_rows=_hot_rows(turns, target_rows))
    return placed.select("conv", F.col("running_count").cast("long").alias("pos"), "digest", "words")


def _hot_rows(turns: DataFrame, target_rows: int) -> int | None:
    most = turns.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    return target_rows if most > target_rows else None


def _own() -> Column:
    """Hash of a turn at its place."""
    high = F.xxhash64(F.lit(1), "pos", "digest").bitwiseAND(F.lit((1 << 62) - 1))
    low = F.xxhash64(F.lit(2), "pos", "digest").bitwiseAND(F.lit((1 << 32) - 1))
    return (high.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + low.cast("decimal(10,0)")).cast(_KEY)


def prefix_trie(turns: DataFrame, members: DataFrame, target_rows: int = series.TARGET_ROWS) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of the trie of ``turns`` (as ``numbered`` returns them, written to storage) over the distinct conversations
    ``members(conv)``, turnless ones included.

    Nodes: ``depth, key, conv_id`` (least member), ``parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` (over the
    subtree, words of a node's last turn times its members but one). Ends: ``depth, key, page, conv_ids``, the
    conversations that end at a node, ascending, in pages of at most ``PAGE_IDS``.
    """
    hashed = turns.withColumn("own", _own())
    keyed = cut(series.with_running(hashed, ["conv"], ["pos"], "own", target_rows=_hot_rows(turns, target_rows))
                .select("conv", "pos", F.col("running_sum").cast(_KEY).alias("key"), "own", "words"))
    lone = cut(keyed.groupBy("pos", "key").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.min("own").alias("own"))
               .where("n = 1").drop("n"))
    ends = cut(members.select("conv").join(
        keyed.groupBy("conv").agg(F.max(F.struct("pos", "key")).alias("last")), "conv", "left").select(
        "conv", F.coalesce("last.pos", F.lit(0).cast("long")).alias("depth"), F.coalesce("last.key", F.lit(0).cast(_KEY)).alias("key")))
    folder, deepest = _shared_levels(keyed, lone, ends)
    if deepest is None:
        return _empty_nodes(ends), _pages(ends)
    shared = (ends.sparkSession.read.schema(_LEVEL).parquet(folder)
              .select("depth", "key", "conv", "parent", "n_convs", "n_children", "n_leaves", "saved"))
    alone = lone.join(ends.select(F.col("depth").alias("pos"), "key").distinct().withColumn("none", F.lit(0).cast("long")),
                      ["pos", "key"], "left").select(
        F.col("pos").alias("depth"), "key", "conv", (F.col("key") - F.col("own")).cast(_KEY).alias("parent"),
        F.lit(1).cast("long").alias("n_convs"), F.coalesce("none", F.lit(1).cast("long")).alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"))
    return _with_parent(shared.unionByName(alone), shared), _pages(ends)


_LEVEL = (f"depth long, key {_KEY}, conv long, parent {_KEY}, n_convs long, n_children long, n_leaves long, saved long, "
          f"path array<struct<own:{_KEY},words:long>>")


def _shared_levels(keyed: DataFrame, lone: DataFrame, ends: DataFrame) -> tuple[str, int | None]:
    """Write the nodes that several conversations share, and the root, level by level; their folder and the deepest level."""
    tails = lone.groupBy("conv").agg((F.min("pos") - 1).alias("shared"))
    entry = ends.join(tails, "conv", "left").select(
        "conv", F.coalesce("shared", "depth").alias("enters"), F.col("shared").isNotNull().cast("long").alias("tail"))
    steps = keyed.join(entry.where("enters > 0").select(F.col("conv").alias("of"), "enters"),
                       (F.col("conv") == F.col("of")) & (F.col("pos") <= F.col("enters")))
    paths = steps.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "own", "words"))).alias("steps"),
                                      F.max(F.struct("pos", "key")).alias("at"))
    here = cut(entry.join(paths, "conv", "left").select(
        F.coalesce("at.key", F.lit(0).cast(_KEY)).alias("key"), "conv", F.lit(1).cast("long").alias("n_convs"), F.col("tail").alias("n_children"),
        F.col("tail").alias("n_leaves"), F.lit(0).cast("long").alias("saved"),
        F.coalesce(F.transform("steps", lambda s: F.struct(s["own"], s["words"])), F.expr(f"cast(array() as array<struct<own:{_KEY},words:long>>)"))
        .alias("path"), "enters"))
    deepest = here.agg(F.max("enters")).first()[0]
    folder, spark = scratch_path(here.sparkSession, "trie"), here.sparkSession
    below = None
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        arrived = here.where(F.col("enters") == depth).drop("enters")
        level = _grouped(arrived if below is None else arrived.unionByName(_stripped(below)), depth)
        level.write.parquet(f"{folder}/level-{depth}")
        below = spark.read.schema(_LEVEL).parquet(f"{folder}/level-{depth}")
    return f"{folder}/*", deepest


def _grouped(rows: DataFrame, depth: int) -> DataFrame:
    """The nodes of one level from the conversations and child nodes that meet there."""
    last = F.element_at("path", -1) if depth else F.struct(F.lit(0).cast(_KEY).alias("own"), F.lit(0).cast("long").alias("words"))
    nodes = rows.groupBy("key").agg(
        F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.first("path").alias("path"))
    return nodes.withColumn("last", last).select(
        F.lit(depth).cast("long").alias("depth"), "key", "conv", (F.col("key") - F.col("last.own")).cast(_KEY).alias("parent"), "n_convs",
        "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        (F.col("saved") + (F.col("n_convs") - 1) * F.col("last.words")).alias("saved"), "path")


def _stripped(level: DataFrame) -> DataFrame:
    """Nodes without their last turn: each is one child of the node above."""
    return level.select(F.col("parent").alias("key"), "conv", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved",
                        F.slice("path", F.lit(1), F.size("path") - 1).alias("path"))


def _with_parent(nodes: DataFrame, shared: DataFrame) -> DataFrame:
    """Add the least member of the parent. Children of the root know it by one value; those of other shared nodes meet their parent
    under a salt; a node below a lone one has the same only member."""
    root = shared.where("depth = 0").select("conv").first()[0]
    salted = nodes.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    above = shared.where("depth > 0").select((F.col("depth") + 1).alias("at"), F.col("key").alias("of"), F.col("conv").alias("parent_conv"),
                                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("to"))
    met = salted.join(above, (F.col("depth") == F.col("at")) & (F.col("parent") == F.col("of")) & (F.col("salt") == F.col("to")), "left")
    parent = F.when(F.col("depth") == 1, F.lit(root).cast("long")).when(F.col("depth") > 1, F.coalesce("parent_conv", "conv"))
    return met.select("depth", "key", F.col("conv").alias("conv_id"), parent.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"))


def _empty_nodes(ends: DataFrame) -> DataFrame:
    names = ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return ends.where("false").select("depth", "key", *[F.lit(None).cast("long").alias(c) for c in names])


def _pages(ends: DataFrame) -> DataFrame:
    return (ends.groupBy("depth", "key", F.floor(F.col("conv") / PAGE_IDS).alias("page"))
            .agg(F.array_sort(F.collect_list("conv")).alias("conv_ids")))


def ends_digests(pages: DataFrame) -> DataFrame:
    """``depth, key, ends_sha256``: SHA-256 of the comma-joined conversation numbers that end at a node. The pages of a
    node stream through one digest in order; no list is ever whole in memory."""
    text = pages.select("depth", "key", "page", F.array_join("conv_ids", ",").alias("ids"))
    placed = text.repartition("depth", "key").sortWithinPartitions("depth", "key", "page")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        for batch in batches:
            done = []
            for depth, key, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if at == (depth, key):
                    sha.update(b"," + ids.encode())
                    continue
                if at is not None:
                    done.append((*at, sha.hexdigest()))
                at, sha = (depth, key), hashlib.sha256(ids.encode())
            yield _digest_rows(done)
        yield _digest_rows([] if at is None else [(*at, sha.hexdigest())])

    return placed.mapInArrow(run, _DIGESTS)


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [(), (), ()]
    types = (pa.int64(), pa.decimal128(38, 0), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["depth", "key", "ends_sha256"])
