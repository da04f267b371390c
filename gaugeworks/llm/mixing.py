"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are in words. Every source gets a target by its weight, at most ``passes`` times its own size; the excess of
capped sources is dealt out again by weight. The documents of a source are put in a fixed random order and cut into
blocks of equal size (within one word). Slot i of the schedule has the point frac(i * golden ratio), mapped through the
cumulative number of blocks that each source has to give; the n-th slot of a source takes its n-th block, and after the
last block the next pass begins. So every stretch of the schedule has nearly the target shares. What rounding leaves
open at the end is settled exactly: surplus slots are void, missing ones follow at the end, and the last block is cut.

Nothing runs in one task: prefix sums and ranks are taken per bucket of a source and shifted by bucket totals.
Defined cases: texts that are null or without words have size 0 and no part in the mix; a null source is a source of its
own, last in order; rows with equal ids are separate documents; without any word all targets are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.text import word_count
from gaugeworks.session import cut

BLOCK_WORDS = 1024
PASSES = 3
#: Points are multiples of the odd number nearest to 2**31 / golden ratio, modulo 2**31.
_UNIT, _STEP = 2**31, 1327217885
_CELL = 2**21
_CHUNK = 2**16
_BUCKET_ROWS = 4_000


@dataclass
class Mix:
    """``docs``: ``sid, start, size`` and the carried columns of every document (start null for size 0).
    ``sources``: ``sid, source, source_size, weight, target`` and the layout of blocks.
    ``schedule``: ``slot, sid, nth, pass, block``.
    ``pieces``: ``slot, sid, start, pass, first_word, words``, what each slot takes of each document."""
    docs: DataFrame
    sources: DataFrame
    schedule: DataFrame
    pieces: DataFrame


def targets(sizes: DataFrame, weights: list[int], passes: int = PASSES) -> DataFrame:
    """One row per source: rank ``sid`` by code point (null last), size, weight and target.

    A source is capped if the weight share of what the sources with a lower cap per weight leave over exceeds its cap.
    These windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    per = per.withColumn("sid", rank.cast("int")).withColumn("weight", F.element_at(cycle, F.col("sid") % len(weights) + 1))
    cap = F.lit(passes) * F.col("source_size")
    by_cap = Window.orderBy(cap / F.col("weight"), "sid")
    before, every = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = left.cast("double") / weight
    per = per.withColumn("_level", level).withColumn("_capped", level > cap / F.col("weight"))
    common = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(every)
    target = F.when(F.col("_capped"), cap.cast("double")).otherwise(common * F.col("weight"))
    return per.withColumn("target", target).drop("_level", "_capped")


def _layout(sources: DataFrame, block_words: int) -> DataFrame:
    """Blocks of each source: ``blocks`` of ``q`` words, the first ``r`` with one more; ``quota`` words are taken,
    ``whole`` passes and ``tail`` words, in ``slots`` slots."""
    s = sources.withColumn("quota", F.floor(F.col("target") + 0.5)).withColumn(
        "blocks", F.ceil(F.col("source_size") / block_words))
    size, blocks = F.nullif(F.col("source_size"), F.lit(0)), F.nullif(F.col("blocks"), F.lit(0))
    s = (s.withColumn("q", F.expr("source_size div nullif(blocks, 0)")).withColumn("r", F.col("source_size") % blocks)
         .withColumn("whole", F.expr("quota div nullif(source_size, 0)")).withColumn("tail", F.col("quota") % size))
    return s.withColumn("slots", F.coalesce(F.col("whole") * F.col("blocks") + F.when(
        F.col("tail") > 0, _block_of(F.col("tail") - 1) + 1).otherwise(0), F.lit(0)))


def _block_of(word: Column) -> Column:
    wide = F.col("r") * (F.col("q") + 1)
    return F.when(word < wide, F.floor(word / (F.col("q") + 1))).otherwise(
        F.col("r") + F.floor((word - wide) / F.col("q")))


def _block_start(block: Column) -> Column:
    return block * F.col("q") + F.least(block, F.col("r"))


def schedule(layout: DataFrame) -> DataFrame:
    """``slot, sid, nth``: the sources' slots in the order of the schedule. ``layout`` has one row per source."""
    total = layout.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    before = F.sum("slots").over(Window.orderBy("sid")) - F.col("slots")
    edge = lambda c: F.floor(c.cast("double") / max(total, 1) * _UNIT)
    spans = (layout.where("slots > 0").select("sid", "slots", edge(before).alias("lo"), edge(before + F.col("slots")).alias("hi"))
             .where("hi > lo").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / _CELL), F.floor((F.col("hi") - 1) / _CELL)))))
    spans = cut(spans)
    spark = layout.sparkSession
    points = spark.range(0, total, 1, max(1, min(10_000, -(-total // 500_000)))).select(
        F.col("id").alias("slot"), (F.col("id") % _UNIT * _STEP % _UNIT).alias("point"))
    dealt = (points.withColumn("cell", F.floor(F.col("point") / _CELL)).join(spans, "cell").where("point >= lo and point < hi")
             .select("slot", "sid", F.floor(F.col("slot") / _CHUNK).alias("chunk"), "slots"))
    counts = cut(dealt.groupBy("sid", "chunk").agg(F.count("*").alias("n")))
    shift = counts.select(F.col("sid").alias("_sid"), F.col("chunk").alias("_chunk"),
                          (F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n")).alias("shift"))
    ranked = dealt.withColumn("at", F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1)
    ranked = (ranked.join(shift, (F.col("sid") == F.col("_sid")) & (F.col("chunk") == F.col("_chunk")))
              .select("slot", "sid", (F.col("shift") + F.col("at")).alias("nth"), "slots").where("nth < slots").drop("slots"))
    given = layout.join(counts.groupBy(F.col("sid").alias("_sid")).agg(F.sum("n").alias("given")), F.col("sid") == F.col("_sid"), "left")
    short = (given.select("sid", "slots", F.coalesce("given", F.lit(0)).alias("given")).where("given < slots")
             .withColumn("lack", F.col("slots") - F.col("given")))
    ahead = F.sum("lack").over(Window.orderBy("sid")) - F.col("lack")
    closing = (short.withColumn("ahead", ahead).select("sid", "given", "ahead", F.explode(F.sequence("given", F.col("slots") - 1)).alias("nth"))
               .select((F.lit(total) + F.col("ahead") + F.col("nth") - F.col("given")).alias("slot"), "sid", "nth"))
    return ranked.unionByName(closing)


def mix(docs: DataFrame, weights: list[int], doc_id: str = "doc_id", text: str = "text", source: str = "source",
        carry: list[str] | None = None, passes: int = PASSES, block_words: int = BLOCK_WORDS, seed: int = 7) -> Mix:
    """The mix of all documents; ``carry`` names further columns to keep in ``Mix.docs``."""
    carry = carry or []
    sizes = cut(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"),
                            word_count(F.col(f"`{text}`")).alias("size"), *[F.col(f"`{c}`") for c in carry]))
    sources = cut(_layout(targets(sizes, weights, passes), block_words))
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("n_docs") / _BUCKET_ROWS))
    place = F.floor(F.conv(F.substring("order", 1, 7), 16, 10).cast("long") * buckets / 2**28)
    keys = sources.select(F.col("source").alias("_source"), "sid", "n_docs", "blocks", "q", "r")
    known = (sizes.join(keys, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("order", order)
             .withColumn("bucket", place))
    some = known.where("size > 0")
    totals = some.groupBy(F.col("sid").alias("_sid"), F.col("bucket").alias("_bucket")).agg(F.sum("size").alias("_words"))
    totals = totals.withColumn("_shift", F.sum("_words").over(Window.partitionBy("_sid").orderBy("_bucket")) - F.col("_words"))
    within = Window.partitionBy("sid", "bucket").orderBy("order", "size", *carry).rowsBetween(Window.unboundedPreceding, 0)
    placed = (some.withColumn("_upto", F.sum("size").over(within))
              .join(totals, (F.col("sid") == F.col("_sid")) & (F.col("bucket") == F.col("_bucket")))
              .withColumn("start", F.col("_shift") + F.col("_upto") - F.col("size")))
    placed = cut(placed.select("doc_id", "sid", "size", "start", "blocks", "q", "r", *carry))
    columns = ["doc_id", "sid", "size", "start", *carry]
    everything = placed.select(*columns).unionByName(
        known.where("size = 0").withColumn("start", F.lit(None).cast("long")).select(*columns))

    plan = schedule(sources.select("sid", "slots"))
    plan = plan.join(sources.select(F.col("sid").alias("_sid"), "blocks", "whole", "tail"), F.col("sid") == F.col("_sid"))
    plan = plan.select("slot", "sid", "nth", F.floor(F.col("nth") / F.col("blocks")).alias("pass"),
                       (F.col("nth") % F.col("blocks")).alias("block"), "whole", "tail")
    end = F.col("start") + F.col("size")
    parts = placed.withColumn("block", F.explode(F.sequence(_block_of(F.col("start")), _block_of(end - 1))))
    parts = parts.select("sid", "block", "start", F.greatest(F.col("start"), _block_start(F.col("block"))).alias("lo"),
                         F.least(end, _block_start(F.col("block") + 1)).alias("hi"))
    limit = F.when(F.col("pass") < F.col("whole"), F.col("hi")).otherwise(F.least("hi", "tail"))
    pieces = (plan.join(parts, ["sid", "block"]).withColumn("words", limit - F.col("lo")).where("words > 0")
              .select("slot", "sid", "start", "pass", (F.col("lo") - F.col("start")).alias("first_word"), "words"))
    return Mix(everything, sources, plan.drop("whole", "tail"), pieces)


def taken(m: Mix) -> DataFrame:
    """Every document with the words that the mix takes of it, repeats counted: ``doc_id, size``, the carried columns,
    ``source_size, target, taken``."""
    words = m.pieces.groupBy(F.col("sid").alias("_sid"), F.col("start").alias("_start")).agg(F.sum("words").alias("taken"))
    facts = m.sources.select(F.col("sid").alias("_s"), "source_size", "target")
    return (m.docs.join(words, (F.col("sid") == F.col("_sid")) & (F.col("start") == F.col("_start")), "left")
            .join(facts, F.col("sid") == F.col("_s"))
            .drop("_sid", "_start", "_s", "start", "sid").withColumn("taken", F.coalesce("taken", F.lit(0).cast("long"))))
