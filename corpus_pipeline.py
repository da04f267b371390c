"""Training corpus pipeline: each stage works on all documents that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gaugeworks.llm import minmax_dedup, mixing, packing, quality_qda, quality_rules
from gaugeworks.llm.queries import MIX_WEIGHTS, quality_labels, table
from gaugeworks.llm.stats import with_stats
from gaugeworks.llm.text import crc_mod, guarded, restored
from gaugeworks.session import cut, remove_path, scratch_path, scratch_scope

MIN_SCORE = 0.3


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores at ``MIN_SCORE`` or above. Null and empty texts have a score, too;
    without labels every score is 0.5 and all documents stay. Texts are counted twice, for the fit and for the scores, which
    costs less than to write them once more."""
    learnt = (with_stats(docs, keep=["doc_id"]).where(crc_mod(F.col("doc_id"), 5) != 0)
              .join(quality_labels(spark, sf_dir), "doc_id"))
    scored = quality_qda.with_score(with_stats(guarded(docs), "in_text"), quality_qda.fit(learnt, "quality"))
    return restored(scored.where(F.col("score") >= MIN_SCORE), docs)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled rules of their language (null is one, too). Texts with
    fewer than 50 words, null and empty ones among them, go."""
    labels = quality_labels(spark, sf_dir).select("doc_id", (F.col("quality") == 1).alias("good"))
    cutoffs = quality_rules.learn_cutoffs(with_stats(docs, keep=["doc_id", "lang"]), labels, "lang")
    return restored(quality_rules.with_verdict(with_stats(guarded(docs), "in_text"), cutoffs, "in_lang").where("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity of at least 0.8): the one with the least
    ``doc_id``. Of several rows with one id the first in the order of their texts stays; rows without an id all stay."""
    found = minmax_dedup.near_duplicates(docs, width=5, percent=80)
    heads = found.where("doc_id = component_id").select(F.col("doc_id").alias("head")).distinct()
    rows = guarded(docs)
    rank = F.row_number().over(Window.partitionBy("in_doc_id").orderBy("in_text", "in_source", "in_lang"))
    kept = rows.join(heads, F.col("in_doc_id") == F.col("head")).withColumn("rank", rank).where("rank = 1")
    return restored(kept.select(*rows.columns).unionByName(rows.where("in_doc_id is null")), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it: its taken words over its size, rounded, so that a source is
    within one document of what the schedule takes. Documents without words go. Rows of one id are told apart by a number
    that is written first."""
    rows = cut(guarded(docs).withColumn("row", F.monotonically_increasing_id()))
    words = mixing.taken(mixing.mix(rows, MIX_WEIGHTS, "in_doc_id", "in_text", "in_source", carry=["row"]))
    times = (words.where("taken > 0").select(F.col("row").alias("at"), F.floor(F.col("taken") / F.col("size") + 0.5).alias("times"))
             .where("times > 0"))
    copies = rows.join(times, F.col("row") == F.col("at")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    return restored(copies, docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document in training sequences: bins of 2,048 words with offsets."""
    return packing.pack(docs)


STAGES = [("quality_classifier", classify), ("quality_rules", apply_rules), ("minhash_near_dedup", drop_near_copies),
          ("source_mix", mix_sources), ("best_fit_packing", pack_documents)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below the shared folder and read again by the next. What a
    stage wrote on the way, and the result before its own, go as soon as it is done."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
