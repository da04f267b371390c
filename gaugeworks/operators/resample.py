"""Resampling to fixed buckets, with gap filling and a carried mean."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.scalars import tumbling_start
from gaugeworks.operators.series import TARGET_ROWS, with_next, with_page, with_running
from gaugeworks.session import cut

GAP_PART = 10_000
# Greatest number of buckets that a fold holds in one array.
CHUNK_ROWS = 10_000
_POINTS = "array<struct<bucket:bigint,value:double>>"


def bucket_totals(df: DataFrame, keys: Sequence[str], seconds: int, value: Column | None = None,
                  origin: int = 0, ts: str = "ts", fill: bool = True) -> DataFrame:
    """Per bucket the number of rows or, given ``value``, its sum.

    ``bucket`` is the epoch second of the bucket start. With ``fill``, empty buckets between the first
    and the last one of a series come out as 0.
    """
    total = F.sum(value) if value is not None else F.count(F.lit(1)).cast("double")
    sums = (df.groupBy(*keys, tumbling_start(F.col(ts), seconds, origin).alias("bucket"))
            .agg(total.alias("total")))
    return fill_gaps(sums, keys, seconds) if fill else sums


def fill_gaps(sums: DataFrame, keys: Sequence[str], seconds: int, target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Insert zero buckets after each bucket up to the next one of the same series.

    Works on bucket rows, whose number per series is bounded by time over bucket width; a series with very many is split
    along time. A gap is written out in two steps, so that no array holds more than ``GAP_PART`` buckets.
    """
    ahead = with_next(sums, keys, "bucket", target_rows)
    last = F.coalesce(F.col("_next") - F.lit(seconds), F.col("bucket"))
    part = F.lit(seconds * GAP_PART).cast("long")
    return (ahead.withColumn("_first", F.col("bucket")).withColumn("_last", F.greatest(last, F.col("bucket")))
            .withColumn("_part", F.explode(F.sequence(F.col("_first"), F.col("_last"), part)))
            .withColumn("bucket", F.explode(F.sequence(F.col("_part"), F.least(F.col("_last"), F.col("_part") + part - F.lit(seconds)),
                                                       F.lit(seconds).cast("long"))))
            .withColumn("total", F.when(F.col("bucket") == F.col("_first"), F.col("total")).otherwise(F.lit(0.0)))
            .select(*keys, "bucket", "total"))


def running_mean(totals: DataFrame, keys: Sequence[str], digits: int = 3, target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Mean of the bucket totals so far, the accumulator being carried from bucket to bucket."""
    run = with_running(totals, keys, ["bucket"], "total", target_rows)
    mean = F.col("running_sum") / F.col("running_count")
    return run.withColumn("value", F.round(mean, digits)).drop("running_sum", "running_count")


def resample(df: DataFrame, keys: Sequence[str], seconds: int, value: Column | None = None,
             origin: int = 0, fill: bool = True, digits: int = 3, target_rows: int | None = TARGET_ROWS) -> DataFrame:
    """Bucket totals and their running mean, one row per series and bucket. The sums are made and written once; their least
    and greatest buckets tell whether any series is long enough to be split."""
    sums = cut(bucket_totals(df, keys, seconds, value, origin, fill=False))
    span = F.floor((F.max("bucket") - F.min("bucket")) / seconds) + 1
    longest = sums.groupBy(*keys).agg(span.alias("_n")).agg(F.max("_n")).first()[0] or 0
    split = target_rows if target_rows is not None and longest > target_rows else None
    totals = fill_gaps(sums, keys, seconds, split) if fill else sums
    return running_mean(totals, keys, digits, split)


def fold_buckets(totals: DataFrame, keys: Sequence[str], start: Column, step: Callable[[Column, Column], Column],
                 emit: Callable[[Column], Column], merge: Callable[[Column, Column], Column] | None = None,
                 chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """General carried fold over the buckets of a series: ``step(acc, total)``, then ``emit(acc)``; ``keys, bucket, value``.

    A series is folded in chunks of ``chunk_rows`` buckets, and no array holds more entries than that. With ``merge``, which joins
    the states of two stretches that follow each other (``start`` being the state of an empty one), all chunks are folded at the
    same time: their states are merged along the series, by chunks of chunks where there are many, and each chunk is folded
    again from the state before it. Without it the chunks of a series are folded one after the other, all series abreast: each
    round hands its last states on to the next one through the shared folder. A series within one chunk takes neither.
    """
    if chunk_rows < 2:
        raise ValueError("a chunk holds at least two buckets")
    keys = list(keys)
    longest = totals.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    if longest <= chunk_rows:
        folded = _chunks(totals.withColumn("_chunk", F.lit(0)), keys).withColumn("_f", _fold(F.col("_items"), start, step, emit))
        return folded.select(*keys, F.inline("_f.out"))
    chunks = cut(_chunks(with_page(totals, keys, ["bucket"], chunk_rows, name="_chunk"), keys))
    return (_fold_abreast if merge else _fold_in_turn)(chunks, keys, start, step, emit, merge, chunk_rows)


def _chunks(totals: DataFrame, keys: list[str]) -> DataFrame:
    return totals.groupBy(*keys, "_chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "total"))).alias("_items"))


def _fold(items: Column, start: Column, step, emit) -> Column:
    """``acc, out`` of one chunk. The list of points grows by parts of about the square root of the chunk, so that little is copied."""
    part = F.greatest(F.floor(F.sqrt(F.size(items))), F.lit(1)).cast("int")

    def one(s: Column, b: Column) -> Column:
        acc = step(s["acc"], b["total"])
        point = F.struct(b["bucket"].alias("bucket"), emit(acc).cast("double").alias("value"))
        return F.struct(acc.alias("acc"), F.concat(s["out"], F.array(point)).alias("out"))

    def some(s: Column, k: Column) -> Column:
        begin = F.struct(s["acc"].alias("acc"), F.expr(f"cast(array() as {_POINTS})").alias("out"))
        return F.transform(F.array(F.aggregate(F.slice(items, k * part + 1, part), begin, one)), lambda r: F.struct(
            r["acc"].alias("acc"), F.concat(s["out"], F.array(r["out"])).alias("out")))[0]

    parts = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / part).cast("int"))
    begin = F.struct(start.alias("acc"), F.expr(f"cast(array() as array<{_POINTS}>)").alias("out"))
    return F.aggregate(parts, begin, some, lambda s: F.struct(s["acc"].alias("acc"), F.flatten(s["out"]).alias("out")))


def _same(keys: list[str]) -> list[Column]:
    return [F.col(f"`{k}`").eqNullSafe(F.col(f"`_of_{k}`")) for k in keys]


def _fold_in_turn(chunks: DataFrame, keys: list[str], start: Column, step, emit, merge, chunk_rows: int) -> DataFrame:
    last, done, carried = chunks.agg(F.max("_chunk")).first()[0], [], None
    for k in range(last + 1):
        now = chunks.where(F.col("_chunk") == k)
        if carried is None:
            now = now.withColumn("_acc", start)
        else:
            now = now.join(carried, _same(keys)).drop(*[f"_of_{c}" for c in keys])
        folded = cut(now.select(*keys, _fold(F.col("_items"), F.col("_acc"), step, emit).alias("_f")))
        carried = folded.select(*[F.col(f"`{c}`").alias(f"_of_{c}") for c in keys], F.col("_f.acc").alias("_acc"))
        done.append(folded.select(*keys, F.inline("_f.out")))
    return reduce(DataFrame.unionByName, done)


def _fold_abreast(chunks: DataFrame, keys: list[str], start: Column, step, emit, merge, chunk_rows: int) -> DataFrame:
    state = F.aggregate("_items", start, lambda acc, b: step(acc, b["total"]))
    before = _states_before(cut(chunks.select(*keys, "_chunk", state.alias("_acc"))), keys, start, merge, chunk_rows)
    at = [*keys, "_chunk"]
    joined = chunks.join(before.withColumnsRenamed({c: f"_of_{c}" for c in at}), _same(at)).drop(*[f"_of_{c}" for c in at])
    return joined.select(*keys, _fold(F.col("_items"), F.col("_acc"), step, emit).alias("_f")).select(*keys, F.inline("_f.out"))


def _states_before(states: DataFrame, keys: list[str], start: Column, merge, chunk_rows: int) -> DataFrame:
    """For every chunk the merged state ``_acc`` of all chunks of the series before it."""
    many = states.agg(F.max("_chunk")).first()[0] + 1
    kind = states.schema["_acc"].dataType.simpleString()
    grouped = (states.groupBy(*keys, F.call_function("div", F.col("_chunk"), F.lit(chunk_rows).cast("long")).alias("_over"))
               .agg(F.sort_array(F.collect_list(F.struct("_chunk", "_acc")), True).alias("_s")))
    if many > chunk_rows:
        whole = F.aggregate("_s", start, lambda acc, s: merge(acc, s["_acc"]))
        above = _states_before(cut(grouped.select(*keys, F.col("_over").alias("_chunk"), whole.alias("_acc"))), keys, start, merge, chunk_rows)
        at = {**{c: f"_of_{c}" for c in keys}, "_chunk": "_of__over"}
        grouped = grouped.join(above.withColumnsRenamed(at), _same([*keys, "_over"])).drop(*at.values())
    else:
        grouped = grouped.withColumn("_acc", start)
    begin = F.struct(F.col("_acc").alias("acc"), F.expr(f"cast(array() as array<struct<_chunk:bigint,_acc:{kind}>>)").alias("out"))
    run = F.aggregate("_s", begin, lambda r, s: F.struct(
        merge(r["acc"], s["_acc"]).alias("acc"), F.concat(r["out"], F.array(F.struct(s["_chunk"].alias("_chunk"), r["acc"].alias("_acc")))).alias("out")))
    return grouped.select(*keys, F.inline(run["out"]))
