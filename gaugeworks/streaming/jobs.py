"""Standing window jobs: one definition for stream and batch.

A job keeps, per open window, a small keyed state (counts or sums). When the watermark closes a window its state
rows go, as an ordinary DataFrame, to the same ``result`` function a batch run uses, so both give the same
answer. Streams write each micro-batch under its number, which makes a replay harmless.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gaugeworks.functions.scalars import sliding_starts, tumbling_start
from gaugeworks.session import remove_path, scratch_scope
from gaugeworks.sources.tables import write_batch

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class WindowJob:
    """``keep``, ``map`` and ``partition`` prepare rows, ``state`` is kept per window and ``state_keys``,
    ``result`` turns the state rows of closed windows (with ``window_start``, ``window_end`` in epoch
    seconds) into result rows, ``collect`` shapes what is written. ``real_time`` takes the time of arrival instead of the
    event time: the column ``arrival`` where it was recorded, which gives batch and stream the same windows, else the clock.
    """

    name: str
    seconds: int
    state_keys: Sequence[str]
    result: Step
    slide: int | None = None
    state: dict[str, Column] = field(default_factory=lambda: {"n": F.count(F.lit(1))})
    keep: Column | None = None
    map: Step | None = None
    partition: Step | None = None
    collect: Step | None = None
    real_time: bool = False
    arrival: str | None = None
    delay: str | None = None
    save: bool = True
    ts: str = "ts"

    def time(self, clock: bool = False) -> Column:
        """The time that places a row in windows."""
        if self.real_time and self.arrival:
            return F.col(self.arrival)
        return F.current_timestamp() if self.real_time and clock else F.col(self.ts)

    def prepare(self, df: DataFrame) -> DataFrame:
        out = df if self.keep is None else df.where(self.keep)
        for step in (self.map, self.partition):
            if step is not None:
                out = step(out)
        return out

    def finish(self, closed: DataFrame) -> DataFrame:
        out = self.result(closed)
        return out if self.collect is None else self.collect(out)

    def closed_in_batch(self, df: DataFrame) -> DataFrame:
        """State rows of all windows of a table."""
        starts = sliding_starts(self.time(), self.seconds, self.slide or self.seconds)
        return (self.prepare(df).withColumn("window_start", F.explode(starts))
                .groupBy("window_start", *self.state_keys).agg(*[c.alias(n) for n, c in self.state.items()])
                .withColumn("window_end", F.col("window_start") + F.lit(self.seconds)))

    def run_batch(self, df: DataFrame) -> DataFrame:
        return self.finish(self.closed_in_batch(df))

    def closed_in_stream(self, stream: DataFrame) -> DataFrame:
        """State rows of closed windows, append mode. The watermark is one window unless ``delay`` is set."""
        return _with_edges(self.in_windows(self.marked(stream)))

    def marked(self, stream: DataFrame) -> DataFrame:
        """Prepared rows; a copy of their time carries the watermark, so that the time column itself may be a state key."""
        rows = self.prepare(stream).withColumn("_event", self.time(clock=True))
        return rows.withWatermark("_event", self.delay or f"{self.seconds} seconds")

    def in_windows(self, rows: DataFrame) -> DataFrame:
        slide = f"{self.slide} seconds" if self.slide else None
        return (rows.groupBy(F.window("_event", f"{self.seconds} seconds", slide).alias("window"), *self.state_keys)
                .agg(*[c.alias(n) for n, c in self.state.items()]))

    def start(self, stream: DataFrame, checkpoint: str, path: str | None = None,
              sinks: Sequence[Callable[[DataFrame, int], None]] = (),
              trigger: dict | None = None) -> StreamingQuery:
        """Run on a stream. Results go to ``path`` if ``save``, and to each of ``sinks``. The checkpoint
        folder makes the job permanent: a restart goes on where it stopped."""
        if self.save and path is None:
            raise ValueError("a job that saves its results needs a path")

        base = checkpoint.rstrip("/")

        def on_batch(closed: DataFrame, batch_id: int) -> None:
            # A result may read its input several times, but a micro-batch must run only once.
            closed.write.mode("overwrite").parquet(f"{base}_closed")
            kept = closed.sparkSession.read.schema(closed.schema).parquet(f"{base}_closed")
            with scratch_scope(closed.sparkSession):
                done = self.finish(self.gathered(kept, base, batch_id))
                if self.save:
                    write_batch(done, path, batch_id)
                    done = done.sparkSession.read.schema(done.schema).parquet(f"{path.rstrip('/')}/batch={batch_id}")
                for sink in sinks:
                    sink(done, batch_id)

        return (self.closed_in_stream(stream).writeStream.queryName(self.name).outputMode("append")
                .option("checkpointLocation", checkpoint).foreachBatch(on_batch)
                .trigger(**(trigger or {"availableNow": True})).start())


    def gathered(self, closed: DataFrame, base: str, batch_id: int) -> DataFrame:
        """What the result of a micro-batch is made of, besides what closed with it."""
        return closed


def _with_edges(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("window_start", F.unix_seconds("window.start"))
            .withColumn("window_end", F.unix_seconds("window.end")).drop("window"))


@dataclass(frozen=True)
class ChainedJob(WindowJob):
    """Windows over the closed windows of ``first``, in one query with one checkpoint and one watermark.

    ``between`` turns the state rows of ``first``, whose time ``ts`` is the last instant of their window, into rows for this
    job; it must keep ``ts``. Rows of the first stage reach the second in the batch in which their window closes, and a window of the
    second closes with the watermark of the stream, without a delay of its own.
    """

    first: WindowJob | None = None
    between: Step = lambda rows: rows

    def closed_in_batch(self, df: DataFrame) -> DataFrame:
        made = self.first.closed_in_batch(df)
        at = F.timestamp_micros(F.col("window_end") * 1_000_000 - 1)
        return super().closed_in_batch(self.between(made.withColumn("ts", at).drop("window_start", "window_end")))

    def closed_in_stream(self, stream: DataFrame) -> DataFrame:
        made = self.first.in_windows(self.first.marked(stream))
        rows = self.prepare(self.between(made.withColumn("ts", F.window_time("window")).drop("window")))
        return _with_edges(self.in_windows(rows.withColumnRenamed("ts", "_event")))


@dataclass(frozen=True)
class PaneJob(WindowJob):
    """Sliding windows whose state holds every row once, in the pane it falls into, instead of once per window.

    A pane is as wide as the greatest common divisor of width and slide, so windows are whole panes. ``result`` gets rows of panes
    (``pane``, state keys, state, without ``window_start``) and one row with nothing but ``window_start`` for each window to report; both
    end by the same watermark. Closed panes go to a folder beside the checkpoint, under the number of their batch, until no open
    window can need them.
    """

    @property
    def pane(self) -> int:
        return math.gcd(self.seconds, self.slide or self.seconds)

    def _columns(self) -> list[str]:
        return ["pane", *self.state_keys, *self.state, "window_start"]

    def closed_in_batch(self, df: DataFrame) -> DataFrame:
        rows = self.prepare(df)
        panes = (rows.groupBy(tumbling_start(self.time(), self.pane).alias("pane"), *self.state_keys)
                 .agg(*[c.alias(n) for n, c in self.state.items()]).withColumn("window_start", F.lit(None).cast("long")))
        starts = sliding_starts(F.timestamp_seconds("pane"), self.seconds, self.slide or self.seconds)
        ends = (panes.select("pane").distinct().select(F.explode(starts).alias("window_start"))
                .select(F.col("window_start").cast("long").alias("window_start")).distinct())
        return panes.select(*self._columns()).unionByName(ends, allowMissingColumns=True)

    def closed_in_stream(self, stream: DataFrame) -> DataFrame:
        rows = self.marked(stream)
        panes = (rows.groupBy(F.window("_event", f"{self.pane} seconds").alias("window"), *self.state_keys)
                 .agg(*[c.alias(n) for n, c in self.state.items()])
                 .withColumns({"pane": F.unix_seconds("window.start"), "window_start": F.lit(None).cast("long")}))
        slide = f"{self.slide} seconds" if self.slide else None
        ends = (rows.groupBy(F.window("_event", f"{self.seconds} seconds", slide).alias("window")).count()
                .select(F.unix_seconds("window.start").alias("window_start")))
        return panes.select(*self._columns()).unionByName(ends, allowMissingColumns=True)

    def gathered(self, closed: DataFrame, base: str, batch_id: int) -> DataFrame:
        spark, store = closed.sparkSession, f"{base}_panes"
        write_batch(closed.where("window_start is null").drop("window_start"), store, batch_id)
        ends = closed.where("window_start is not null")
        first, last = ends.agg(F.min("window_start"), F.max("window_start")).first()
        kept = spark.read.schema(closed.drop("window_start").withColumn("batch", F.lit(0).cast("long")).schema).parquet(store)
        if first is None:
            return closed.where("false")
        for old in kept.groupBy("batch").agg(F.max("pane").alias("top")).where(F.col("top") < first).collect():
            if old["batch"] < batch_id:
                remove_path(spark, f"{store}/batch={old['batch']}")
        kept = spark.read.schema(kept.schema).parquet(store)
        inside = kept.where((F.col("pane") >= first) & (F.col("pane") < last + self.seconds) & (F.col("batch") <= batch_id)).drop("batch")
        return inside.withColumn("window_start", F.lit(None).cast("long")).unionByName(ends)


def chain(first: WindowJob, second: WindowJob, metrics_of: Step) -> Callable[[DataFrame], DataFrame]:
    """Batch form of two chained jobs: the metrics made of the first one's results feed the second."""
    return lambda df: second.run_batch(metrics_of(first.run_batch(df)))


def drop_report(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Per micro-batch how many rows came in and how many were refused as late."""
    rows = []
    for p in query.recentProgress:
        late = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        rows.append((query.name, p.batchId, p.numInputRows, late))
    return spark.createDataFrame(rows, "task string, batch long, rows_in long, rows_dropped long")
