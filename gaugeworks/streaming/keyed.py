"""Callbacks with state of their own per key: values, lists, maps, timers and expiry.

A ``KeyedJob`` is for tasks that a window cannot say, such as sessions or alarms that re-arm. ``on_rows`` gets the rows of a key
that came in with a micro-batch, ``on_timer`` runs when the watermark passes a time that a callback has asked for. Both read and change
the ``State`` of the key and give result rows. State lives in the state store and survives a restart from the same checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from gaugeworks.sources.tables import write_batch

# Fixed value: the state store that keeps lists, maps and timers.
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class State:
    """State of one key while a callback runs. Rows are tuples in the order of their DDL."""

    def __init__(self, value, items, table, handle: StatefulProcessorHandle):
        self._value, self._items, self._table, self._handle = value, items, table, handle

    def value(self) -> tuple | None:
        return self._value.get() if self._value.exists() else None

    def set_value(self, row: tuple | None) -> None:
        self._value.clear() if row is None else self._value.update(row)

    def items(self) -> list[tuple]:
        return list(self._items.get()) if self._items.exists() else []

    def append(self, row: tuple) -> None:
        self._items.appendValue(row)

    def set_items(self, rows: Sequence[tuple]) -> None:
        self._items.put(list(rows)) if rows else self._items.clear()

    def lookup(self, key: tuple) -> tuple | None:
        return self._table.getValue(key) if self._table.containsKey(key) else None

    def entries(self) -> Iterator[tuple[tuple, tuple]]:
        return self._table.iterator()

    def set_entry(self, key: tuple, row: tuple | None) -> None:
        self._table.removeKey(key) if row is None else self._table.updateValue(key, row)

    def wake_at(self, millis: int) -> None:
        """Run ``on_timer`` once the watermark has passed this time."""
        self._handle.registerTimer(int(millis))

    def timers(self) -> list[int]:
        return list(self._handle.listTimers())

    def forget_timers(self) -> None:
        for at in self.timers():
            self._handle.deleteTimer(at)


Rows = Iterable[tuple]


@dataclass(frozen=True)
class KeyedJob:
    """``keys`` name the key columns; ``value``, ``items`` and ``table`` (key and value) are the DDL of the states, ``out`` that of the result
    rows, which begin with the key columns. The watermark trails the greatest ``ts`` by ``delay``."""

    name: str
    keys: Sequence[str]
    out: str
    on_rows: Callable[[State, tuple, pd.DataFrame], Rows]
    on_timer: Callable[[State, tuple, int], Rows] = lambda state, key, at: ()
    value: str = "v long"
    items: str = "v long"
    table: tuple[str, str] = ("k string", "v long")
    ts: str = "ts"
    delay: str = "0 seconds"

    def stream(self, rows: DataFrame) -> DataFrame:
        """The result rows of a stream."""
        rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _STORE)
        marked = rows.withWatermark(self.ts, self.delay)
        return marked.groupBy(*self.keys).transformWithStateInPandas(
            statefulProcessor=_Processor(self), outputStructType=self.out, outputMode="Append", timeMode="EventTime")

    def start(self, rows: DataFrame, checkpoint: str, path: str, trigger: dict | None = None) -> StreamingQuery:
        """Run on a stream and write its result rows, each micro-batch under its number."""
        return (self.stream(rows).writeStream.queryName(self.name).outputMode("append").option("checkpointLocation", checkpoint)
                .foreachBatch(lambda df, batch_id: write_batch(df, path, batch_id)).trigger(**(trigger or {"availableNow": True})).start())


class _Processor(StatefulProcessor):
    def __init__(self, job: KeyedJob):
        self._job = job

    def init(self, handle: StatefulProcessorHandle) -> None:
        job = self._job
        self._state = State(handle.getValueState("value", job.value), handle.getListState("items", job.items),
                            handle.getMapState("table", *job.table), handle)
        self._names = [part.split()[0] for part in job.out.split(",")]

    def _made(self, rows: Rows) -> pd.DataFrame:
        return pd.DataFrame(list(rows), columns=self._names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for part in rows:
            yield self._made(self._job.on_rows(self._state, key, part))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._made(self._job.on_timer(self._state, key, expiredTimerInfo.getExpiryTimeInMs()))

    def close(self) -> None:
        pass


def session_job(keys: Sequence[str], key_ddl: str, gap: int, name: str = "sessions", ts: str = "ts", delay: str = "0 seconds") -> KeyedJob:
    """Sessions of a key: rows at most ``gap`` seconds apart. ``start``, ``last`` (epoch seconds) and ``n`` of each when it is over.

    The list state holds the open sessions of a key, merged as rows arrive in any order; a session ends when the watermark is more than
    ``gap`` seconds past its last row, and nothing of it stays.
    """

    def on_rows(state: State, key: tuple, rows: pd.DataFrame) -> Rows:
        seconds = rows[ts].astype("datetime64[s, UTC]" if rows[ts].dt.tz else "datetime64[s]").astype("int64")
        open_ = sorted(state.items() + [(int(s), int(s), 1) for s in seconds])
        merged = open_[:1]
        for start, last, n in open_[1:]:
            a, b, m = merged[-1]
            if start - b <= gap:
                merged[-1] = (a, max(b, last), m + n)
            else:
                merged.append((start, last, n))
        state.set_items(merged)
        state.forget_timers()
        for _, last, _ in merged:
            # A row just at the end of the gap still belongs to the session.
            state.wake_at((last + gap) * 1000 + 1)
        return ()

    def on_timer(state: State, key: tuple, at: int) -> Rows:
        open_ = state.items()
        over = [s for s in open_ if (s[1] + gap) * 1000 < at]
        state.set_items([s for s in open_ if s not in over])
        return [(*key, *s) for s in over]

    return KeyedJob(name, keys, f"{key_ddl}, start long, last long, n long", on_rows, on_timer,
                    items="start long, last long, n long", ts=ts, delay=delay)


def sessions(df: DataFrame, keys: Sequence[str], gap: int, ts: str = "ts") -> DataFrame:
    """The same sessions of a table."""
    found = df.groupBy(*keys, F.session_window(ts, f"{gap} seconds")).agg(
        F.unix_seconds(F.min(ts)).alias("start"), F.unix_seconds(F.max(ts)).alias("last"), F.count("*").alias("n"))
    return found.drop("session_window")
