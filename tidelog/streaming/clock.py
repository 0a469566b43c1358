"""Windows of processing time that close by the clock, also when no more rows come.

An aggregate with a watermark closes a window when later rows arrive. Here a timer per
key and window does, on rows that every task has aggregated before they shuffle. The
time of a row is that of its micro-batch, which the checkpoint keeps, so a replayed batch
puts its rows into the same windows.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tidelog.operators.windows import with_processing_time

BUCKETS = 64  # keys that the values of a distinct count are dealt over
_HELD = 1 << 17  # rows a task holds before it aggregates them


def _aggregated(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per combination of ``names`` and task, with their number ``n``; no shuffle."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def merged() -> pa.Table:
            whole = pa.concat_tables(held).group_by(list(names)).aggregate([("n", "sum")])
            return whole.rename_columns([*names, "n"]).select([*names, "n"])

        for batch in batches:
            ones = pa.array([1] * batch.num_rows, pa.int64())
            held.append(pa.Table.from_batches([batch]).append_column("n", ones))
            if sum(t.num_rows for t in held) > _HELD:
                held = [merged()]
                if held[0].num_rows > _HELD // 2:  # many keys: little left to merge
                    yield from held.pop().to_batches()
        if held:
            yield from merged().to_batches()

    fields = [rows.schema[n] for n in names]
    return rows.select(*names).mapInArrow(work, T.StructType([*fields, T.StructField("n", T.LongType())]))


class _Counts(StatefulProcessor):
    """The sum of ``n`` per key, once its window is over."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "n bigint")

    def _first(self, key: tuple) -> None:
        end = pd.Timestamp(key[-1])
        end = end if end.tzinfo else end.tz_localize("UTC")  # sessions run in UTC
        self.handle.registerTimer(int(end.timestamp() * 1000))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        added = sum(int(part["n"].sum()) for part in rows)
        if self.total.exists():
            added += self.total.get()[0]
        else:
            self._first(key)
        self.total.update((added,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total = self.total.get()[0]
        self.total.clear()
        yield pd.DataFrame([(*key, total)], columns=[*self.names, "n"])

    def close(self) -> None:
        pass


class _Distinct(_Counts):
    """How many different values a key has had, once its window is over."""

    def __init__(self, names: Sequence[str], value: str, kind: str):
        super().__init__(names)
        self.value, self.kind = value, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getMapState("seen", f"value {self.kind}", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.total.exists()
        if not known:
            self._first(key)
        total = self.total.get()[0] if known else 0
        for part in rows:
            for value in part[self.value].dropna().unique().tolist():
                if not self.seen.containsKey((value,)):
                    self.seen.updateValue((value,), (1,))
                    total += 1
        self.total.update((total,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        self.seen.clear()


def clock_counts(rows: DataFrame, keys: Sequence[str], size: str, distinct: str | None = None) -> DataFrame:
    """Rows per key and window of processing time, or different values of ``distinct`` that aren't NULL.

    A window comes out by the first micro-batch after its end, on a service without any
    new row. Columns: ``keys, window_start, window_end, n``. With ``distinct`` a key's
    values are counted in ``BUCKETS`` parts, which come out in the same micro-batch:
    `ClockWindows` adds them up.
    """
    timed = with_processing_time(rows, "__at")
    start = F.window("__at", size)
    timed = timed.withColumn("__window", start).withColumns(
        {"window_start": F.col("__window.start"), "window_end": F.col("__window.end")}
    )
    names = [*keys, "window_start", "window_end"]
    if distinct is None:
        ones = _aggregated(timed, names)
        processor: StatefulProcessor = _Counts(names)
    else:
        timed = timed.withColumn("part", F.pmod(F.xxhash64(distinct), F.lit(BUCKETS)))
        names = [*keys, "part", *names[len(keys) :]]
        ones = _aggregated(timed, [*names, distinct])
        processor = _Distinct(names, distinct, rows.schema[distinct].dataType.simpleString())
    fields = [ones.schema[n] for n in names]
    schema = T.StructType([*fields, T.StructField("n", T.LongType())])
    return ones.groupBy(*names).transformWithStateInPandas(processor, schema, "Append", "processingTime")


@dataclass
class ClockWindows:
    """``foreachBatch`` writer of closed windows; the parts of a distinct count are added up here."""

    path: str
    keys: Sequence[str]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        whole = batch.groupBy(*self.keys, "window_start", "window_end").agg(F.sum("n").alias("n"))
        whole.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id:012d}")


def wait_until_closed(query: StreamingQuery, rows: int, seconds: float = 300) -> None:
    """Waits until the query has read so many rows and holds no open window any more.

    ``seconds`` is for waiting: they begin anew while a micro-batch works on new rows,
    however long that takes.
    """
    until, read, seen = time.monotonic() + seconds, 0, -1
    while time.monotonic() < until:
        if query.exception():
            raise query.exception()
        status = query.status
        if status["isTriggerActive"] and status["isDataAvailable"]:
            until = time.monotonic() + seconds
        for progress in query.recentProgress:
            if progress["batchId"] > seen:
                seen, read = progress["batchId"], read + progress["numInputRows"]
        last = query.lastProgress
        if last and last["stateOperators"] and read >= rows and last["numInputRows"] == 0:
            if sum(state["numRowsTotal"] for state in last["stateOperators"]) == 0:
                return
        time.sleep(0.2)
    raise TimeoutError(f"windows are still open after {seconds} seconds, {read} rows read")
