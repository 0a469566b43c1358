"""Starting streams: checkpoints, triggers and plain sinks."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

# How often the jobs checkpoint, which is how often they commit.
LOG_INTERVAL = "65 seconds"
FEED_INTERVAL = "10 seconds"

# For `start`: state in RocksDB, also in a session whose default keeps it on the heap.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}
_STARTING = threading.Lock()


class LateRowsError(RuntimeError):
    """A bounded run lost rows: its files came in an order that its watermark doesn't allow."""


class _Dropped(StreamingQueryListener):
    """Rows of one run that the watermark dropped; leaves the session when the run ends."""

    def __init__(self, session: SparkSession) -> None:
        self.run: str | None = None
        self._session, self._by_run = session, {}
        self._ended: dict[str, threading.Event] = {}
        session.streams.addListener(self)

    def watch(self, run: str) -> None:
        self.run = run
        if self._end_of(run).is_set():
            self.leave()

    def leave(self) -> None:
        # Not from the thread that delivers events, which would wait for itself.
        threading.Thread(target=self._session.streams.removeListener, args=(self,), daemon=True).start()

    def dropped(self) -> int:
        return self._by_run.get(self.run, 0)

    def wait(self, seconds: float) -> bool:
        return self._end_of(self.run).wait(seconds)

    def _end_of(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        lost = sum(state.numRowsDroppedByWatermark for state in event.progress.stateOperators)
        self._by_run[run] = self._by_run.get(run, 0) + lost

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        self._end_of(run).set()
        if run == self.run:
            self.leave()


class ServiceRun:
    """A query that goes on, with all of a query's attributes and ``late_rows`` so far.

    Late rows are those that the watermark dropped, as state operators count them, in
    the batches that are done. A `LateGate` before the query keeps the rows themselves.
    """

    def __init__(self, query: StreamingQuery, dropped: _Dropped) -> None:
        self._query, self._dropped = query, dropped
        dropped.watch(str(query.runId))

    def __getattr__(self, name: str):
        return getattr(self._query, name)

    @property
    def late_rows(self) -> int:
        return self._dropped.dropped()


class BoundedRun(ServiceRun):
    """A query that takes all input there is and stops.

    Waiting for its end raises if the watermark dropped rows: the files of a table have
    no order, so any loss there is an error. ``late="drop"`` accepts it, as a service does.
    """

    def awaitTermination(self, timeout: float | None = None, late: str = "raise") -> bool | None:
        if late not in ("raise", "drop"):
            raise ValueError(f"late is 'raise' or 'drop', not {late!r}")
        done = self._query.awaitTermination(timeout)
        if timeout is not None and not done:
            return done
        if not self._dropped.wait(60):
            raise TimeoutError("the end of the run was not reported")
        if self.late_rows and late == "raise":
            raise LateRowsError(
                f"{self.late_rows} rows (as state operators count) came after their windows had closed; take all files in one "
                "batch (no max_files), or put them in event order"
            )
        return done


@contextmanager
def _settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Session settings while a query starts, which keeps those it started with."""
    if not conf:
        yield
        return
    with _STARTING:
        before = {name: spark.conf.get(name, None) for name in conf}
        try:
            for name, value in conf.items():
                spark.conf.set(name, value)
            yield
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def start(
    df: DataFrame,
    checkpoint: str,
    *,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    format: str = "parquet",
    path: str | None = None,
    table: str | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    interval: str | None = None,
    name: str | None = None,
    options: dict[str, str] | None = None,
    conf: Mapping[str, str] | None = None,
) -> ServiceRun | BoundedRun:
    """Start a stream into ``each_batch``, a table, or a plain sink.

    ``interval=None`` takes all input there is and stops (`BoundedRun`); else files and
    topic messages appear once per interval, never sooner (`ServiceRun`). Plain sinks: ``parquet``
    or ``json`` with a path, ``kafka``, ``console``, ``noop``, ``memory``.

    State has as many partitions as ``spark.sql.shuffle.partitions`` says when a
    checkpoint is new, and keeps them: choose it for the largest state to come. ``conf`` has
    settings for this query only, such as `ROCKSDB`.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    if name:
        writer = writer.queryName(name)
    if options:
        writer = writer.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if each_batch is not None:
        # A plain function: Spark inspects its signature.
        writer = writer.foreachBatch(lambda batch, batch_id: each_batch(batch, batch_id))
    elif table is None:
        writer = writer.format(format)

    def begin() -> StreamingQuery:
        if each_batch is None and table is not None:
            return writer.format(format).toTable(table)
        return writer.start(path) if path and each_batch is None else writer.start()

    dropped = _Dropped(df.sparkSession)
    try:
        with _settings(df.sparkSession, conf or {}):
            query = begin()
    except BaseException:
        dropped.leave()
        raise
    return BoundedRun(query, dropped) if interval is None else ServiceRun(query, dropped)


def run_to_end(df: DataFrame, checkpoint: str, late: str = "raise", **sink) -> BoundedRun:
    """Process all input there is, then return the finished query."""
    query = start(df, checkpoint, interval=None, **sink)
    query.awaitTermination(late=late)
    return query
