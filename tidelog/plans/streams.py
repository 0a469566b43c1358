"""The streaming jobs. Each starts one query under ``root`` and returns it.

``root/checkpoint`` holds offsets and state, ``root/data`` the output (unless a
sink names its own place). ``interval=None`` takes all input there is and
stops, which is how tests and back-fills run; the services use `LOG_INTERVAL`
and `FEED_INTERVAL`.

Spark drops a late row by the watermark of the batch before: a row that comes in
the first batch after its window closed is still counted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.functions import wall_clock, words
from tidelog.operators.windows import slowest_watermark, window_bounds, with_event_time, word_counts
from tidelog.plans import feeds, logs
from tidelog.streaming.clock import ClockWindows, clock_counts
from tidelog.streaming.committed import CommittedBatches, send_to_files, send_to_topic
from tidelog.streaming.keyed import KeyedFiles
from tidelog.streaming.late import LateGate
from tidelog.streaming.packed import PackedTable
from tidelog.streaming.retractions import RetractingSum
from tidelog.streaming.run import LOG_INTERVAL, ROCKSDB, start
from tidelog.streaming.sinks import (
    DURABLE_OPTIONS,
    JdbcUpsert,
    OrderedBatches,
    PartitionedJson,
    json_records,
    text_records,
)

# How far out of order log lines may come.
ORDERED_DELAY = "15 seconds"
COUNT_DELAY = "0 seconds"


def client_errors(
    log_stream: DataFrame, root: str, sink: str = "parquet", interval: str | None = None
) -> StreamingQuery:
    """Client errors into files, or to nowhere (``noop``) or the screen (``console``)."""
    return start(
        logs.client_errors(log_stream),
        f"{root}/checkpoint",
        format=sink,
        path=f"{root}/data" if sink in ("parquet", "json") else None,
        interval=interval,
    )


def ordered_browser_counts(
    log_stream: DataFrame, root: str, size: str = "1 minute", interval: str | None = None
) -> StreamingQuery:
    timed = with_event_time(log_stream, "log_time", ORDERED_DELAY)
    return start(
        logs.browser_counts(timed, size),
        f"{root}/checkpoint",
        each_batch=OrderedBatches(f"{root}/data", logs.ordered_browser_counts),
        interval=interval,
    )


def slowest_browser_counts(
    parts: Sequence[DataFrame], root: str, size: str = "1 hour", interval: str | None = None
) -> StreamingQuery:
    """Counts over the partitions of a topic; a window closes when all of them have passed it."""
    view = slowest_watermark(parts, "log_time", ORDERED_DELAY)
    counts = window_bounds(logs.browser_counts(view, size))
    return start(_walls(counts), f"{root}/checkpoint", path=f"{root}/data", interval=interval)


def late_gate(
    log_stream: DataFrame, root: str, size: str = "1 minute", interval: str | None = None, **options
) -> StreamingQuery:
    """Log rows in time under ``root/rows/kept``, and the late ones under ``root/rows/late``."""
    gate = LateGate(f"{root}/rows", "log_time", ORDERED_DELAY, size, **options)
    return start(log_stream, f"{root}/checkpoint", each_batch=gate, interval=interval)


def realtime_counts(
    view: DataFrame,
    root: str,
    size: str = "10 seconds",
    topic_options: dict[str, str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Counts as JSON records: to a topic, or recorded as text files under ``root``."""
    counts = logs.status_counts(view, size)
    target = (
        {"format": "kafka", "options": topic_options}
        if topic_options
        else {"format": "text", "path": f"{root}/data"}
    )
    return start(
        json_records(logs.realtime_columns(counts)),
        f"{root}/checkpoint",
        interval=interval,
        **target,
    )


def warehouse_files(
    view: DataFrame,
    root: str,
    size: str = "1 minute",
    zone: str = "UTC",
    interval: str | None = None,
) -> StreamingQuery:
    """Counts as partitioned JSON files with completion markers."""
    sink = PartitionedJson(
        f"{root}/data",
        lambda batch: logs.warehouse_columns(batch, zone, keep_window=True),
        zone=zone,
        checkpoint=f"{root}/checkpoint",
    )
    return start(
        logs.status_counts(view, size), f"{root}/checkpoint", each_batch=sink, interval=interval
    )


def lake_counts(
    view: DataFrame,
    root: str,
    table: str,
    size: str = "5 seconds",
    format: str = "parquet",
    interval: str | None = None,
) -> StreamingQuery:
    """Counts appended to a table partitioned by day."""
    return start(
        logs.warehouse_columns(logs.status_counts(view, size)),
        f"{root}/checkpoint",
        table=table,
        format=format,
        partition_by=["dt"],
        interval=interval,
    )


def packed_counts(
    view: DataFrame, table: PackedTable, root: str, size: str = "5 seconds", interval: str | None = None
) -> StreamingQuery:
    """Counts appended to a table by day whose closed days can be packed into few files."""
    counts = logs.warehouse_columns(logs.status_counts(view, size))
    return start(counts, f"{root}/checkpoint", each_batch=table, interval=interval)


def two_sinks(
    log_stream: DataFrame, root: str, size: str = "1 minute", interval: str | None = None
) -> tuple[StreamingQuery, StreamingQuery]:
    """One view into the topic and the files: two queries, each with its own state."""
    view = timed_view(log_stream)
    return (
        realtime_counts(view, f"{root}/topic", interval=interval),
        warehouse_files(view, f"{root}/files", size, interval=interval),
    )


def timed_view(log_stream: DataFrame) -> DataFrame:
    return with_event_time(logs.browsers_view(log_stream), "log_time", COUNT_DELAY)


def distinct_ips(
    log_stream: DataFrame, root: str, size: str = "10 seconds", interval: str | None = None
) -> StreamingQuery:
    timed = with_event_time(log_stream, "log_time", COUNT_DELAY)
    counts = logs.distinct_ips(timed, size)
    return start(_walls(counts), f"{root}/checkpoint", path=f"{root}/data", interval=interval)


def windowed_words(
    lines: DataFrame,
    root: str,
    value: str,
    col: str,
    size: str = "30 seconds",
    interval: str | None = None,
) -> StreamingQuery:
    timed = with_event_time(lines, col, COUNT_DELAY)
    counts = word_counts(timed, value, col, size).select(
        "word", F.col("window.start").alias("window_start"), "n"
    )
    return start(_walls(counts), f"{root}/checkpoint", path=f"{root}/data", interval=interval)


def clock_distinct_ips(
    log_stream: DataFrame, root: str, size: str = "10 seconds", interval: str = LOG_INTERVAL
) -> StreamingQuery:
    """Distinct addresses per window of processing time, which closes by the clock."""
    counts = clock_counts(log_stream.select("client_ip"), [], size, distinct="client_ip")
    sink = ClockWindows(f"{root}/data", [])
    return start(counts, f"{root}/checkpoint", each_batch=sink, interval=interval, conf=ROCKSDB)


def clock_words(
    lines: DataFrame, root: str, value: str = "value", size: str = "30 seconds", interval: str = LOG_INTERVAL
) -> StreamingQuery:
    """Words per window of processing time, which closes by the clock."""
    ones = lines.select(F.explode(words(value)).alias("word"))
    sink = ClockWindows(f"{root}/data", ["word"])
    counts = clock_counts(ones, ["word"], size)
    return start(counts, f"{root}/checkpoint", each_batch=sink, interval=interval, conf=ROCKSDB)


def live_counter(
    view: DataFrame,
    root: str,
    jdbc: JdbcUpsert | None = None,
    kind: str = "bigint",
    interval: str | None = None,
) -> StreamingQuery:
    """The running number of rows, upserted as one row per batch."""
    counter = logs.total_count(view, kind)
    if jdbc is not None:
        return start(
            counter, f"{root}/checkpoint", each_batch=jdbc, mode="update", interval=interval
        )
    table = counter_table(view.sparkSession, root)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        changes = batch.withColumns(
            {"seq": F.lit(batch_id).cast("bigint"), "kind": F.lit("+U")}
        )
        table.upsert(changes, batch_id)

    return start(
        counter, f"{root}/checkpoint", each_batch=upsert, mode="update", interval=interval
    )


def counter_table(spark: SparkSession, root: str) -> KeyedFiles:
    return KeyedFiles(spark, f"{root}/data", ["id"], schema="id int, num bigint")


def feed_to_topic(
    messages: DataFrame,
    root: str,
    topic_options: dict[str, str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Change messages passed on unchanged, each with the id of its origin."""
    sent = text_records(messages, message_id=["topic", "partition", "offset"])
    if topic_options:
        target = {"format": "kafka", "options": {**DURABLE_OPTIONS, **topic_options}}
    else:
        target = {"format": "parquet", "path": f"{root}/data"}
    return start(sent, f"{root}/checkpoint", interval=interval, **target)


def feed_to_committed_topic(
    messages: DataFrame,
    root: str,
    topic_options: dict[str, str] | None = None,
    interval: str | None = None,
    send: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Change messages passed on unchanged; `CommittedReader` gives each of them once."""
    if send is None:
        send = (
            send_to_topic({**DURABLE_OPTIONS, **topic_options}) if topic_options else send_to_files(f"{root}/data")
        )
    sent = text_records(messages, message_id=["topic", "partition", "offset"])
    sink = CommittedBatches(f"{root}/manifest", "feed", send)
    return start(sent, f"{root}/checkpoint", each_batch=sink, interval=interval)


def append_log(
    records: DataFrame, root: str, interval: str | None = None, **options
) -> StreamingQuery:
    """Change feed to an append-only table at a fixed path."""
    rows = feeds.append_rows(records, **options)
    return start(rows, f"{root}/checkpoint", path=f"{root}/data", interval=interval)


def changelog_topic(
    records: DataFrame,
    root: str,
    topic_options: dict[str, str] | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Change feed re-written to a topic by key, an update as two messages.

    Recorded under ``root`` the records keep the partition and order of their origin.
    """
    sent = feeds.keyed_messages(feeds.feed_changes(records, partition="partition"))
    if topic_options:
        sent = sent.select("key", "value")
        target = {"format": "kafka", "options": topic_options}
    else:
        target = {"format": "parquet", "path": f"{root}/data"}
    return start(sent, f"{root}/checkpoint", interval=interval, **target)


def keyed_table(
    records: DataFrame, table: KeyedFiles, root: str, interval: str | None = None
) -> StreamingQuery:
    """Change feed to a table with one row per ``id``."""
    changes = feeds.feed_changes(records, partition=table.partition)
    return start(changes, f"{root}/checkpoint", each_batch=table, interval=interval)


def revenue_retractions(
    orders: DataFrame, root: str, compact: bool = False, interval: str | None = None
) -> StreamingQuery:
    sink = RetractingSum(
        f"{root}/data", ["name"], "revenue", "order_id", "rev_sum", compact=compact
    )
    return start(orders, f"{root}/checkpoint", each_batch=sink, interval=interval)


def _walls(df: DataFrame) -> DataFrame:
    """Window bounds as the wall-clock times a table stores."""
    bounds = [c for c in df.columns if c.startswith("window_")]
    return df.withColumns({c: wall_clock(c) for c in bounds})
