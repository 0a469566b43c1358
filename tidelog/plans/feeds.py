"""Jobs over change feeds: append log, changelog to a topic, keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import wall_clock
from tidelog.operators.changes import latest_by_key
from tidelog.operators.debezium import append_log, changelog, to_debezium_json
from tidelog.streaming.sinks import JSON_TIME, record_key

# Fixed value: the table behind the feed.
TEST_TABLE = "id int, num int"


def append_rows(messages: DataFrame, zone: str = "UTC", **options) -> DataFrame:
    """Rows of the append log: ``id, num, op, op_ts``.

    ``op_ts`` is the time the change was read, as wall-clock time in ``zone``:
    the table column has no zone, so the conversion is spelled out.
    """
    log = append_log(
        messages, TEST_TABLE, {"op": "op", "op_ts": "ingestion-timestamp"}, **options
    )
    return log.withColumn("op_ts", wall_clock("op_ts", zone))


def feed_changes(messages: DataFrame, zone: str = "UTC", **options) -> DataFrame:
    """Full changelog with ``operation_ts``, the time of the change at its source."""
    changes = changelog(
        messages, TEST_TABLE, {"operation_ts": "source.timestamp"}, **options
    )
    return changes.withColumn("operation_ts", wall_clock("operation_ts", zone))


def topic_messages(changes: DataFrame) -> DataFrame:
    """The changelog as topic records, in ``seq`` order per key."""
    return changes.select(
        F.col("seq").alias("offset"),
        to_debezium_json(changes, ["id", "num", "operation_ts"]).alias("value"),
    )


def keyed_messages(changes: DataFrame) -> DataFrame:
    """The same for a topic of several partitions: each record has its row's key.

    ``partition`` and ``offset`` say where the change came from and in which order.
    """
    return changes.select(
        record_key(["id"]),
        to_debezium_json(changes, ["id", "num", "operation_ts"]).alias("value"),
        "partition",
        F.col("seq").alias("offset"),
    )


def received_changes(records: DataFrame) -> DataFrame:
    """The changelog read back from what `topic_messages` or `keyed_messages` wrote."""
    return changelog(
        records,
        "id int, num int, operation_ts timestamp_ntz",
        partition="partition" if "partition" in records.columns else None,
        json_options={"timestampNTZFormat": JSON_TIME},
    )


def current_rows(changes: DataFrame) -> DataFrame:
    """The keyed table: newest row per ``id``."""
    partition = "partition" if "partition" in changes.columns else None
    return latest_by_key(changes, ["id"], partition=partition)
