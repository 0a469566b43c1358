"""Server logs, Debezium messages and text lines rebuilt from the given tables.

Column expressions over the Parquet scan, so they prune columns, stay in
generated code and grow with the tables. All take a batch or streaming reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import epoch_millis, to_millis
from tidelog.operators.ordered import running_by_key

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string"
)
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string"
)
LOG_COLUMNS = (
    "client_ip", "client_identity", "userid", "user_agent", "log_time",
    "request_line", "status_code", "size",
)

# The sets the log columns draw from.
BROWSERS = ("Mozilla", "Opera", "Safari", "curl")
METHODS = ("GET", "POST", "PUT", "PATCH")
PATHS = ("/search.html", "/login.html", "/prod.html", "cart.html", "/order.html")
STATUS_CODES = ("200", "201", "204", "400", "401", "403", "301")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(
    spark: SparkSession, path: str, schema: str, max_files: int | None = None
) -> DataFrame:
    """A table's Parquet files as a stream, ``max_files`` per micro-batch.

    The path goes in as a pattern that matches only itself: a plain path must be
    a folder, and a small table may be a single file.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def pick(values: tuple[str, ...], position: Column) -> Column:
    """Element ``position % len(values)`` of a small fixed set."""
    choices = F.array(*[F.lit(v) for v in values])
    return F.get(choices, F.pmod(position, F.lit(len(values))).cast("int"))


def server_logs(events: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """A log line for each event, after the columns of the events to ``keep``."""
    e = F.col("event_id")
    agent = F.concat(
        pick(BROWSERS, e), F.lit("/"), (1 + e % 9).cast("string"), F.lit(".0")
    )
    return events.select(
        *keep,
        F.concat(F.lit("198.51.100."), F.col("user_id").cast("string")).alias("client_ip"),
        F.lit("-").alias("client_identity"),
        F.lit("-").alias("userid"),
        F.when(e % 97 == 0, "///").otherwise(agent).alias("user_agent"),
        to_millis("ts").alias("log_time"),
        F.concat_ws(" ", pick(METHODS, e), pick(PATHS, e), F.lit("HTTP/1.1")).alias(
            "request_line"
        ),
        F.when(e % 101 == 0, "1404")
        .when(e % 103 == 0, F.lit(None))
        .otherwise(pick(STATUS_CODES, e))
        .alias("status_code"),
        (100 + (e * 7919) % 9999900).cast("int").alias("size"),
    )


def dense_logs(events: DataFrame) -> DataFrame:
    """The same log with a hundred lines a minute: event ids are 600 ms apart."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    step = F.make_dt_interval(secs=(F.col("event_id") * 0.6).cast("decimal(18,6)"))
    return server_logs(events.withColumn("ts", start + step))


LOG_JSON = "user_agent string, status_code string, log_time timestamp_ntz"


def lagging_records(events: DataFrame, partitions: int = 2) -> DataFrame:
    """The log as a JSON topic: partition ``p`` (event id modulo their number) is ``p`` days behind."""
    part = (F.col("event_id") % partitions).cast("int")
    behind = events.withColumn("ts", F.col("ts") - F.make_dt_interval(days=part))
    line = F.to_json(F.struct("user_agent", "status_code", "log_time"), {"ignoreNullFields": "false"})
    return server_logs(behind, keep=["event_id"]).select(
        F.lit(None).cast("binary").alias("key"),
        line.cast("binary").alias("value"),
        F.lit("logs").alias("topic"),
        part.alias("partition"),
        F.floor(F.col("event_id") / partitions).alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def disordered_logs(events: DataFrame, every: int = 7, keep: Sequence[str] = ()) -> DataFrame:
    """The log in the order of event ids, every so many lines with a time two hours back."""
    late = F.when(F.col("event_id") % every == 0, F.make_dt_interval(hours=F.lit(2))).otherwise(F.make_dt_interval())
    return server_logs(events.withColumn("ts", F.col("ts") - late), keep)


def debezium_rows(events: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One change per event: ``offset, before, after, op, ts_ms, source``."""
    tuning = {} if hot_rows is None else {"hot_rows": hot_rows}
    scan = running_by_key(
        events.select("user_id", "event_id", "ts").withColumn(
            "num", _int("event_id")
        ),
        keys=["user_id"],
        order="event_id",
        ordinal="rn",
        previous={"old_num": "num"},
        **tuning,
    )
    row_id = _int("user_id").alias("id")
    snapshot = (F.col("rn") == 1) & (F.col("user_id") % 10 == 0)
    op = (
        F.when(F.col("rn") % 5 == 0, "d")
        .when((F.col("rn") % 5 == 1) & ~snapshot, "c")
        .when(snapshot, "r")
        .otherwise("u")
    )
    ts_ms = epoch_millis("ts")
    return scan.select(
        F.col("event_id").alias("offset"),
        F.when(op.isin("u", "d"), F.struct(row_id, F.col("old_num").alias("num"))).alias(
            "before"
        ),
        F.when(op != "d", F.struct(row_id, F.col("num"))).alias("after"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
        F.struct(
            F.lit("test").alias("db"),
            F.lit("test").alias("table"),
            (ts_ms - 5).alias("ts_ms"),
        ).alias("source"),
    )


def _int(name: str) -> Column:
    """The table behind the feed has INT columns; larger ids wrap around."""
    return (F.col(name) % (1 << 31)).cast("int")


def debezium_messages(
    events: DataFrame, wrapped: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """The changes as topic records: ``offset`` and the JSON text ``value``."""
    body = F.struct("before", "after", "op", "ts_ms", "source")
    if wrapped:
        body = F.struct(F.lit("v1").alias("schema"), body.alias("payload"))
    value = F.to_json(body, {"ignoreNullFields": "false"})
    return debezium_rows(events, hot_rows).select("offset", value.alias("value"))


def revenue_orders(orders: DataFrame) -> DataFrame:
    """``order_id, name, revenue``; whole cents keep the sums exact."""
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderpriority").alias("name"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("revenue"),
    )


def text_lines(documents: DataFrame) -> DataFrame:
    return documents.select(F.explode(F.split("text", "\n", -1)).alias("value"))


def topic_records(messages: DataFrame, topic: str = "test", partitions: int = 1) -> DataFrame:
    """Messages with all the columns a topic source has.

    Several ``partitions`` are dealt by the row's id, which is then the key, and
    number their offsets each for themselves, in the order of the messages.
    """
    key, partition = F.lit(None).cast("binary"), F.lit(0)
    if partitions > 1:
        image = F.coalesce(*[F.get_json_object("value", f"$.{p}.id") for p in ("after", "before")])
        messages = messages.withColumn("__id", image).withColumn(
            "partition", F.pmod(F.xxhash64("__id"), F.lit(partitions)).cast("int")
        )
        messages = running_by_key(messages, ["partition"], "offset", ordinal="__place")
        messages = messages.withColumn("offset", F.col("__place") - 1)
        key, partition = F.col("__id").cast("binary"), F.col("partition")
    return messages.select(
        key.alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.alias("partition"),
        "offset",
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def broken_messages(events: DataFrame) -> DataFrame:
    """The change messages with every kind of damage mixed in, by event id.

    Eleven of every thirteen ids are damaged: two tombstones, then one message
    each that is cut off, ``null``, of an unknown op, without op, ``u`` and
    ``d`` without before image, ``c`` without after image, with a word for a
    number in the row, and with one in ``source.ts_ms``.
    """
    kind = F.col("offset") % 13
    no_row = F.lit(None).cast("struct<id:int,num:int>")
    row = F.coalesce("after", "before")
    word = F.struct(row["id"].alias("id"), F.lit("x").alias("num"))
    source = F.struct(
        F.lit("test").alias("db"),
        F.lit("test").alias("table"),
        F.when(kind == 10, "soon")
        .otherwise(F.col("source.ts_ms").cast("string"))
        .alias("ts_ms"),
    )
    op = (
        F.when(kind == 4, "t")
        .when(kind == 5, F.lit(None))
        .when(kind == 6, "u")
        .when(kind == 7, "d")
        .when(kind.between(8, 10), "c")
        .otherwise(F.col("op"))
    )
    before = F.when(~kind.between(4, 10), F.col("before")).otherwise(no_row)
    after = F.when(kind == 8, no_row).when(kind.between(4, 10), row).otherwise(F.col("after"))
    options = {"ignoreNullFields": "false"}

    def message(after_image: Column) -> Column:
        return F.to_json(
            F.struct(
                before.alias("before"), after_image.alias("after"),
                op.alias("op"), "ts_ms", source.alias("source"),
            ),
            options,
        )

    value = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, "")
        .when(kind == 2, "{bad")
        .when(kind == 3, "null")
        .when(kind == 9, message(word))
        .otherwise(message(after))
    )
    return debezium_rows(events).select("offset", value.alias("value"))


def with_schema_changes(events: DataFrame) -> DataFrame:
    """The change messages, with a schema change in place of every tenth event id."""
    ddl = F.concat(F.lit("ALTER TABLE test ADD c"), F.col("offset").cast("string"))
    change = F.to_json(F.struct(ddl.alias("ddl"), F.lit("test").alias("databaseName")))
    return debezium_messages(events).withColumn(
        "value", F.when(F.col("offset") % 10 == 0, change).otherwise(F.col("value"))
    )


# The row types that the schema changes go through, by turns.
ROW_TYPES = (
    (("id", "INT"), ("num", "INT")),
    (("id", "INT"), ("num", "INT"), ("note", "VARCHAR(20)")),
    (("id", "INT"), ("num", "BIGINT"), ("note", "VARCHAR(20)")),
    (("id", "INT"), ("num", "VARCHAR(20)")),
)
SCHEMA_EVERY = 50


def with_schema_history(events: DataFrame) -> DataFrame:
    """The change messages, with a schema change in place of every 50th event id.

    All rows have ``id``, ``num`` as text with zeros before it, and ``note``, whatever
    the row type says.
    """
    turn = F.floor(F.col("offset") / SCHEMA_EVERY) % len(ROW_TYPES)
    kinds = [
        F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("typeName")) for n, t in kind])
        for kind in ROW_TYPES
    ]
    columns = F.get(F.array(*kinds), turn.cast("int"))
    table = F.struct(F.struct(columns.alias("columns")).alias("table"))
    schema = F.to_json(F.struct(F.lit("ALTER TABLE test").alias("ddl"), F.array(table).alias("tableChanges")))

    def image(name: str) -> Column:
        row = F.col(name)
        filled = F.lpad(row["num"].cast("string"), 12, "0").alias("num")
        note = F.concat(F.lit("n"), F.col("offset").cast("string")).alias("note")
        return F.when(row.isNotNull(), F.struct(row["id"].alias("id"), filled, note)).alias(name)

    body = F.to_json(F.struct(image("before"), image("after"), "op", "ts_ms", "source"), {"ignoreNullFields": "false"})
    value = F.when(F.col("offset") % SCHEMA_EVERY == 0, schema).otherwise(body)
    return debezium_rows(events).select("offset", value.alias("value"))
