"""Every registered query with its SQL twin.

A query takes (spark, folder of Parquet tables) and returns a DataFrame over
the whole tables. ``stream_*`` queries run a stream to the end of its input and
return what its sink holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles as sql
from tidelog.functions import epoch_millis, json_string, millis_to_ntz, regexp_first, wall_clock
from tidelog.operators.changes import retract_totals
from tidelog.operators.debezium import (
    VIRTUAL_COLUMNS,
    append_log,
    changes_of,
    decode,
    split_errors,
    split_schema_changes,
)
from tidelog.operators.ordered import running_by_key
from tidelog.operators.schema_history import decode_as_of
from tidelog.operators.windows import tumble, with_processing_time, word_counts
from tidelog.plans import catalog, feeds, logs, revenue, streams
from tidelog.session import scratch_dir
from tidelog.sources import rebuilt, synthetic
from tidelog.sources.files import (
    WAREHOUSE_SCHEMA,
    from_name,
    read_partitioned_json,
    text_stream,
)
from tidelog.sources.topics import (
    drop_replays,
    json_rows,
    record_partitions,
    recorded_partitions,
    recorded_topic,
)
from tidelog.streaming.clock import wait_until_closed
from tidelog.streaming.committed import CommittedReader, send_to_files
from tidelog.streaming.keyed import BucketedFiles, KeyedFiles
from tidelog.streaming.late import kept_rows, late_rows
from tidelog.streaming.packed import PackedTable
from tidelog.streaming.run import run_to_end
from tidelog.streaming.sinks import json_records, message_id

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle:
            ORACLES[name] = oracle
        return query

    return add


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return rebuilt.table(spark, sf, "events")


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return rebuilt.server_logs(_events(spark, sf))


def _view(spark: SparkSession, sf: str) -> DataFrame:
    return logs.browsers_view(_logs(spark, sf))


def _messages(spark: SparkSession, sf: str, wrapped: bool = False) -> DataFrame:
    return rebuilt.debezium_messages(_events(spark, sf), wrapped)


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return rebuilt.revenue_orders(rebuilt.table(spark, sf, "orders"))


# --- server logs: projections, filters, functions --------------------------------

_LOG_ROWS = f"WITH {sql.LOGS} SELECT * FROM logs"


@register("server_logs_all", _LOG_ROWS)
def _(spark, sf):
    return _logs(spark, sf).select("*")


@register(
    "client_errors",
    f"""WITH {sql.LOGS} SELECT log_time, request_line, status_code, size FROM logs
    WHERE status_code SIMILAR TO '4[0-9][0-9]'""",
)
def _(spark, sf):
    return logs.client_errors(_logs(spark, sf))


@register("browsers_view", f"WITH {sql.LOGS} SELECT * FROM browsers")
def _(spark, sf):
    _view(spark, sf).createOrReplaceTempView("browsers")
    return spark.table("browsers")


@register(
    "page_paths",
    f"""WITH {sql.LOGS} SELECT request_line,
      nullif(regexp_extract(request_line, '/[a-z]+', 0), '') AS page FROM logs""",
)
def _(spark, sf):
    return _logs(spark, sf).select(
        "request_line", regexp_first("request_line", "/[a-z]+").alias("page")
    )


@register(
    "watermark_bound",
    f"WITH {sql.LOGS} SELECT log_time, log_time - INTERVAL 15 SECOND AS bound FROM logs",
)
def _(spark, sf):
    bound = F.col("log_time") - F.expr("interval 15 seconds")
    return _logs(spark, sf).select("log_time", bound.alias("bound"))


@register(
    "epoch_round_trip",
    """SELECT event_id, epoch_ms(date_trunc('millisecond', ts)) AS ms, date_trunc('millisecond', ts) AS cut_ts
    FROM events""",
)
def _(spark, sf):
    ms = epoch_millis("ts")
    return _events(spark, sf).select(
        "event_id", ms.alias("ms"), millis_to_ntz(ms).alias("cut_ts")
    )


@register(
    "limit_ordered",
    f"WITH {sql.LOGS} SELECT * FROM browsers ORDER BY log_time, browser, status_code LIMIT 10",
)
def _(spark, sf):
    return _view(spark, sf).orderBy("log_time", "browser", "status_code").limit(10)


# --- server logs: windows -----------------------------------------------------------


def _browser_counts(size: str) -> Query:
    return lambda spark, sf: logs.ordered_browser_counts(
        logs.browser_counts(_logs(spark, sf), size)
    )


register("browser_counts_ordered", sql.browser_counts("1 minute"))(_browser_counts("1 minute"))
register("browser_counts_1h", sql.browser_counts("1 hour"))(_browser_counts("1 hour"))
register("browser_counts_1d", sql.browser_counts("1 day"))(_browser_counts("1 day"))


def _status_counts(size: str) -> Query:
    return lambda spark, sf: logs.realtime_columns(
        logs.status_counts(_view(spark, sf), size)
    )


register("status_counts_10s", sql.status_counts("10 seconds"))(_status_counts("10 seconds"))
register("status_counts_1d", sql.status_counts("1 day"))(_status_counts("1 day"))


def _warehouse(size: str) -> Query:
    return lambda spark, sf: logs.warehouse_columns(
        logs.status_counts(_view(spark, sf), size)
    )


register("dw_counts_1m", sql.warehouse("1 minute"))(_warehouse("1 minute"))
register("dw_counts_1h", sql.warehouse("1 hour"))(_warehouse("1 hour"))
register("lake_counts_5s", sql.warehouse("5 seconds"))(_warehouse("5 seconds"))


@register(
    "log_windows_tvf",
    f"""WITH {sql.LOGS}, w AS (
      SELECT *, time_bucket(INTERVAL '10 seconds', log_time) AS window_start FROM logs)
    SELECT client_ip, log_time, window_start,
      window_start + INTERVAL '10 seconds' AS window_end,
      window_start + INTERVAL '10 seconds' - INTERVAL 1 MILLISECOND AS window_time FROM w""",
)
def _(spark, sf):
    return tumble(_logs(spark, sf), "log_time", "10 seconds").select(
        "client_ip", "log_time", "window_start", "window_end", "window_time"
    )


def _distinct_legacy(size: str) -> Query:
    # A fixed clock in place of the processing time: the end of each window.
    return lambda spark, sf: logs.distinct_ips_legacy(
        _logs(spark, sf), size, clock=F.col("window_end")
    )


def _distinct(size: str) -> Query:
    return lambda spark, sf: logs.distinct_ips(_logs(spark, sf), size)


register("distinct_ip_legacy", sql.distinct_ips("10 seconds", legacy=True))(
    _distinct_legacy("10 seconds")
)
register("distinct_ip_tvf", sql.distinct_ips("10 seconds"))(_distinct("10 seconds"))
register("distinct_ip_1d", sql.distinct_ips("1 day"))(_distinct("1 day"))


@register(
    "total_count",
    f"WITH {sql.LOGS} SELECT CAST(1 AS INTEGER) AS id, count(*) AS num FROM browsers",
)
def _(spark, sf):
    return logs.total_count(_view(spark, sf))


@register(
    "total_count_bigint",
    f"WITH {sql.LOGS} SELECT CAST(1 AS INTEGER) AS id, count(*) AS num FROM browsers",
)
def _(spark, sf):
    return logs.total_count(_view(spark, sf), "bigint")


@register(
    "realtime_topic_json",
    f"""WITH {sql.LOGS}, counted AS (
      SELECT browser, status_code, time_bucket(INTERVAL '10 seconds', log_time)
        + INTERVAL '10 seconds' - INTERVAL 1 MILLISECOND AS end_time, count(*) AS requests
      FROM browsers GROUP BY 1, 2, 3)
    SELECT '{{"browser":' || coalesce('"' || browser || '"', 'null')
      || ',"status_code":' || coalesce('"' || status_code || '"', 'null')
      || ',"end_time":"' || strftime(end_time, '%Y-%m-%d %H:%M:%S.%g')
      || '","requests":' || requests || '}}' AS value FROM counted""",
)
def _(spark, sf):
    counts = logs.status_counts(_view(spark, sf), "10 seconds")
    return json_records(logs.realtime_columns(counts))


# --- word counts ---------------------------------------------------------------------


@register(
    "word_count_lines",
    f"""WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS value FROM documents),
    ones AS (SELECT unnest({sql.words('value')}) AS word FROM lines)
    SELECT word, count(*) AS n FROM ones GROUP BY word""",
)
def _(spark, sf):
    return word_counts(rebuilt.text_lines(rebuilt.table(spark, sf, "documents")))


@register(
    "word_count_fixed_clock",
    f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value FROM documents),
    ones AS (SELECT doc_id % 3600 // 30 AS slot, unnest({sql.words('value')}) AS word FROM lines)
    SELECT word, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(slot * 30) AS window_start, count(*) AS n
    FROM ones GROUP BY word, slot""",
)
def _(spark, sf):
    """Processing-time windows with a clock that gives each document its second of an hour."""
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    clock = start + F.make_dt_interval(secs=(F.col("doc_id") % 3600).cast("decimal(18,6)"))
    docs = with_processing_time(rebuilt.table(spark, sf, "documents"), "at", clock)
    lines = docs.select("at", F.explode(F.split("text", "\n", -1)).alias("value"))
    counts = word_counts(lines, "value", "at", "30 seconds")
    return counts.select("word", F.col("window.start").alias("window_start"), "n")


@register(
    "word_count_windows",
    f"""WITH {sql.LOGS}, ones AS (
      SELECT unnest({sql.words('request_line')}) AS word,
        time_bucket(INTERVAL '30 seconds', log_time) AS window_start FROM logs)
    SELECT word, window_start, count(*) AS n FROM ones GROUP BY 1, 2""",
)
def _(spark, sf):
    counts = word_counts(_logs(spark, sf), "request_line", "log_time", "30 seconds")
    return counts.select("word", F.col("window.start").alias("window_start"), "n")


# --- grouped sums ---------------------------------------------------------------------

_REVENUE = """SELECT o_orderpriority AS name,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS rev_sum
FROM orders GROUP BY 1"""


@register("revenue_by_name_api", _REVENUE)
def _(spark, sf):
    return revenue.by_api(_orders(spark, sf))


@register("revenue_by_name_sql", _REVENUE)
def _(spark, sf):
    return revenue.by_sql(_orders(spark, sf))


@register("revenue_retractions", f"WITH {sql.RETRACT}")
def _(spark, sf):
    return revenue.retractions(_orders(spark, sf))


@register(
    "revenue_totals_compact",
    f"SELECT '+I' AS kind, true AS added, name, rev_sum FROM ({_REVENUE}) r",
)
def _(spark, sf):
    return retract_totals(_orders(spark, sf), ["name"], "revenue", "rev_sum")


# --- change feeds ----------------------------------------------------------------------

_APPEND = f"WITH {sql.CHANGES} SELECT id, log_num AS num, op, cut_ts AS op_ts FROM log"


@register("cdc_append_log", _APPEND)
def _(spark, sf):
    return feeds.append_rows(_messages(spark, sf))


@register("cdc_append_log_wrapped", _APPEND)
def _(spark, sf):
    return feeds.append_rows(_messages(spark, sf, wrapped=True), wrapped=True)


def _metadata_query(name: str) -> Query:
    def query(spark, sf):
        rows = append_log(
            _messages(spark, sf, wrapped=True),
            feeds.TEST_TABLE,
            {"meta": name},
            wrapped=True,
            keep=["offset"],
        )
        kind = dict(rows.dtypes)["meta"]
        if kind == "timestamp":
            return rows.withColumn("meta", wall_clock("meta"))
        if kind.startswith("map"):
            entries = F.array_sort(F.map_entries("meta"))
            return rows.withColumn("meta", F.to_json(F.map_from_entries(entries)))
        return rows

    return query


for _name, _field, _sql in (
    ("schema", "schema", "'v1'"),
    ("op", "op", "op"),
    ("ingestion_ts", "ingestion-timestamp", "cut_ts"),
    ("source_ts", "source.timestamp", "cut_ts - INTERVAL 5 MILLISECOND"),
    ("source_db", "source.database", "'test'"),
    ("source_schema", "source.schema", "CAST(NULL AS VARCHAR)"),
    ("source_table", "source.table", "'test'"),
    (
        "source_properties",
        "source.properties",
        """'{"db":"test","table":"test","ts_ms":"' || (epoch_ms(cut_ts) - 5) || '"}'""",
    ),
):
    register(f"cdc_meta_{_name}", sql.metadata(_sql))(_metadata_query(_field))


@register(
    "cdc_virtual_columns",
    f"""WITH {sql.CHANGES} SELECT "offset", id, log_num AS num, 'test' AS database_name,
      'test' AS table_name, cut_ts - INTERVAL 5 MILLISECOND AS op_ts FROM log""",
)
def _(spark, sf):
    rows = append_log(
        _messages(spark, sf), feeds.TEST_TABLE, VIRTUAL_COLUMNS, keep=["offset"]
    )
    return rows.withColumn("op_ts", wall_clock("op_ts"))


@register("cdc_changelog", f"WITH {sql.CHANGES} SELECT * FROM full_log")
def _(spark, sf):
    return feeds.feed_changes(_messages(spark, sf))


@register(
    "cdc_to_debezium_json",
    f"""WITH {sql.CHANGES}, images AS (
      SELECT seq, kind IN ('+I', '+U') AS added,
        '{{"id":' || id || ',"num":' || coalesce(CAST(num AS VARCHAR), 'null')
        || ',"operation_ts":"' || strftime(operation_ts, '%Y-%m-%d %H:%M:%S.%g')
        || '"}}' AS image FROM full_log)
    SELECT seq AS "offset", '{{"before":' || CASE WHEN added THEN 'null' ELSE image END
      || ',"after":' || CASE WHEN added THEN image ELSE 'null' END
      || ',"op":"' || CASE WHEN added THEN 'c' ELSE 'd' END || '"}}' AS value
    FROM images""",
)
def _(spark, sf):
    return feeds.topic_messages(feeds.feed_changes(_messages(spark, sf)))


_LATEST = f"""WITH {sql.CHANGES}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS newest FROM full_log)
SELECT id, num, operation_ts FROM ranked WHERE newest = 1 AND kind IN ('+I', '+U')"""


@register("cdc_latest_by_key", _LATEST)
def _(spark, sf):
    return feeds.current_rows(feeds.feed_changes(_messages(spark, sf)))


@register("cdc_round_trip", _LATEST)
def _(spark, sf):
    sent = feeds.topic_messages(feeds.feed_changes(_messages(spark, sf)))
    return feeds.current_rows(feeds.received_changes(sent))


@register("cdc_latest_partitioned", _LATEST)
def _(spark, sf):
    """Messages over eight topic partitions, with offsets that start again in each."""
    records = rebuilt.topic_records(_messages(spark, sf), partitions=8)
    return feeds.current_rows(feeds.feed_changes(records, partition="partition"))


@register(
    "cdc_schema_changes",
    """SELECT event_id AS "offset", CASE WHEN event_id % 10 = 0 THEN 'schema' ELSE 'row' END AS kind,
      CASE WHEN event_id % 10 = 0 THEN 'ALTER TABLE test ADD c' || event_id END AS ddl FROM events""",
)
def _(spark, sf):
    changes, others = split_schema_changes(rebuilt.with_schema_changes(_events(spark, sf)))
    decoded = decode(changes, feeds.TEST_TABLE)
    kept = decoded.where(F.col("decode_error").isNull())
    ddl = F.get_json_object("value", "$.ddl").alias("ddl")
    return kept.select("offset", F.lit("row").alias("kind"), F.lit(None).cast("string").alias("ddl")).unionAll(
        others.select("offset", F.lit("schema"), ddl)
    )


@register("cdc_schema_history", sql.schema_history())
def _(spark, sf):
    """Messages between schema changes, each read by the row type in force."""
    decoded = decode_as_of(
        rebuilt.with_schema_history(_events(spark, sf)), "id int, num string, note string",
        dict(rebuilt.ROW_TYPES[0]), insert_snapshots=True,
    )
    return changes_of(decoded, keep=["schema_version"])


_BROKEN = f"""WITH {sql.CHANGES}, judged AS (
  SELECT *, "offset" % 13 AS k, CASE "offset" % 13
    WHEN 2 THEN 'malformed message' WHEN 3 THEN 'malformed message'
    WHEN 4 THEN 'unknown op' WHEN 5 THEN 'no op'
    WHEN 6 THEN 'no before image' WHEN 7 THEN 'no before image'
    WHEN 8 THEN 'no after image'
    WHEN 10 THEN 'source.ts_ms is not a number' END AS decode_error
  FROM msgs WHERE "offset" % 13 NOT IN (0, 1))"""


@register(
    "cdc_bad_messages",
    f"""{_BROKEN} SELECT "offset", decode_error, k IN (2, 3, 9) AS bad_fields FROM judged""",
)
def _(spark, sf):
    messages = rebuilt.broken_messages(_events(spark, sf))
    decoded = decode(messages, feeds.TEST_TABLE, ["source.timestamp"])
    return decoded.select("offset", "decode_error", "bad_fields")


@register(
    "cdc_side_output",
    f"""{_BROKEN} SELECT "offset", decode_error FROM judged WHERE decode_error IS NOT NULL""",
)
def _(spark, sf):
    decoded = decode(rebuilt.broken_messages(_events(spark, sf)), feeds.TEST_TABLE, ["source.timestamp"])
    _, bad = split_errors(decoded)
    return bad.select("offset", "decode_error")


@register(
    "json_topic_skip",
    "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 7 <> 0",
)
def _(spark, sf):
    """Documents as a JSON topic in which every seventh record is cut off."""
    docs = rebuilt.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    whole = F.to_json(F.struct("doc_id", "lang", "n_chars"))
    records = docs.select(F.when(F.col("doc_id") % 7 == 0, F.substring(whole, 2, 1000)).otherwise(whole).alias("value"))
    return json_rows(records, "doc_id bigint, lang string, n_chars bigint", on_error="skip")


@register(
    "json_string_messages",
    "SELECT doc_id, CASE WHEN doc_id % 5 <> 0 THEN text END AS text FROM documents",
)
def _(spark, sf):
    """Texts as JSON strings, every fifth without its closing quote."""
    docs = rebuilt.table(spark, sf, "documents").select("doc_id", "text")
    pair = F.to_json(F.struct(F.col("text").alias("t")))
    cut = F.when(F.col("doc_id") % 5 == 0, 7).otherwise(6)
    quoted = F.substring(pair, F.lit(6), F.length(pair) - cut)
    return docs.select("doc_id", json_string(quoted, on_error="skip").alias("text"))


@register(
    "cdc_append_log_skip",
    f"""{_BROKEN} SELECT "offset", id,
      CASE WHEN k = 9 THEN NULL WHEN k > 10 AND op = 'd' THEN old_num ELSE num END AS num,
      cut_ts - INTERVAL 5 MILLISECOND AS op_ts
    FROM judged WHERE decode_error IS NULL AND (k = 9 OR op <> 'r')""",
)
def _(spark, sf):
    rows = append_log(
        rebuilt.broken_messages(_events(spark, sf)),
        feeds.TEST_TABLE,
        {"op_ts": "source.timestamp"},
        on_error="skip",
        keep=["offset"],
    )
    return rows.withColumn("op_ts", wall_clock("op_ts"))


# --- synthetic sources, one row per row of a table -------------------------------------


@register(
    "orders_synthetic",
    f"""SELECT {sql.draw('order_uid', 'o_orderkey')} AS order_uid,
      {sql.draw('product_id', 'o_orderkey')} AS product_id,
      CAST(CAST({sql.draw('price', 'o_orderkey')} % 1000000000000000 AS DECIMAL(18, 0))
        * CAST(0.01 AS DECIMAL(3, 2)) AS DECIMAL(32, 2)) AS price,
      date_trunc('millisecond', o_orderdate) AS order_time FROM orders""",
)
def _(spark, sf):
    rows = synthetic.random_rows(
        rebuilt.table(spark, sf, "orders"), synthetic.ORDERS, "o_orderkey",
        now=F.col("o_orderdate"),
    )
    return rows


_BITS = {c: sql.log_bits(c, "event_id") for c in synthetic.LOG_DIGITS}


@register(
    "server_logs_synthetic",
    f"""WITH drawn AS (SELECT ts, 1 + ({_BITS['client_ip']} >> 24) % 223 AS first,
      {", ".join(f"{bits} AS {c}_bits" for c, bits in _BITS.items())} FROM events)
    SELECT CASE WHEN first IN (10, 100, 127, 169, 172, 192, 198, 203) THEN 11 ELSE first END
        || '.' || (client_ip_bits >> 16) % 256 || '.' || (client_ip_bits >> 8) % 256
        || '.' || client_ip_bits % 256 AS client_ip,
      '-' AS client_identity, '-' AS userid,
      {sql.values(rebuilt.BROWSERS)}[browser_bits % 4 + 1] || '/'
        || (1 + version_bits % 120) || '.0' AS user_agent,
      date_trunc('millisecond', ts)
        - to_milliseconds(5000 + log_time_bits % 60000) AS log_time,
      {sql.values(rebuilt.METHODS)}[method_bits % 4 + 1] || ' '
        || {sql.values(rebuilt.PATHS)}[path_bits % 5 + 1]
        || ' ' || {sql.values(synthetic.PROTOCOLS)}[protocol_bits % 3 + 1] AS request_line,
      {sql.values(rebuilt.STATUS_CODES)}[status_code_bits % 7 + 1] AS status_code,
      CAST(100 + size_bits % 9999900 AS INTEGER) AS size
    FROM drawn""",
)
def _(spark, sf):
    return synthetic.random_logs(
        _events(spark, sf), "event_id", now=F.col("ts"), max_age_ms=65000
    )


# --- streams: run to the end of the input, then read the sink ---------------------------
# Without a limit of files, all there is comes in one batch: the files of a table are in no
# order, and the watermark moves only after a batch.

def _log_stream(
    spark: SparkSession, sf: str, made: Callable[[DataFrame], DataFrame] = rebuilt.server_logs
) -> DataFrame:
    return made(rebuilt.stream_table(spark, f"{sf}/events.parquet", rebuilt.EVENTS_SCHEMA))


def _recorded_feed(spark: SparkSession, sf: str, partitions: int = 1) -> DataFrame:
    """The change messages, first recorded as a topic, then read as a stream."""
    folder = scratch_dir(spark, "feed")
    rebuilt.topic_records(_messages(spark, sf), partitions=partitions).write.parquet(folder)
    return recorded_topic(spark, folder)


FILE_WINDOW = "1 minute"
_CLOSED_1M = sql.closed_windows(FILE_WINDOW, "0 seconds")
_CLOSED_10S = sql.closed_windows("10 seconds", "0 seconds")


@register("stream_client_errors", ORACLES["client_errors"])
def _(spark, sf):
    root = scratch_dir(spark, "errors")
    streams.client_errors(_log_stream(spark, sf), root).awaitTermination()
    return spark.read.parquet(f"{root}/data")


@register(
    "stream_browser_counts_ordered",
    sql.browser_counts("1 minute", sql.closed_windows("1 minute", "15 seconds")),
)
def _(spark, sf):
    root = scratch_dir(spark, "ordered")
    streams.ordered_browser_counts(_log_stream(spark, sf), root).awaitTermination()
    rows = spark.read.parquet(f"{root}/data")
    return rows.select(
        wall_clock("window_time").alias("window_time"), "browser", "cnt_browser"
    ).orderBy("window_time", F.desc("cnt_browser"))


@register(
    "stream_browser_counts_places",
    f"""SELECT row_number() OVER (ORDER BY window_time, cnt_browser DESC) AS position,
      window_time, cnt_browser FROM ({sql.browser_counts(
        "1 minute", sql.closed_windows("1 minute", "15 seconds"))}) t""",
)
def _(spark, sf):
    """The order in which the sink wrote the windows, by what it wrote beside them."""
    root = scratch_dir(spark, "places")
    streams.ordered_browser_counts(_log_stream(spark, sf), root).awaitTermination()
    rows = spark.read.parquet(f"{root}/data")
    return running_by_key(rows, ["batch"], "place", ordinal="position").select(
        "position", wall_clock("window_time").alias("window_time"), "cnt_browser"
    )


@register("stream_partition_watermarks", sql.slowest_browser_counts(4, "1 hour", "15 seconds"))
def _(spark, sf):
    """A topic whose partitions lag behind each other by a day."""
    root = scratch_dir(spark, "slowest")
    record_partitions(rebuilt.lagging_records(_events(spark, sf), 4), f"{root}/topic")
    parts = [
        json_rows(part, rebuilt.LOG_JSON) for part in recorded_partitions(spark, f"{root}/topic", range(4))
    ]
    streams.slowest_browser_counts(parts, root).awaitTermination()
    return spark.read.parquet(f"{root}/data")


LATE_STEPS = 4


def _gated_steps(spark: SparkSession, sf: str, root: str):
    """The disordered log in a few steps, each a run of the gate of its own; the schema after each."""
    events = _events(spark, sf)
    last = events.agg(F.max("event_id")).first()[0]
    step = F.floor(F.col("event_id") * LATE_STEPS / F.lit(last + 1)).alias("step")
    lines = rebuilt.disordered_logs(events.select("*", step), keep=["step"])
    for number in range(LATE_STEPS):
        lines.filter(F.col("step") == number).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(lines.schema).parquet(f"{root}/in")
        streams.late_gate(stream, f"{root}/gate").awaitTermination()
        yield lines.schema


@register("stream_late_rows", sql.late_rows(LATE_STEPS, "1 minute", "15 seconds"))
def _(spark, sf):
    """Lines that come two hours late, beside those that come in time."""
    root = scratch_dir(spark, "late")
    *_, schema = _gated_steps(spark, sf, root)
    kept = spark.read.schema(schema).parquet(f"{root}/gate/rows/kept").withColumn("late", F.lit(False))
    late = late_rows(spark, f"{root}/gate/rows", schema).withColumn("late", F.lit(True))
    return kept.unionByName(late, allowMissingColumns=True).groupBy("step", "status_code", "late").agg(F.count("*").alias("n"))


@register("stream_kept_counts", sql.kept_counts(LATE_STEPS, "1 minute", "15 seconds"))
def _(spark, sf):
    """Window counts over what the gate keeps, step by step: none of it is late any more."""
    root = scratch_dir(spark, "kept")
    for schema in _gated_steps(spark, sf, root):
        kept = kept_rows(spark, f"{root}/gate/rows", schema)
        streams.ordered_browser_counts(kept, f"{root}/counts").awaitTermination()
    return spark.read.parquet(f"{root}/counts/data").select(
        wall_clock("window_time").alias("window_time"), "browser", "cnt_browser"
    )


@register("stream_realtime_counts", sql.status_counts("10 seconds", _CLOSED_10S))
def _(spark, sf):
    root = scratch_dir(spark, "realtime")
    view = streams.timed_view(_log_stream(spark, sf))
    streams.realtime_counts(view, root).awaitTermination()
    return _realtime_rows(spark.read.text(f"{root}/data"))


def _realtime_rows(records: DataFrame) -> DataFrame:
    return json_rows(
        records,
        "browser string, status_code string, end_time timestamp_ntz, requests bigint",
    )


@register("stream_dw_files", sql.dense(sql.warehouse(FILE_WINDOW, _CLOSED_1M)))
def _(spark, sf):
    root = scratch_dir(spark, "files")
    view = streams.timed_view(_log_stream(spark, sf, rebuilt.dense_logs))
    streams.warehouse_files(view, root, FILE_WINDOW).awaitTermination()
    return _warehouse_rows(spark, f"{root}/data")


def _warehouse_rows(spark: SparkSession, path: str) -> DataFrame:
    return read_partitioned_json(spark, path, WAREHOUSE_SCHEMA, many=True).select(
        "browser", "status_code", "dt", "hour", "minute", "requests"
    )


@register(
    "stream_two_sinks",
    sql.dense(f"""SELECT 'topic' AS sink, browser, status_code, requests
      FROM ({sql.status_counts('10 seconds', _CLOSED_10S)}) t
    UNION ALL SELECT 'files', browser, status_code, requests
      FROM ({sql.warehouse(FILE_WINDOW, _CLOSED_1M)}) f"""),
)
def _(spark, sf):
    root = scratch_dir(spark, "two")
    for query in streams.two_sinks(_log_stream(spark, sf, rebuilt.dense_logs), root, FILE_WINDOW):
        query.awaitTermination()
    topic = _realtime_rows(spark.read.text(f"{root}/topic/data"))
    stored = _warehouse_rows(spark, f"{root}/files/data")
    columns = ["browser", "status_code", "requests"]
    return topic.select(F.lit("topic").alias("sink"), *columns).unionAll(
        stored.select(F.lit("files"), *columns)
    )


@register(
    "stream_lake_counts",
    sql.warehouse("5 seconds", sql.closed_windows("5 seconds", "0 seconds")),
)
def _(spark, sf):
    root = scratch_dir(spark, "lake")
    table = f"lake_counts_{uuid.uuid4().hex}"
    catalog.create_table(spark, table, catalog.WAREHOUSE_TABLE, ["dt"], f"{root}/data")
    view = streams.timed_view(_log_stream(spark, sf))
    streams.lake_counts(view, root, table).awaitTermination()
    return from_name(spark, table).select(
        "browser", "status_code", "dt", "hour", "minute", "requests"
    )


@register(
    "stream_packed_counts",
    sql.warehouse("5 seconds", sql.closed_windows("5 seconds", "0 seconds")),
)
def _(spark, sf):
    """Counts of four batches by day; the days before the last are packed between them and after."""
    root = scratch_dir(spark, "packed")
    table = PackedTable(spark, f"{root}/table", WAREHOUSE_SCHEMA, "dt")
    events = _events(spark, sf)
    last = events.agg(F.max("event_id")).first()[0]
    for number in range(4):
        step = F.floor(F.col("event_id") * 4 / F.lit(last + 1)) == number
        events.filter(step).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rebuilt.EVENTS_SCHEMA).parquet(f"{root}/in")
        view = streams.timed_view(rebuilt.server_logs(stream))
        streams.packed_counts(view, table, root).awaitTermination()
        days = sorted(r.dt for r in table.read().select("dt").distinct().collect())
        table.pack(lambda day, newest=days[-1:]: [day] != newest)
    return table.read()


@register("stream_distinct_ips", sql.distinct_ips("10 seconds", closed=_CLOSED_10S))
def _(spark, sf):
    root = scratch_dir(spark, "distinct")
    streams.distinct_ips(_log_stream(spark, sf), root).awaitTermination()
    return spark.read.parquet(f"{root}/data")


@register(
    "stream_word_count",
    f"""WITH {sql.LOGS}, ones AS (
      SELECT unnest({sql.words('request_line')}) AS word, log_time FROM logs)
    SELECT word, time_bucket(INTERVAL '30 seconds', log_time) AS window_start,
      count(*) AS n
    FROM ones GROUP BY 1, 2 {sql.closed_windows('30 seconds', '0 seconds')}""",
)
def _(spark, sf):
    root = scratch_dir(spark, "words")
    lines = _log_stream(spark, sf).select("request_line", "log_time")
    streams.windowed_words(lines, root, "request_line", "log_time").awaitTermination()
    return spark.read.parquet(f"{root}/data")


@register("stream_clock_distinct_ips", f"WITH {sql.LOGS} SELECT count(DISTINCT client_ip) AS ip_addresses FROM logs")
def _(spark, sf):
    """A service that closes its last window by the clock; all rows are in one micro-batch, so in one window."""
    root = scratch_dir(spark, "clock")
    query = streams.clock_distinct_ips(_log_stream(spark, sf), root, "2 seconds", interval="1 second")
    return _closed_by_clock(spark, sf, query, root).select(F.col("n").alias("ip_addresses"))


@register(
    "stream_clock_words",
    f"""WITH {sql.LOGS}, ones AS (SELECT unnest({sql.words('request_line')}) AS word FROM logs)
    SELECT word, count(*) AS n FROM ones GROUP BY 1""",
)
def _(spark, sf):
    root = scratch_dir(spark, "clock")
    query = streams.clock_words(_log_stream(spark, sf), root, "request_line", "2 seconds", interval="1 second")
    return _closed_by_clock(spark, sf, query, root).select("word", "n")


def _closed_by_clock(spark: SparkSession, sf: str, query, root: str) -> DataFrame:
    try:
        wait_until_closed(query, _events(spark, sf).count())
    finally:
        query.stop()
    return spark.read.parquet(f"{root}/data")


@register(
    "stream_text_lines",
    "SELECT unnest(string_split(text, chr(10))) AS value FROM documents",
)
def _(spark, sf):
    """Documents as text files, followed as a stream of lines."""
    root = scratch_dir(spark, "lines")
    rebuilt.table(spark, sf, "documents").select("text").write.option("lineSep", "\n").text(f"{root}/in")
    run_to_end(text_stream(spark, f"{root}/in"), f"{root}/checkpoint", path=f"{root}/data")
    return spark.read.parquet(f"{root}/data")


@register("stream_total_count", ORACLES["total_count"])
def _(spark, sf):
    root = scratch_dir(spark, "counter")
    view = logs.browsers_view(_log_stream(spark, sf))
    streams.live_counter(view, root).awaitTermination()
    return streams.counter_table(spark, root).read()


@register(
    "stream_feed_to_topic",
    f"""WITH {sql.CHANGES} SELECT 'test-0-' || "offset" AS message_id,
      '{{"before":' || CASE WHEN op IN ('u', 'd')
        THEN '{{"id":' || id || ',"num":' || old_num || '}}' ELSE 'null' END
      || ',"after":' || CASE WHEN op <> 'd'
        THEN '{{"id":' || id || ',"num":' || num || '}}' ELSE 'null' END
      || ',"op":"' || op || '","ts_ms":' || epoch_ms(cut_ts)
      || ',"source":{{"db":"test","table":"test","ts_ms":' || (epoch_ms(cut_ts) - 5)
      || '}}}}' AS value FROM msgs""",
)
def _(spark, sf):
    root = scratch_dir(spark, "forward")
    streams.feed_to_topic(_recorded_feed(spark, sf), root).awaitTermination()
    sent = spark.read.parquet(f"{root}/data")
    return drop_replays(sent.withColumn("message_id", message_id())).select(
        "message_id", "value"
    )


@register("stream_committed_topic", ORACLES["stream_feed_to_topic"])
def _(spark, sf):
    """The feed passed on by attempts that fail after they have sent, read without repeats."""
    root = scratch_dir(spark, "committed")
    send, lost = send_to_files(f"{root}/data"), []

    def fails_once(records: DataFrame) -> None:
        send(records)
        if not lost:
            lost.append(True)
            raise ConnectionError("lost after sending")

    feed = _recorded_feed(spark, sf)
    try:
        streams.feed_to_committed_topic(feed, root, send=fails_once).awaitTermination()
    except StreamingQueryException:
        streams.feed_to_committed_topic(feed, root, send=fails_once).awaitTermination()
    columns = "value string, headers array<struct<key:string,value:binary>>"
    reader = CommittedReader(f"{root}/read", f"{root}/manifest")
    run_to_end(spark.readStream.schema(columns).parquet(f"{root}/data"), f"{root}/read_checkpoint", each_batch=reader)
    return reader.read(spark, columns).select(message_id().alias("message_id"), "value")


@register("stream_cdc_append_log", _APPEND)
def _(spark, sf):
    root = scratch_dir(spark, "append")
    streams.append_log(_recorded_feed(spark, sf), root).awaitTermination()
    return spark.read.parquet(f"{root}/data")


@register("stream_cdc_topic", f"""SELECT value FROM ({ORACLES['cdc_to_debezium_json']}) t""")
def _(spark, sf):
    root = scratch_dir(spark, "changelog")
    streams.changelog_topic(_recorded_feed(spark, sf), root).awaitTermination()
    return spark.read.parquet(f"{root}/data").select("value")


@register("stream_cdc_topic_round_trip", _LATEST)
def _(spark, sf):
    """A feed of several partitions to a keyed topic, and back to the table."""
    root = scratch_dir(spark, "changelog")
    streams.changelog_topic(_recorded_feed(spark, sf, partitions=8), root).awaitTermination()
    return feeds.current_rows(feeds.received_changes(spark.read.parquet(f"{root}/data")))


@register("stream_cdc_upsert", _LATEST)
def _(spark, sf):
    root = scratch_dir(spark, "keyed")
    table = KeyedFiles(
        spark, f"{root}/data", ["id"], partition="partition",
        schema="id int, num int, operation_ts timestamp_ntz",
    )
    streams.keyed_table(_recorded_feed(spark, sf), table, root).awaitTermination()
    return table.read()


@register("stream_cdc_buckets", _LATEST)
def _(spark, sf):
    """The keyed table in buckets, fed in eight batches and compacted after every third."""
    root = scratch_dir(spark, "buckets")
    table = BucketedFiles(
        spark, f"{root}/data", ["id"], partition="partition", compact_every=3, buckets=16,
        schema="id int, num int, operation_ts timestamp_ntz",
    )
    records = rebuilt.topic_records(_messages(spark, sf), partitions=8)
    records.repartitionByRange(8, F.desc("offset")).write.parquet(f"{root}/topic")
    stream = recorded_topic(spark, f"{root}/topic", max_files=1)
    streams.keyed_table(stream, table, root).awaitTermination()
    return table.read()


@register("stream_revenue_retractions", ORACLES["revenue_retractions"])
def _(spark, sf):
    root = scratch_dir(spark, "retract")
    orders = rebuilt.stream_table(spark, f"{sf}/orders.parquet", rebuilt.ORDERS_SCHEMA)
    streams.revenue_retractions(rebuilt.revenue_orders(orders), root).awaitTermination()
    return spark.read.parquet(f"{root}/data/changes").drop("batch")


# --- tables and files: write, insert, read back ------------------------------------------


@register("dw_files_read_back", sql.dense(sql.warehouse(FILE_WINDOW)))
def _(spark, sf):
    folder = scratch_dir(spark, "warehouse")
    view = logs.browsers_view(rebuilt.dense_logs(_events(spark, sf)))
    counts = logs.warehouse_columns(logs.status_counts(view, FILE_WINDOW))
    partitions = ["dt", "hour", "minute"]
    counts.repartition(*partitions).write.partitionBy(*partitions).json(folder)
    return _warehouse_rows(spark, folder)


@register("lake_table_read_back", sql.warehouse("5 seconds"))
def _(spark, sf):
    folder, table = scratch_dir(spark, "lake"), f"lake_{uuid.uuid4().hex}"
    catalog.create_table(spark, table, catalog.WAREHOUSE_TABLE, ["dt"], folder)
    catalog.insert_rows(
        logs.warehouse_columns(logs.status_counts(_view(spark, sf), "5 seconds")), table
    )
    return from_name(spark, table)


@register(
    "literal_row",
    f"""{_APPEND} UNION ALL
    SELECT CAST(1 AS INTEGER), CAST(1 AS INTEGER), 'c', TIMESTAMP '2021-01-01 00:00:00'""",
)
def _(spark, sf):
    folder, table = scratch_dir(spark, "append"), f"append_{uuid.uuid4().hex}"
    catalog.create_table(spark, table, catalog.APPEND_TABLE, [], folder)
    catalog.insert_rows(feeds.append_rows(_messages(spark, sf)), table)
    catalog.insert_values(
        spark, table, ["1", "1", "'c'", "timestamp_ntz'2021-01-01 00:00:00'"]
    )
    return from_name(spark, table)


@register(
    "insert_values",
    f"""WITH {sql.LOGS} SELECT count(*) AS num FROM browsers
    UNION ALL SELECT CAST(3 AS BIGINT)""",
)
def _(spark, sf):
    folder, table = scratch_dir(spark, "counter"), f"counter_{uuid.uuid4().hex}"
    catalog.create_table(spark, table, "num bigint", [], folder)
    catalog.insert_rows(logs.total_count(_view(spark, sf)).select("num"), table)
    catalog.insert_values(spark, table, ["3"])
    return from_name(spark, table)
