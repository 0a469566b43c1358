"""Jobs over server logs. Each takes a batch or streaming ``server_logs``.

Counts keep the ``window`` struct, which carries the watermark of a stream;
`*_columns` functions turn it into the columns a table stores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import browser, date_parts, similar_to, wall_clock, window_time
from tidelog.operators.windows import window_bounds, window_counts, window_distinct

# Fixed value: the status codes that count as client errors.
CLIENT_ERROR = "4[0-9][0-9]"


def client_errors(logs: DataFrame) -> DataFrame:
    return logs.where(similar_to("status_code", CLIENT_ERROR)).select(
        "log_time", "request_line", "status_code", "size"
    )


def browsers_view(logs: DataFrame) -> DataFrame:
    """The view the counting jobs share."""
    return logs.select(browser("user_agent").alias("browser"), "status_code", "log_time")


def browser_counts(logs: DataFrame, size: str = "1 minute") -> DataFrame:
    """Requests per browser and window: ``browser, window, cnt_browser``."""
    return window_counts(
        logs, "log_time", size, [browser("user_agent").alias("browser")], "cnt_browser"
    )


def ordered_browser_counts(counts: DataFrame) -> DataFrame:
    """By window time, then the largest counts first.

    A batch result, or one micro-batch of closed windows in ``foreachBatch``.
    """
    return counts.select(
        window_time("window").alias("window_time"), "browser", "cnt_browser"
    ).orderBy("window_time", F.desc("cnt_browser"))


def status_counts(view: DataFrame, size: str) -> DataFrame:
    """Requests per browser, status and window."""
    return window_counts(view, "log_time", size, ["browser", "status_code"], "requests")


def realtime_columns(counts: DataFrame) -> DataFrame:
    """Columns of the realtime table (a count is never NULL, as its schema asks)."""
    return counts.select(
        "browser",
        "status_code",
        local_time(counts, window_time("window")).alias("end_time"),
        "requests",
    )


def warehouse_columns(
    counts: DataFrame, zone: str = "UTC", keep_window: bool = False
) -> DataFrame:
    """Columns of the partitioned table; ``zone`` names the days and hours.

    Windows shorter than a minute share a partition: one row each, not merged.
    """
    at = local_time(counts, window_time("window"), zone)
    return counts.select(
        "browser",
        "status_code",
        *date_parts(at),
        "requests",
        *(["window"] if keep_window else []),
    )


def local_time(df: DataFrame, at: Column, zone: str = "UTC") -> Column:
    """``at`` as wall-clock time: streams carry instants, batches wall clocks."""
    window = df.schema["window"].dataType
    if window["end"].dataType.typeName() == "timestamp":
        return wall_clock(at, zone)
    return at


def distinct_ips_legacy(
    logs: DataFrame, size: str = "10 seconds", clock: Column | None = None
) -> DataFrame:
    """Grouped-window form, with the time of emission as ``window_interval``."""
    counts = window_bounds(window_distinct(logs, "log_time", size, "client_ip", "ip_addresses"))
    emitted = F.current_timestamp() if clock is None else clock
    return counts.select(
        "ip_addresses", emitted.alias("window_interval"), "window_start", "window_end"
    )


def distinct_ips(logs: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Table-function form: the window columns, then the count."""
    counts = window_distinct(logs, "log_time", size, "client_ip", "ip_addresses")
    return counts.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "ip_addresses",
    )


def total_count(view: DataFrame, kind: str = "bigint") -> DataFrame:
    """One row for the counter table: a constant key and the count.

    A table with an INT takes ``kind="int"``; past two billion rows that cast ends
    the job rather than store a wrong number.
    """
    return view.agg(F.count("*").cast(kind).alias("num")).select(
        F.lit(1).cast("int").alias("id"), "num"
    )
