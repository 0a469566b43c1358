"""Tumbling windows over batch tables and streams.

All aggregates here are partial before the shuffle, so a window or key that
holds a large share of the rows costs one small row per task, not its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import instant, window_time, words


def with_event_time(df: DataFrame, col: str, delay: str | None) -> DataFrame:
    """Make ``col`` the event time, out of order by at most ``delay``.

    Streams need an instant: a wall-clock column is read as UTC. ``delay=None``
    sets no watermark, as for a source without one.
    """
    if dict(df.dtypes)[col] == "timestamp_ntz" and df.isStreaming:
        df = df.withColumn(col, instant(col))
    return df if delay is None else df.withWatermark(col, delay)


def slowest_watermark(parts: Sequence[DataFrame], col: str, delay: str) -> DataFrame:
    """Streams as one, whose watermark is that of the slowest.

    Each part, a partition of a topic say, has event time and a watermark of its own;
    Spark takes the least of them, so rows of a part that lags behind aren't late. A part
    that has had no row yet holds all windows open. The plan has a branch for each part:
    group partitions that keep pace if there are many hundreds.
    """
    policy = "spark.sql.streaming.multipleWatermarkPolicy"
    if parts[0].sparkSession.conf.get(policy, "min") != "min":
        raise ValueError(f"{policy} has to be min, or rows of slow parts are dropped")
    whole, *others = [with_event_time(part, col, delay) for part in parts]
    for other in others:
        whole = whole.unionByName(other)
    return whole


def with_processing_time(df: DataFrame, col: str, clock: Column | None = None) -> DataFrame:
    """Add the processing time as a column; ``clock`` fixes it for repeatable runs."""
    return df.withColumn(col, F.current_timestamp() if clock is None else clock)


def tumble(df: DataFrame, col: str, size: str) -> DataFrame:
    """Window columns on every row, as a table function gives them.

    Adds ``window`` (group by it on a stream, it carries the watermark) and
    ``window_start``, ``window_end``, ``window_time``.
    """
    return df.withColumn("window", F.window(col, size)).withColumns(
        {
            "window_start": F.col("window.start"),
            "window_end": F.col("window.end"),
            "window_time": window_time("window"),
        }
    )


def window_counts(
    df: DataFrame, col: str, size: str, keys: Sequence[str | Column], name: str = "requests"
) -> DataFrame:
    """Rows per key and window: keys, ``window`` and the count."""
    return df.groupBy(*keys, F.window(col, size).alias("window")).agg(
        F.count("*").alias(name)
    )


def window_bounds(df: DataFrame) -> DataFrame:
    """Replace the ``window`` struct by start, end and time columns."""
    return df.select(
        *[c for c in df.columns if c != "window"],
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        window_time("window").alias("window_time"),
    )


def window_distinct(
    df: DataFrame,
    col: str,
    size: str,
    of: str,
    name: str,
    approximate: bool = False,
) -> DataFrame:
    """Distinct non-NULL values of ``of`` per window: ``window`` and the count.

    Batch: ``count(distinct)``, which Spark spreads over (window, value) first.
    Stream: the same in two chained aggregates, one state row per (window,
    value); both combine before their shuffle. A window without any non-NULL
    value counts 0 either way.
    """
    window = F.window(col, size).alias("window")
    if approximate:
        return df.groupBy(window).agg(F.approx_count_distinct(of).alias(name))
    if not df.isStreaming:
        return df.groupBy(window).agg(F.count_distinct(F.col(of)).alias(name))
    values = df.groupBy(window, of).agg(F.count("*").alias("copies"))
    return values.groupBy(F.window(F.window_time("window"), size).alias("window")).agg(
        F.count(of).alias(name)
    )


def word_counts(
    lines: DataFrame, value: str = "value", col: str | None = None, size: str | None = None
) -> DataFrame:
    """Sum of ones per word (and per window of ``col``, when given).

    The sum is a BIGINT: a common word passes the range of INT soon.
    """
    keep = [] if col is None else [col]
    ones = lines.select(*keep, F.explode(words(value)).alias("word")).withColumn(
        "n", F.lit(1)
    )
    keys = ["word"] if col is None else ["word", F.window(col, size).alias("window")]
    return ones.groupBy(*keys).agg(F.sum("n").alias("n"))
