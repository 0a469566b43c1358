"""Running values per key, in order, without holding a hot key in one task.

A plain ``sum() over (partition by key order by seq)`` sends every row of a key
to one task. Here the rows of keys with more than ``hot_rows`` rows are dealt by
ranges of (key, order), which Spark cuts from a sample, and written once. Each
range is a slice; it starts with an *opening row* that carries the totals of the
slices before it, so an ordinary window over (key, slice) gives the running
values of the whole key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import scratch_dir

HOT_ROWS = 1 << 20
MOST_HOT = 10**6

_SLICE, _OPENING, _ONES = "__slice", "__opening", "__rows"


def running_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    ordinal: str | None = None,
    sums: Mapping[str, str] | None = None,
    sums_before: Mapping[str, str] | None = None,
    previous: Mapping[str, str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add, per key and in ``order``, the columns asked for.

    ordinal      name of the row number (from 1)
    sums         name -> column: running sum up to and with the row (NULLs skipped)
    sums_before  name -> column: the same without the row itself
    previous     name -> column: value in the row before, NULL in the first

    ``order`` is not NULL and unique within a key, and of any type that sorts. NULL
    keys form one key. The input is read up to three times (once for the keys
    only), so give it a table scan or a stored DataFrame. Rows are counted when
    this is called.

    Hot keys are known by a hash, so that wide keys aren't broadcast; a key that
    shares the hash of a hot one is sliced too. At most ``MOST_HOT`` keys count as
    hot, whatever the number of rows: beyond that ``hot_rows`` grows.
    """
    upto, before_it, previous = dict(sums or {}), dict(sums_before or {}), dict(previous or {})
    totals = {**upto, **before_it}
    keys = list(keys)
    inputs = {**totals, **previous}
    mark = F.xxhash64(*[F.col(k) for k in keys])
    entering = [
        F.lit(1).cast("long").alias(_ONES),
        *[F.col(c).alias(f"__in_{n}") for n, c in inputs.items()],
        F.lit(False).alias(_OPENING),
    ]

    hot, slices = _hot_keys(df, mark, hot_rows)
    if not slices:
        stacked = df.select("*", F.lit(0).alias(_SLICE), *entering)
        return _running(stacked, df.columns, keys, order, ordinal, upto, before_it, previous)

    marked = df.withColumn("__mark", mark)
    cold = marked.join(F.broadcast(hot), "__mark", "left_anti").drop("__mark")
    path = scratch_dir(df.sparkSession, "slices")
    warm = marked.join(F.broadcast(hot), "__mark", "left_semi").drop("__mark")
    warm.repartitionByRange(slices, *keys, order).withColumn(
        _SLICE, F.spark_partition_id()
    ).write.parquet(path)
    sliced = df.sparkSession.read.parquet(path)
    hot_part = sliced.groupBy(*keys, _SLICE).agg(
        F.count("*").alias(_ONES),
        *[F.sum(c).alias(f"__sum_{n}") for n, c in totals.items()],
        *[F.max_by(c, order).alias(f"__last_{n}") for n, c in previous.items()],
    )

    before = Window.partitionBy(*keys).orderBy(_SLICE)
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    openings = hot_part.select(
        *keys,
        _SLICE,
        F.sum(_ONES).over(earlier).alias(_ONES),
        *[F.sum(f"__sum_{n}").over(earlier).alias(f"__in_{n}") for n in totals],
        *[F.lag(f"__last_{n}").over(before).alias(f"__in_{n}") for n in previous],
        F.lit(True).alias(_OPENING),
    )
    rows = cold.withColumn(_SLICE, F.lit(-1)).unionByName(sliced).select("*", *entering)
    stacked = rows.unionByName(openings, allowMissingColumns=True)
    return _running(stacked, df.columns, keys, order, ordinal, upto, before_it, previous)


def _hot_keys(df: DataFrame, mark: Column, hot_rows: int) -> tuple[DataFrame, int]:
    """Hashes of the hot keys (``MOST_HOT`` at most), and in how many slices to cut their rows."""
    path = scratch_dir(df.sparkSession, "hot")
    counts = df.groupBy(mark.alias("__mark")).agg(F.count("*").alias("__count"))
    counts.where(F.col("__count") > hot_rows).write.parquet(path)
    hot = df.sparkSession.read.parquet(path)
    rows = hot.agg(F.sum("__count")).first()[0] or 0
    least = max(hot_rows, rows // MOST_HOT)
    if least > hot_rows:
        hot = hot.where(F.col("__count") > least)
        rows = hot.agg(F.sum("__count")).first()[0] or 0
    return hot.select("__mark"), -(-rows // least)


def _running(
    stacked: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: str,
    ordinal: str | None,
    upto: Mapping[str, str],
    before_it: Mapping[str, str],
    previous: Mapping[str, str],
) -> DataFrame:
    in_order = Window.partitionBy(*keys, _SLICE).orderBy(F.col(order).asc_nulls_first())
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    added: list[Column] = []
    if ordinal:
        added.append(F.sum(_ONES).over(so_far).alias(ordinal))
    added += [F.sum(f"__in_{n}").over(so_far).alias(n) for n in upto]
    without_it = in_order.rowsBetween(Window.unboundedPreceding, -1)
    added += [F.sum(f"__in_{n}").over(without_it).alias(n) for n in before_it]
    added += [F.lag(f"__in_{n}").over(in_order).alias(n) for n in previous]
    return stacked.select(*columns, _OPENING, *added).where(~F.col(_OPENING)).drop(_OPENING)
