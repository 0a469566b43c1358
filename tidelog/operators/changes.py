"""Changelogs of keyed tables: latest row per key, and sums that retract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.ordered import HOT_ROWS, running_by_key

_ADDED = ("+I", "+U")


def latest_by_key(
    changes: DataFrame,
    keys: Sequence[str],
    order: str = "seq",
    kind: str = "kind",
    keep_deleted: bool = False,
    partition: str | None = None,
) -> DataFrame:
    """Newest row per key; keys whose newest change removes them are left out.

    ``order`` (topic offset, `changelog`'s ``seq``) is unique within a key.
    One aggregate, partial before the shuffle: a hot key sends one row per
    task. ``keep_deleted`` keeps removed keys and adds ``order`` and
    ``deleted``, for writers that must remember them.

    Offsets order the changes of one topic partition only. With ``partition``, the
    column that names it, a key that comes from two partitions ends the job.
    """
    values = [c for c in changes.columns if c not in {*keys, order, kind, partition}]
    guard = [partition] if partition else []
    removed = ~F.col(kind).isin(*_ADDED)
    if "deleted" in changes.columns:
        raise ValueError("the column name 'deleted' is taken by the result")
    rows = changes.select(*keys, *values, order, *guard, removed.alias("deleted"))
    newest = _newest(rows, keys, [*values, "deleted"], order, partition)
    if keep_deleted:
        return newest.select(*keys, *values, order, *guard, "deleted")
    return newest.where(~F.col("deleted")).select(*keys, *values)


def merge_latest(
    rows: DataFrame, keys: Sequence[str], order: str = "seq", partition: str | None = None
) -> DataFrame:
    """Newest row per key of rows that already carry ``order`` and ``deleted``."""
    values = [c for c in rows.columns if c not in {*keys, order, partition}]
    return _newest(rows, keys, values, order, partition).select(*rows.columns)


def _newest(
    rows: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    order: str,
    partition: str | None = None,
) -> DataFrame:
    ends = [F.max(order).alias(order)]
    if partition:
        two = F.concat(
            F.lit("changes of one key come from two topic partitions ("),
            F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]), F.lit(")"),
        )
        ends += [F.min(partition).alias("__one"), F.max(partition).alias(partition)]
    # Columns of fixed width aggregate one by one in a hash map; a struct or a
    # string needs a sort-based aggregate, so then all go in one struct.
    if all(_fixed_width(rows.schema[c].dataType) for c in values):
        picks = [F.max_by(c, order).alias(c) for c in values]
        newest = rows.groupBy(*keys).agg(*picks, *ends)
    else:
        one = F.max_by(F.struct(*values), order).alias("__row")
        rest = [order, *(["__one", partition] if partition else [])]
        newest = rows.groupBy(*keys).agg(one, *ends).select(*keys, "__row.*", *rest)
    if not partition:
        return newest
    # In the column that every reader filters by, so that the check isn't pruned away.
    same = F.when(F.col("__one") == F.col(partition), F.col("deleted"))
    return newest.withColumn("deleted", same.otherwise(F.raise_error(two).cast("boolean"))).drop("__one")


def _fixed_width(t: T.DataType) -> bool:
    if isinstance(t, T.DecimalType):
        return t.precision <= 18
    return isinstance(
        t, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )


def retract_sum(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    order: str,
    total: str = "total",
    opening: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Changelog of ``sum(value)`` per key: ``order, kind, added, keys, total``.

    The first row of a key gives +I; each later one withdraws the old sum (-U)
    and adds the new one (+U), unless the sum stayed the same. ``opening``
    (keys and ``total``) holds the sums of earlier rows, for a continued run.
    """
    cells = rows.select(*keys, order, F.col(value).alias("__v"))
    if opening is not None:
        cells = _prepend(cells, opening, keys, order, total)
        hidden = F.col("__opening_row")
    else:
        hidden = F.lit(False)
    scan = running_by_key(
        cells, keys, order,
        ordinal="__n", sums={"__new": "__v"}, sums_before={"__old": "__v"},
        hot_rows=hot_rows,
    ).where(~hidden)

    def entry(kind: str, column: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(column).alias(total))

    entries = F.when(F.col("__n") == 1, F.array(entry("+I", "__new"))).when(
        ~F.col("__new").eqNullSafe(F.col("__old")),
        F.array(entry("-U", "__old"), entry("+U", "__new")),
    )
    return scan.select(*keys, order, F.explode(entries).alias("e")).select(
        order,
        "e.kind",
        F.col("e.kind").isin(*_ADDED).alias("added"),
        *keys,
        f"e.{total}",
    )


def retract_totals(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    total: str = "total",
    opening: DataFrame | None = None,
) -> DataFrame:
    """The compact form: at most one withdrawal and one addition per key.

    Aggregated before the shuffle, so it costs one row per key and task.
    """
    # The closing sum adds the earlier sum as one more value.
    parts = rows.select(*keys, F.col(value).alias("__v"), F.lit(False).alias("__was"))
    if opening is not None:
        parts = parts.unionByName(
            opening.select(*keys, F.col(total).alias("__v"), F.lit(True).alias("__was"))
        )
    sums = parts.groupBy(*keys).agg(
        F.sum("__v").alias("__new"),
        F.sum(F.when(F.col("__was"), F.col("__v"))).alias("__old"),
        F.bool_or("__was").alias("__known"),
        F.bool_or(~F.col("__was")).alias("__touched"),
    )

    def entry(kind: str, column: str):
        return F.struct(F.lit(kind).alias("kind"), F.col(column).alias(total))

    entries = F.when(~F.col("__known"), F.array(entry("+I", "__new"))).when(
        ~F.col("__new").eqNullSafe(F.col("__old")),
        F.array(entry("-U", "__old"), entry("+U", "__new")),
    )
    return (
        sums.where("__touched")
        .select(*keys, F.explode(entries).alias("e"))
        .select("e.kind", F.col("e.kind").isin(*_ADDED).alias("added"), *keys, f"e.{total}")
    )


def _prepend(
    cells: DataFrame, opening: DataFrame, keys: Sequence[str], order: str, total: str
) -> DataFrame:
    """Put each touched key's earlier sum right before its first new row."""
    first = cells.groupBy(*keys).agg((F.min(order) - 1).alias("__first"))
    known = opening.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(total).alias("__v"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    starts = first.join(known, same).select(
        *keys, F.col("__first").alias(order), "__v", F.lit(True).alias("__opening_row")
    )
    return cells.withColumn("__opening_row", F.lit(False)).unionByName(starts)
