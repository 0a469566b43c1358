"""Debezium JSON messages to rows, as column expressions over ``from_json``.

`decode` parses and judges every message; `append_log` and `changelog` turn
what it accepts into rows. They treat snapshot reads (``r``) differently on
purpose: the append log skips them, the changelog inserts them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import map_value

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class MetadataField:
    """A readable metadata field: which JSON it needs and how to read it."""

    json_field: str
    json_type: str
    read: Callable[[Column], Column]
    in_payload: bool = True


def _source(key: str) -> MetadataField:
    return MetadataField("source", "map<string,string>", lambda c: map_value(c, key))


def _source_time(source: Column) -> Column:
    return F.timestamp_millis(map_value(source, "ts_ms").try_cast("bigint"))


# The names of the metadata fields and the JSON keys they read.
METADATA: dict[str, MetadataField] = {
    "schema": MetadataField("schema", "string", lambda c: c, in_payload=False),
    "op": MetadataField("op", "string", lambda c: c),
    "ingestion-timestamp": MetadataField("ts_ms", "bigint", F.timestamp_millis),
    "source.timestamp": MetadataField("source", "map<string,string>", _source_time),
    "source.database": _source("db"),
    "source.schema": _source("schema"),
    "source.table": _source("table"),
    "source.properties": MetadataField("source", "map<string,string>", lambda c: c),
}

# The change feed's virtual columns, as metadata under other names.
VIRTUAL_COLUMNS = {
    "database_name": "source.database",
    "table_name": "source.table",
    "op_ts": "source.timestamp",
}

Metadata = Sequence[str] | Mapping[str, str]


def decode(
    messages: DataFrame,
    physical: str | T.StructType,
    metadata: Metadata = (),
    *,
    wrapped: bool = False,
    insert_snapshots: bool = False,
    value: str = "value",
    json_options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parse messages; NULL and empty ones (tombstones) are dropped.

    physical   schema of the table: a DDL string or ``spark.table(t).schema``
    metadata   names from `METADATA`, or output name -> name
    wrapped    the change sits under ``payload``, next to ``schema``

    Adds ``change`` (``before, after, op, meta``), ``decode_error`` (why the
    message can't give a row, else NULL) and ``bad_fields`` (some JSON value did
    not fit its type and was read as NULL). Only the JSON fields that are asked
    for are parsed.
    """
    wanted = _named(metadata)
    schema = _message_schema(physical, wanted.values(), wrapped)
    options = {**(json_options or {}), "columnNameOfCorruptRecord": CORRUPT}
    text = F.col(value).cast("string")
    parsed = messages.where(F.length(text) > 0).withColumn(
        "__m", F.from_json(text, schema, options)
    )
    payload = F.col("__m.payload") if wrapped else F.col("__m")
    meta = [
        f.read((payload if f.in_payload else F.col("__m"))[f.json_field]).alias(name)
        for name, f in wanted.items()
    ]
    before, after, op = (payload[n] for n in ("before", "after", "op"))
    corrupt = F.col("__m")[CORRUPT].isNotNull() | F.col("__m").isNull()
    error = judged(corrupt, payload, op, before, after, insert_snapshots)
    emits = ["c", "u", "d", *(["r"] if insert_snapshots else [])]
    if any(f.read is _source_time for f in wanted.values()):
        ms = map_value(payload["source"], "ts_ms")
        bad_ms = ms.isNotNull() & ms.try_cast("bigint").isNull()
        error = error.when(op.isin(emits) & bad_ms, "source.ts_ms is not a number")
    change = F.struct(
        before.alias("before"),
        after.alias("after"),
        op.alias("op"),
        F.struct(*meta).alias("meta"),
    )
    return parsed.select(
        *messages.columns,
        change.alias("change"),
        error.alias("decode_error"),
        corrupt.alias("bad_fields"),
    )


def judged(
    corrupt: Column, payload: Column, op: Column, before: Column, after: Column, insert_snapshots: bool
) -> Column:
    """Why a message can't give a row, else NULL."""
    needs_after = ["c", "u", "r"] if insert_snapshots else ["c", "u"]
    return (
        F.when(corrupt & (payload.isNull() | op.isNull()), "malformed message")
        .when(payload.isNull(), "no payload")
        .when(op.isNull(), "no op")
        .when(op.isin("u", "d") & before.isNull(), "no before image")
        .when(op.isin(needs_after) & after.isNull(), "no after image")
        .when(~op.isin("c", "u", "d", "r"), "unknown op")
    )


def split_errors(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable messages, and a side output of those that can't give a row."""
    bad = F.col("decode_error").isNotNull()
    return _keep(decoded, ~bad), _keep(decoded, bad)


def _keep(df: DataFrame, condition: Column) -> DataFrame:
    """A filter that stays above the parse.

    Spark moves a plain filter below the projection that parses the JSON, and
    parses once per use of a field in it. It doesn't move one past a generator.
    """
    once = F.explode(F.when(condition, F.array(F.lit(True))))
    return df.select("*", once.alias("__kept")).drop("__kept")


def _checked(entries: Column, on_error: str, value: str) -> Column:
    """The array of rows a message gives, or what ``on_error`` asks for instead.

    ``fail``: any bad message or field ends the job. ``skip``: bad messages give
    no rows. As the argument of ``explode`` it can't be pruned away.
    """
    if on_error == "skip":
        return F.when(F.col("decode_error").isNull(), entries)
    if on_error != "fail":
        raise ValueError(f"on_error is 'fail' or 'skip', not {on_error!r}")
    reason = F.coalesce(F.col("decode_error"), F.lit("a field doesn't fit its type"))
    message = F.concat(
        F.lit("Corrupt change message ("), reason, F.lit("): "),
        F.col(value).cast("string"),
    )
    bad = F.col("decode_error").isNotNull() | F.col("bad_fields")
    return F.when(bad, F.raise_error(message)).otherwise(entries)


def append_log(
    messages: DataFrame,
    physical: str | T.StructType,
    metadata: Metadata = (),
    *,
    wrapped: bool = False,
    on_error: str = "fail",
    keep: Sequence[str] = (),
    value: str = "value",
    json_options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Every change as one inserted row: after image, or before image of a delete.

    Output: ``keep`` columns of the input, table columns, metadata columns.
    """
    decoded = decode(
        messages, physical, metadata,
        wrapped=wrapped, value=value, json_options=json_options,
    )
    op = F.col("change.op")
    rows = F.when(op.isin("c", "u"), F.array("change.after")).when(
        op == "d", F.array("change.before")
    )
    names = list(_named(metadata))
    return decoded.select(
        *keep, "change.meta", F.explode(_checked(rows, on_error, value)).alias("row")
    ).select(*keep, "row.*", *[F.col(f"meta.{n}").alias(n) for n in names])


def changelog(
    messages: DataFrame,
    physical: str | T.StructType,
    metadata: Metadata = (),
    *,
    order: str = "offset",
    partition: str | None = None,
    wrapped: bool = False,
    on_error: str = "fail",
    value: str = "value",
    json_options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full changelog: ``seq, kind``, table columns, metadata columns.

    ``c``/``r`` give +I, ``u`` gives -U and +U, ``d`` gives -D. ``seq`` orders
    all changes of a topic partition: twice the offset, plus one for an after image.
    ``partition`` keeps the column that names it, for `latest_by_key` to see that no
    key comes from two.
    """
    decoded = decode(
        messages, physical, metadata,
        wrapped=wrapped, insert_snapshots=True, value=value, json_options=json_options,
    )
    kept = [partition] if partition else []
    return changes_of(decoded, list(_named(metadata)), order, on_error, value, kept)


def changes_of(
    decoded: DataFrame,
    metadata: Sequence[str] = (),
    order: str = "offset",
    on_error: str = "fail",
    value: str = "value",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The changelog of decoded messages, after the columns to ``keep``."""
    op, first = F.col("change.op"), F.col(order) * 2

    def entry(kind: str, image: str, seq: Column) -> Column:
        return F.struct(
            seq.alias("seq"), F.lit(kind).alias("kind"), F.col(f"change.{image}").alias("row")
        )

    entries = (
        F.when(op.isin("c", "r"), F.array(entry("+I", "after", first + 1)))
        .when(op == "u", F.array(entry("-U", "before", first), entry("+U", "after", first + 1)))
        .when(op == "d", F.array(entry("-D", "before", first)))
    )
    return decoded.select(
        *keep, "change.meta", F.explode(_checked(entries, on_error, value)).alias("e")
    ).select(*keep, "e.seq", "e.kind", "e.row.*", *[F.col(f"meta.{n}").alias(n) for n in metadata])


def to_debezium_json(changes: DataFrame, columns: Sequence[str]) -> Column:
    """The ``value`` column that writes a changelog row as a message.

    Retractions (-U, -D) become ``d``, additions (+I, +U) become ``c``: an
    update is two messages.
    """
    row = F.struct(*columns)
    added = F.col("kind").isin("+I", "+U")
    return F.to_json(
        F.struct(
            F.when(~added, row).alias("before"),
            F.when(added, row).alias("after"),
            F.when(added, "c").otherwise("d").alias("op"),
        ),
        {
            "ignoreNullFields": "false",
            "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSS",
            "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS'Z'",
        },
    )


def split_schema_changes(
    messages: DataFrame, wrapped: bool = False, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Row changes, and the schema changes a feed may carry between them.

    A schema change has no ``op`` but a ``ddl`` or ``historyRecord``; anything
    else without ``op`` stays, for `decode` to judge.
    """
    base = "$.payload." if wrapped else "$."
    op, ddl, history = (
        F.get_json_object(F.col(value).cast("string"), base + f)
        for f in ("op", "ddl", "historyRecord")
    )
    is_schema = op.isNull() & (ddl.isNotNull() | history.isNotNull())
    return messages.where(~is_schema), messages.where(is_schema)


def _named(metadata: Metadata) -> dict[str, MetadataField]:
    if not isinstance(metadata, Mapping):
        metadata = {m.replace(".", "_").replace("-", "_"): m for m in metadata}
    unknown = set(metadata.values()) - set(METADATA)
    if unknown:
        raise ValueError(f"unknown metadata {sorted(unknown)}; known: {sorted(METADATA)}")
    return {alias: METADATA[name] for alias, name in metadata.items()}


def _message_schema(
    physical: str | T.StructType, fields: Sequence[MetadataField], wrapped: bool
) -> T.StructType:
    row = T.StructType.fromDDL(physical) if isinstance(physical, str) else physical
    # A missing JSON field is NULL, whatever the table says.
    row = T.StructType([T.StructField(f.name, f.dataType, True) for f in row])
    body = {"before": row, "after": row, "op": T.StringType()}
    root: dict[str, T.DataType] = {}
    for f in fields:
        (body if f.in_payload else root).setdefault(
            f.json_field, T.DataType.fromDDL(f.json_type)
        )
    if wrapped:
        root = {"payload": _struct(body), **root}
    else:
        root = {**body, **root}
    return _struct({**root, CORRUPT: T.StringType()})


def _struct(fields: Mapping[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])
