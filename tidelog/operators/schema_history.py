"""Change messages read by the row type in force at their offset.

A feed can carry schema changes between its row changes. Each starts a version of the
row type, which holds for the messages after it in its topic partition. A column that
isn't in the type is not read, though the message may have it; one that is, is read by
the type it has there and then turned into the type of the target table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.debezium import CORRUPT, judged
from tidelog.operators.ordered import HOT_ROWS, running_by_key
from tidelog.session import scratch_dir

# Types that a database names in its schema changes, by what reads their text.
SQL_TYPES: Mapping[str, tuple[str, ...]] = {
    "int": ("TINYINT", "SMALLINT", "MEDIUMINT", "INT", "INTEGER"),
    "bigint": ("BIGINT", "SERIAL", "BIGSERIAL"),
    "decimal(38,10)": ("DECIMAL", "NUMERIC"),
    "double": ("FLOAT", "DOUBLE", "REAL"),
    "boolean": ("BOOLEAN", "BOOL", "BIT"),
    "date": ("DATE",),
    "timestamp": ("TIMESTAMP", "DATETIME"),
    "string": ("CHAR", "VARCHAR", "TEXT", "JSON", "ENUM"),
}

_IMAGE = "map<string,string>"
_TABLE = "struct<table:struct<columns:array<struct<name:string,typeName:string>>>>"


def decode_as_of(
    messages: DataFrame,
    target: str | T.StructType,
    first: Mapping[str, str],
    *,
    order: str = "offset",
    partition: str | None = None,
    wrapped: bool = False,
    insert_snapshots: bool = False,
    value: str = "value",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """What `decode` gives, by the row type in force; schema changes themselves give nothing.

    target   schema of the table that gets the rows
    first    column -> type of the rows before the first schema change

    Adds ``schema_version``: how many schema changes of the partition came before. The
    types of columns are upper-cased names, with or without a length. A type that isn't
    in `SQL_TYPES` is read as text. ``bad_fields`` says that some value didn't fit its
    type in force, or that type's value the target's. Messages are parsed once and stored;
    the versions are running sums over (partition, order), so a partition with all
    messages is dealt by ranges, and a version is joined to its messages by its number.
    """
    fields = T.StructType.fromDDL(target) if isinstance(target, str) else target
    body = f"before {_IMAGE}, after {_IMAGE}, op string, tableChanges array<{_TABLE}>"
    schema = f"payload struct<{_struct(body)}>, {CORRUPT} string" if wrapped else f"{body}, {CORRUPT} string"
    text = F.col(value).cast("string")
    options = {"columnNameOfCorruptRecord": CORRUPT}
    parsed = messages.where(F.length(text) > 0).withColumn("__m", F.from_json(text, schema, options))
    last = F.col("__m.payload" if wrapped else "__m")["tableChanges"]
    columns = F.get(last, F.size(last) - 1)["table"]["columns"]
    parsed = parsed.withColumn("__part", F.col(partition) if partition else F.lit(0)).withColumn("__columns", columns)
    is_schema = F.col("__m.payload.op" if wrapped else "__m.op").isNull() & F.col("__columns").isNotNull()
    path = scratch_dir(messages.sparkSession, "parsed")
    parsed.withColumn("__changes", is_schema.cast("bigint")).write.parquet(path)
    stored = messages.sparkSession.read.parquet(path)
    numbered = running_by_key(
        stored, ["__part"], order, sums={"schema_version": "__changes"}, hot_rows=hot_rows
    )
    versions = numbered.filter("__changes = 1").select(
        "__part", "schema_version", F.map_from_entries(F.transform("__columns", lambda c: F.struct(c["name"], _plain(c["typeName"])))).alias("__types")
    )
    pairs = [x for name, kind in first.items() for x in (F.lit(name), _plain(F.lit(kind)))]
    rows = numbered.filter("__changes = 0").join(versions, ["__part", "schema_version"], "left")
    rows = rows.withColumn("__types", F.coalesce("__types", F.create_map(*pairs)))
    payload = F.col("__m.payload" if wrapped else "__m")
    before, after, op = payload["before"], payload["after"], payload["op"]
    corrupt = F.col("__m")[CORRUPT].isNotNull() | F.col("__m").isNull()
    row_of = lambda image: F.when(image.isNotNull(), F.struct(*[_read(image, f)[0].alias(f.name) for f in fields]))
    bad = F.lit(False)
    for image in (before, after):
        for f in fields:
            bad = bad | F.coalesce(_read(image, f)[1], F.lit(False))
    change = F.struct(
        row_of(before).alias("before"), row_of(after).alias("after"), op.alias("op"), F.struct().alias("meta")
    )
    return rows.select(
        *messages.columns,
        change.alias("change"),
        judged(corrupt, payload, op, before, after, insert_snapshots).alias("decode_error"),
        (corrupt | bad).alias("bad_fields"),
        "schema_version",
    )


def _struct(ddl: str) -> str:
    return T.StructType.fromDDL(ddl).simpleString()[len("struct<") : -1]


def _plain(kind: Column) -> Column:
    """A type's name without length, sign and the like."""
    return F.upper(F.regexp_extract(kind, r"^\s*([A-Za-z]+)", 1))


def _read(image: Column, field: T.StructField) -> tuple[Column, Column]:
    """A column of an image in the target's type, and whether its text doesn't fit."""
    raw, kind = image[field.name], F.col("__types")[field.name]
    value = F.when(kind.isNull(), F.lit(None).cast(field.dataType))
    for reader, names in SQL_TYPES.items():
        if reader != "string":
            value = value.when(kind.isin(*names), raw.try_cast(reader).cast("string").try_cast(field.dataType))
    value = value.otherwise(raw.try_cast(field.dataType))
    return value, kind.isNotNull() & raw.isNotNull() & value.isNull()
