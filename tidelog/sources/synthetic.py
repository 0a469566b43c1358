"""Repeatable random rows: every value is a function of seed, column and row id.

Rows come from any DataFrame with an id column (``spark.range``, the ``rate``
stream, a table), so generation is as parallel as that input. The draws use
``md5``, which other SQL engines share, so the values can be checked there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.sources.rebuilt import BROWSERS, METHODS, PATHS, STATUS_CODES, pick

ORDERS = "order_uid bigint, product_id bigint, price decimal(32,2), order_time timestamp_ntz"

# More sets and ranges of the log columns.
PROTOCOLS = ("HTTP/1.1", "HTTP/2", "HTTP/1.0")
SIZE_RANGE = (100, 10000000)
MIN_AGE_MS = 5000
# First octets with private, local or reserved blocks in them.
RESERVED_OCTETS = (10, 100, 127, 169, 172, 192, 198, 203)


def draw(row_id: Column, column: str, seed: int = 0) -> Column:
    """60 random bits as a BIGINT."""
    key = F.concat_ws(":", F.lit(str(seed)), F.lit(column), row_id.cast("string"))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


#: Hex digits of a row's digest for each random log column: 64 in all.
LOG_DIGITS = {
    "client_ip": 8, "browser": 7, "version": 7, "log_time": 7, "method": 7, "path": 7,
    "protocol": 7, "status_code": 7, "size": 7,
}


def cut_digest(digest: Column, column: str) -> Column:
    """A log column's share of the bits of a row's digest."""
    names = list(LOG_DIGITS)
    start = 1 + sum(LOG_DIGITS[n] for n in names[: names.index(column)])
    return F.conv(F.substring(digest, start, LOG_DIGITS[column]), 16, 10).cast("bigint")


def random_rows(
    ids: DataFrame,
    schema: str | T.StructType,
    row_id: str = "id",
    now: Column | None = None,
    seed: int = 0,
) -> DataFrame:
    """Rows of any flat schema; times are ``now``, cut to milliseconds."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    now = F.current_timestamp() if now is None else now
    return ids.select(
        *[_typed(F.col(row_id), f, now, seed).alias(f.name) for f in schema]
    )


def _typed(row_id: Column, field: T.StructField, now: Column, seed: int) -> Column:
    bits, kind = draw(row_id, field.name, seed), field.dataType
    if isinstance(kind, T.StringType):
        return F.md5(bits.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("millisecond", now).cast(kind)
    if isinstance(kind, T.DateType):
        return now.cast("date")
    if isinstance(kind, T.BooleanType):
        return bits % 2 == 0
    if isinstance(kind, T.DecimalType):
        unscaled = bits % 10 ** min(kind.precision, 15)
        return (unscaled.cast("decimal(20,0)") / F.lit(10**kind.scale)).cast(kind)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return (bits / F.lit(float(1 << 60))).cast(kind)
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        width = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 60}[kind.simpleString()]
        return (bits % (1 << width)).cast(kind)
    raise ValueError(f"no generator for column {field.name} of type {kind.simpleString()}")


def random_logs(
    ids: DataFrame,
    row_id: str = "id",
    now: Column | None = None,
    max_age_ms: int = 15000,
    seed: int = 0,
) -> DataFrame:
    """Server logs up to ``max_age_ms`` old, never younger than five seconds.

    One digest a row gives the bits of all its columns.
    """
    now = F.current_timestamp() if now is None else now
    wall_clock = _is_wall_clock(ids, now)
    digest = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(row_id).cast("string")), 256)
    ids = ids.select(now.alias("now"), digest.alias("digest"))
    now = F.col("now")

    def bits(column: str) -> Column:
        return cut_digest(F.col("digest"), column)

    low, high = SIZE_RANGE
    age = MIN_AGE_MS + bits("log_time") % (max_age_ms - MIN_AGE_MS)
    return ids.select(
        public_ip(bits("client_ip")).alias("client_ip"),
        F.lit("-").alias("client_identity"),
        F.lit("-").alias("userid"),
        F.concat(
            pick(BROWSERS, bits("browser")),
            F.lit("/"),
            (1 + bits("version") % 120).cast("string"),
            F.lit(".0"),
        ).alias("user_agent"),
        F.timestamp_add("MILLISECOND", -age, F.date_trunc("millisecond", now))
        .cast("timestamp_ntz" if wall_clock else "timestamp")
        .alias("log_time"),
        F.concat_ws(
            " ",
            pick(METHODS, bits("method")),
            pick(PATHS, bits("path")),
            pick(PROTOCOLS, bits("protocol")),
        ).alias("request_line"),
        pick(STATUS_CODES, bits("status_code")).alias("status_code"),
        (low + bits("size") % (high - low)).cast("int").alias("size"),
    )


def public_ip(bits: Column) -> Column:
    """IPv4 address outside the reserved blocks."""
    first = (1 + F.shiftright(bits, 24) % 223).cast("int")
    octets = [
        F.when(first.isin(*RESERVED_OCTETS), 11).otherwise(first),
        *[F.shiftright(bits, n) % 256 for n in (16, 8, 0)],
    ]
    return F.concat_ws(".", *[o.cast("string") for o in octets])


def random_log_stream(
    spark: SparkSession, rows_per_second: int = 100, max_age_ms: int = 15000, seed: int = 0
) -> DataFrame:
    """Unbounded logs, aged from the time each row was made."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return random_logs(rate, "value", F.col("timestamp"), max_age_ms, seed)


def _is_wall_clock(ids: DataFrame, now: Column) -> bool:
    return ids.select(now.alias("now")).dtypes[0][1] == "timestamp_ntz"
