"""Tables and catalogs of a session."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# The tables the jobs write.
WAREHOUSE_TABLE = (
    "browser string, status_code string, dt string, hour string, minute string,"
    " requests bigint not null"
)
APPEND_TABLE = "id int, num int, op string, op_ts timestamp_ntz"
# The last two are what a MERGE needs to know about its rows.
KEYED_TABLE = "id int, num int, operation_ts timestamp_ntz, seq bigint, deleted boolean"


def create_table(
    spark: SparkSession,
    name: str,
    columns: str,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    format: str = "parquet",
) -> None:
    partitions = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {format}{partitions}{place}"
    )


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert_rows(rows: DataFrame, table: str) -> None:
    """INSERT INTO by column name: the table's order of columns may differ."""
    target = rows.sparkSession.table(table).columns
    if set(target) != set(rows.columns):
        raise ValueError(f"columns {rows.columns} don't fit table {table} {target}")
    rows.select(*target).write.insertInto(table)


def insert_values(spark: SparkSession, table: str, values: Sequence[str]) -> None:
    """One row of SQL literals."""
    spark.sql(f"INSERT INTO {table} VALUES ({', '.join(values)})")


def register_catalog(
    spark: SparkSession, name: str, implementation: str, **options: str
) -> None:
    """Make a catalog known to the session, e.g. a lake format's catalog class."""
    spark.conf.set(f"spark.sql.catalog.{name}", implementation)
    for key, value in options.items():
        spark.conf.set(f"spark.sql.catalog.{name}.{key.replace('_', '-')}", value)


def use_catalog(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentCatalog(name)


def show_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def show_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    return spark.sql("SHOW TABLES" + (f" IN {database}" if database else ""))


def preview(spark: SparkSession, table: str, rows: int = 10) -> DataFrame:
    """Some rows of a table, in no order."""
    return spark.table(table).limit(rows)
