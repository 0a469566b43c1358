"""File and table sources: partitioned JSON, text lines, tables by name, rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.streaming import files

# Partition values stay text: inference would read minute "05" as a number.
WAREHOUSE_SCHEMA = (
    "browser string, status_code string, requests bigint,"
    " dt string, hour string, minute string"
)


def read_partitioned_json(spark: SparkSession, path: str, schema: str, many: bool = False) -> DataFrame:
    """JSON files under ``name=value`` folders; filters on those prune folders.

    Spark lists many folders in one job, but from a few days it would come to a job for
    each of their hours: it gets the second level. Its discovery of partitions takes time
    with the square of their number: with ``many`` the columns that folders name are read
    from the file's path instead.
    """
    names = _folder_names(spark, path)
    place, reader = f"{path}/*=*/*=*" if len(names) > 1 else path, spark.read
    if not many:
        return (reader.option("basePath", path) if names else reader).schema(schema).json(place)
    fields = T.StructType.fromDDL(schema)
    parts = [f for n in names for f in fields if f.name == n]
    stored = T.StructType([f for f in fields if f.name not in names])
    rows = reader.schema(stored).option("recursiveFileLookup", "true").json(place)
    found = rows.select(*stored.names, *[_of_path(f.name).cast(f.dataType).alias(f.name) for f in parts])
    # Spark would give each task 32 small files, whatever the cores.
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return found.coalesce(max(shuffles, 8 * spark.sparkContext.defaultParallelism))


def _folder_names(spark: SparkSession, path: str) -> list[str]:
    """The names in ``name=value`` folders, from the top."""
    names, place = [], path
    while place := files.first_folder(spark, f"{place}/*=*"):
        names.append(place.rsplit("/", 1)[1].split("=", 1)[0])
    return names


def _of_path(name: str) -> Column:
    """The value of a folder ``name=value``, out of the address of the row's file."""
    after = F.substring_index(F.col("_metadata.file_path"), f"/{name}=", -1)
    value = plain = F.substring_index(after, "/", 1)
    for _ in range(2):  # escaped as part of an address, and as a folder's name
        value = F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))
    return F.nullif(F.when(plain.contains("%"), value).otherwise(plain), F.lit(files.NO_VALUE))


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of new text files in a folder, as ``value``; only a line feed ends a line."""
    reader = spark.readStream.format("text").option("lineSep", "\n")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket, as ``value``; it can't be replayed, so for trials only."""
    return (
        spark.readStream.format("socket").option("host", host).option("port", port).load()
    )


def from_rows(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(rows), list(names))


def from_name(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
