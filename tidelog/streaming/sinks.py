"""Sinks: topics, partitioned files with commit markers, ordered output, JDBC.

Batch-wise writers are classes called as ``foreachBatch`` functions. A batch
that is replayed after a failure replaces what its first attempt wrote.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.streaming import files

# Fixed value: how times are written in JSON topics.
JSON_TIME = "yyyy-MM-dd HH:mm:ss.SSS"

# Spark's topic sink is at least once and uses no transactions: all replicas must have a
# record, and readers drop repeats by the id in its headers.
DURABLE_OPTIONS = {"kafka.acks": "all"}


def json_records(rows: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Topic records whose ``value`` is the row as JSON, NULLs included.

    With ``keys`` each record has these columns as its key, so that all records of a
    key go to one partition of the topic, in their order.
    """
    options = {"ignoreNullFields": "false", "timestampNTZFormat": JSON_TIME}
    key = [record_key(keys)] if keys else []
    return rows.select(*key, F.to_json(F.struct("*"), options).alias("value"))


def record_key(keys: Sequence[str]) -> Column:
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}).alias("key")


def text_records(
    messages: DataFrame, value: str = "value", message_id: Sequence[str] = ()
) -> DataFrame:
    """Topic records that pass text on unchanged, with their key if there is one.

    Spark's topic sink is at least once. With ``message_id`` (the columns that
    identify a message at its origin, such as topic, partition and offset) each
    record carries an id in its headers, by which readers drop repeats.
    """
    columns = [F.col(value).cast("string").alias("value")]
    if "key" in messages.columns:
        columns.insert(0, F.col("key"))
    if message_id:
        name = F.concat_ws("-", *[F.col(c).cast("string") for c in message_id])
        header = F.struct(
            F.lit("message_id").alias("key"), name.cast("binary").alias("value")
        )
        columns.append(F.array(header).alias("headers"))
    return messages.select(*columns)


def message_id(headers: str = "headers") -> Column:
    """The id `text_records` put into the headers (read them with includeHeaders)."""
    named = F.filter(F.col(headers), lambda h: h["key"] == "message_id")
    return F.get(named, F.lit(0))["value"].cast("string")


# Where the newest complete partition is remembered; Spark's readers skip such names.
_NEWEST = "_newest_complete"


def minute_partition(values: dict[str, str], zone: str) -> datetime:
    """Start of a ``dt, hour, minute`` partition, whose names are local to ``zone``."""
    text = f"{values['dt']} {values['hour']}:{values['minute']}"
    return datetime.strptime(text, "%Y-%m-%d %H:%M").replace(tzinfo=ZoneInfo(zone))


@dataclass
class PartitionedJson:
    """JSON files under ``dt=/hour=/minute=``, marked when a partition is complete.

    Input: an append-mode window count, so each window arrives in one batch, after
    the watermark passed its end. ``to_columns`` gives the table's columns and
    keeps ``window``. A batch owns the subfolders ``batch=<id>`` and replaces
    them when replayed; the marker goes out last. Tasks write the files in place
    (`files.write_lines`), one for a partition of up to ``file_rows`` rows.

    A partition is complete once the watermark has passed its end (plus ``delay``),
    also when no more rows come. The watermark of a batch is in the offset log of the
    query's ``checkpoint``, an internal format of Spark that a test watches; without a
    checkpoint, the latest window that closed stands for it. Open partitions are a table
    under ``_open``, one state per batch, and tasks write the markers of those that close:
    the driver sees the newest one only, however many minutes a batch closes. Up to ``writers``
    tasks share a partition of more than ``file_rows`` rows in one batch, so a minute with
    most of the rows isn't one task's work. A batch is written by as many tasks as its rows
    ask for, ``task_rows`` each, but one for each core at least.

    Names of partitions sort in time order. The newest complete one is remembered
    next to the data, so that a start looks at later folders only.
    """

    path: str
    to_columns: Callable[[DataFrame], DataFrame]
    partition_by: Sequence[str] = ("dt", "hour", "minute")
    partition_size: timedelta = timedelta(minutes=1)
    partition_start: Callable[[dict[str, str], str], datetime] = minute_partition
    delay: timedelta = timedelta(0)
    zone: str = "UTC"
    writers: int = 4
    checkpoint: str | None = None
    file_rows: int = 10_000
    task_rows: int = 50_000
    _last: int | None = field(default=None, init=False, repr=False)  # batch that was begun last

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        again = self._last is None or batch_id != self._last + 1  # it may be a replay
        self._last = batch_id
        cached = self.to_columns(batch).persist()
        folders = None
        try:
            rows, earlier, count = cached, self._open(spark, batch_id), cached.count()
            tasks = max(spark.sparkContext.defaultParallelism, count // self.task_rows)
            if count:
                # State has the partitions of its checkpoint, each of which would write a file for each of the others.
                rows = rows.coalesce(tasks)
                folders = self._folders(rows).coalesce(tasks).persist()
                replaces = again and files.exists(spark, self.path)
                self._write(rows.drop("window"), folders, batch_id, tasks, replaces)
            self._mark(spark, rows, folders, earlier, tasks, batch_id)
        finally:
            if folders is not None:
                folders.unpersist()
            cached.unpersist()

    def _folders(self, rows: DataFrame) -> DataFrame:
        """The partitions of a batch as text, and their ``rows``."""
        names = [F.col(c).cast("string").alias(c) for c in self.partition_by]
        return rows.groupBy(*names).agg(F.count("*").alias("rows"))

    def _write(self, rows: DataFrame, folders: DataFrame, batch_id: int, tasks: int, replaces: bool) -> None:
        names, below = list(self.partition_by), f"batch={batch_id:012d}"
        line = F.to_json(F.struct(*[c for c in rows.columns if c not in names])).alias("line")
        lines = rows.select(*[F.col(c).cast("string").alias(c) for c in names], line)
        if replaces:
            files.remove_folders(folders, self.path, names, below)
        files.write_lines(self._shared(lines, folders, names), self.path, names, below, "json", tasks)

    def _shared(self, lines: DataFrame, folders: DataFrame, names: list[str]) -> DataFrame:
        """With the ``share`` of each row: 0, but in partitions of many rows by the hash of the line.

        The keys of these come to the driver, at most one for each ``file_rows`` of the batch. In a
        join of a batch with itself Spark doesn't know what is cached and runs its state again.
        """
        key = F.xxhash64(*[F.coalesce(c, F.lit("")) for c in names])
        many = []
        if self.writers > 1:
            many = folders.filter(F.col("rows") > self.file_rows).select(key.alias("__key")).collect()
        if not many:
            return lines.withColumn("share", F.lit(0))
        hot = lines.sparkSession.createDataFrame([(k, True) for k in {r[0] for r in many}], "__key bigint, __many boolean")
        dealt = F.when(F.col("__many"), F.pmod(F.xxhash64("line"), F.lit(self.writers))).otherwise(0)
        joined = lines.withColumn("__key", key).join(F.broadcast(hot), "__key", "left")
        return joined.withColumn("share", dealt.cast("int")).drop("__key", "__many")

    def _mark(
        self, spark: SparkSession, rows: DataFrame, folders: DataFrame | None, earlier: DataFrame | None, tasks: int, batch_id: int
    ) -> None:
        """Of the partitions open so far and those of the batch, markers for the closed ones."""
        until = self._watermark(spark, batch_id)
        if until is None:
            until = rows.agg(F.max(F.unix_millis(_instant("window.end")))).first()[0]
        passed = None if until is None else datetime.fromtimestamp(until / 1000, timezone.utc)
        name = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), F.col(p).cast("string")) for p in self.partition_by])
        state, open_ = self._state(batch_id), earlier
        if folders is not None:
            open_ = folders.select(name.alias("folder"))
            if earlier is not None:
                open_ = open_.unionByName(earlier).distinct().coalesce(tasks)
        if open_ is None:  # no job for a batch that only moves the watermark
            files.delete(spark, state)
            files.write_text(spark, f"{state}/{files.MARKER}", "")
            return

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                folders = batch.column("folder").to_pylist()
                closed = [passed is not None and self._end(f) + self.delay <= passed for f in folders]
                yield pa.RecordBatch.from_arrays([batch.column("folder"), pa.array(closed, pa.bool_())], ["folder", "closed"])

        judged = open_.mapInArrow(judge, "folder string, closed boolean")
        judged.write.mode("overwrite").partitionBy("closed").parquet(state)
        if files.exists(spark, f"{state}/closed=true"):
            done = files.touched(spark.read.schema("folder string").parquet(f"{state}/closed=true"), self.path)
            newest = done.agg(F.max("folder")).first()[0]
            files.write_text(spark, f"{self.path}/{_NEWEST}", newest)

    def _state(self, batch_id: int) -> str:
        return f"{self.path}/_open/batch={batch_id:012d}"

    def _open(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Partitions that were open before a batch, if any; found by their markers if no batch before has said so."""
        before = self._state(batch_id - 1)
        if files.exists(spark, f"{before}/closed=false"):
            return spark.read.schema("folder string").parquet(f"{before}/closed=false")
        known = files.exists(spark, f"{before}/{files.MARKER}")
        found = [] if known else sorted(self._unmarked(spark))
        return spark.createDataFrame([(f,) for f in found], "folder string") if found else None

    def _watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """Milliseconds of the watermark by which the batch closed its windows."""
        if self.checkpoint is None:
            return None
        log = f"{self.checkpoint}/offsets/{batch_id}"
        for line in (files.read_text(spark, log) or "").splitlines():
            if '"batchWatermarkMs"' in line:
                return json.loads(line)["batchWatermarkMs"]
        raise ValueError(f"no batchWatermarkMs in {log}: this version of Spark writes its offset log otherwise")

    def _end(self, folder: str) -> datetime:
        values = dict(part.split("=", 1) for part in folder.split("/"))
        return self.partition_start(values, self.zone) + self.partition_size

    def _unmarked(self, spark: SparkSession) -> set[str]:
        """After a start: partitions of earlier batches that aren't complete."""
        newest = (files.read_text(spark, f"{self.path}/{_NEWEST}") or "").split("/")
        found = [("", True)]  # folders, and whether the newest complete one lies in them
        for level, name in enumerate(self.partition_by):
            mark = newest[level] if level < len(newest) else ""
            below = [
                (f"{folder}/{child}".lstrip("/"), edge and child == mark)
                for folder, edge in found
                for child in self._children(spark, folder, name)
                if not edge or child >= mark
            ]
            found = below
        return {
            folder
            for folder, complete in found
            if not complete and not files.exists(spark, f"{self.path}/{folder}/{files.MARKER}")
        }

    def _children(self, spark: SparkSession, folder: str, name: str) -> list[str]:
        place = f"{self.path}/{folder}" if folder else self.path
        found = files.folders(spark, f"{place}/{name}=*")
        return [path.rsplit("/", 1)[1] for path in found]


@dataclass
class OrderedBatches:
    """Closed windows of each batch, sorted, in a folder per batch.

    Windows close in time order, so the folders in batch order are the whole
    result in order. The sort is a range-partitioned one; ``place`` rises along it,
    so that readers can tell the order without sorting by the values again.
    """

    path: str
    order: Callable[[DataFrame], DataFrame]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        ordered = self.order(batch).withColumn("place", F.monotonically_increasing_id())
        ordered.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id:012d}")


@dataclass
class JdbcUpsert:
    """Upsert by key: executors fill a staging table, then one MERGE runs.

    The batch holds one row per key (`latest_by_key`). A replayed batch merges
    the same values again. ``execute`` runs a statement; by default on a
    connection of the driver.
    """

    url: str
    table: str
    keys: Sequence[str]
    properties: dict[str, str] = field(default_factory=dict)
    quote: str = '"'
    execute: Callable[[SparkSession, str], None] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("truncate", "true").jdbc(
            self.url, self.staging, properties=self.properties
        )
        run = self.execute or self._execute
        run(batch.sparkSession, self.merge_sql(batch.columns))

    @property
    def staging(self) -> str:
        return f"{self.table}_staging"

    def merge_sql(self, columns: Sequence[str]) -> str:
        def named(c: str, side: str = "") -> str:
            return f"{side}{self.quote}{c}{self.quote}"

        match = " AND ".join(f"{named(k, 't.')} = {named(k, 's.')}" for k in self.keys)
        values = [c for c in columns if c not in self.keys]
        update = ", ".join(f"{named(c)} = {named(c, 's.')}" for c in values)
        matched = f"WHEN MATCHED THEN UPDATE SET {update} " if values else ""
        return (
            f"MERGE INTO {self.table} t USING {self.staging} s ON {match} {matched}"
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(named(c) for c in columns)}) "
            f"VALUES ({', '.join(named(c, 's.') for c in columns)})"
        )

    def _execute(self, spark: SparkSession, statement: str) -> None:
        jvm = spark._jvm
        settings = jvm.java.util.Properties()
        for key, value in self.properties.items():
            settings.setProperty(key, value)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, settings)
        try:
            connection.createStatement().executeUpdate(statement)
        finally:
            connection.close()


def _instant(name: str) -> Column:
    return F.col(name).cast("timestamp")
