"""Keyed tables: upserts by key from a stream, with or without a lake format."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.changes import latest_by_key, merge_latest
from tidelog.streaming import files


@dataclass
class KeyedFiles:
    """Upsert by key over plain Parquet.

    Every batch is reduced to one row per key and written, removed keys
    included, under ``changes/batch=<id>``; a replay replaces that folder. The
    table is the newest row per key over all of them, so a late older row never
    revives a key. `compact` rewrites the history to one row per key, after every
    ``compact_every`` batches by itself.

    Files are the partitions of the aggregate that reduced them: as many as
    adaptive execution makes for their size. ``schema`` is the table's, for reading
    it before the first batch. With ``partition`` (the column of a topic's
    partition) a key that comes from two partitions ends the job.
    """

    spark: SparkSession
    path: str
    keys: Sequence[str]
    order: str = "seq"
    schema: str | T.StructType | None = None
    compact_every: int = 50
    partition: str | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.upsert(batch, batch_id)

    def upsert(self, changes: DataFrame, batch_id: int) -> None:
        newest = latest_by_key(
            changes, self.keys, self.order, keep_deleted=True, partition=self.partition
        )
        newest.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch_id:012d}")
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact()

    def read(self, before_batch: int | None = None) -> DataFrame | None:
        """The table now, or as it was before a batch.

        Before the first batch it is empty, or None if no ``schema`` is given.
        """
        history = self._history(before_batch)
        if history is None:
            return None if self.schema is None else self.spark.createDataFrame([], self.schema)
        newest = merge_latest(history, self.keys, self.order, self.partition)
        hidden = ["deleted", self.order, *([self.partition] if self.partition else [])]
        return newest.where(~F.col("deleted")).drop(*hidden)

    def compact(self) -> None:
        """Write one row per key, up to the newest complete batch, to a new folder."""
        found = self._folders(None)
        if len(found) < 2:
            return
        newest = merge_latest(self.spark.read.parquet(*found), self.keys, self.order, self.partition)
        upto = found[-1].rsplit("=", 1)[1]
        newest.write.mode("overwrite").parquet(f"{self.path}/base/upto={upto}")

    def _history(self, before_batch: int | None) -> DataFrame | None:
        found = self._folders(before_batch)
        return self.spark.read.parquet(*found) if found else None

    def _folders(self, before_batch: int | None) -> list[str]:
        """The newest complete base and the complete batches after it: only these are looked into."""
        limit = float("inf") if before_batch is None else before_batch
        bases = (f for n, f in reversed(self._named("base/upto")) if n < limit)
        base = next((f for f in bases if files.exists(self.spark, f"{f}/{files.MARKER}")), None)
        start = int(base.rsplit("=", 1)[1]) if base else -1
        return ([base] if base else []) + [
            f
            for n, f in self._named("changes/batch")
            if start < n < limit and files.exists(self.spark, f"{f}/{files.MARKER}")
        ]

    def _named(self, prefix: str) -> list[tuple[int, str]]:
        """Folders by the number in their name, from one listing."""
        found = files.folders(self.spark, f"{self.path}/{prefix}=*")
        return sorted((int(folder.rsplit("=", 1)[1]), folder) for folder in found)


@dataclass
class BucketedFiles(KeyedFiles):
    """As `KeyedFiles`, with upkeep that follows the changes.

    Rows lie in ``buckets`` by a hash of their key's text. `compact` reads and writes only
    buckets that have changed; the base of the others stays where it is. A manifest per
    compaction names the base of every bucket and is written last, so a reader sees the
    table before or after a compaction, never between. A bucket is one task's work: take
    so many that the base of one fits into a task.
    """

    buckets: int = 64

    def upsert(self, changes: DataFrame, batch_id: int) -> None:
        newest = latest_by_key(
            changes, self.keys, self.order, keep_deleted=True, partition=self.partition
        )
        self._write(newest, f"{self.path}/changes/batch={batch_id:012d}")
        if self.compact_every and batch_id % self.compact_every == self.compact_every - 1:
            self.compact()

    def compact(self) -> list[int]:
        """Rewrite the buckets with changes up to the newest complete batch; their numbers."""
        upto, bases = self._manifest(float("inf"))
        changes = self._changes(upto, float("inf"))
        if not changes:
            return []
        parts = {b: f for folder in changes for b, f in self._buckets(folder)}
        changed = sorted(parts)
        newest = int(changes[-1].rsplit("=", 1)[1])
        if changed:
            rows = self._rows({b: n for b, n in bases.items() if b in parts}, changes)
            merged = merge_latest(rows, self.keys, self.order, self.partition)
            self._write(merged, f"{self.path}/base/upto={newest:012d}")
        bases |= {b: newest for b in changed}
        text = json.dumps({"bases": {str(b): n for b, n in sorted(bases.items())}})
        files.write_text(self.spark, f"{self.path}/manifests/upto={newest:012d}.json", text)
        return changed

    def _write(self, rows: DataFrame, path: str) -> None:
        key = F.xxhash64(*[F.col(k).cast("string") for k in self.keys])
        bucket = F.pmod(key, F.lit(self.buckets)).cast("int")
        placed = rows.withColumn("__bucket", bucket).repartition("__bucket")
        placed.write.mode("overwrite").partitionBy("__bucket").parquet(path)

    def _history(self, before_batch: int | None) -> DataFrame | None:
        limit = float("inf") if before_batch is None else before_batch
        upto, bases = self._manifest(limit)
        return self._rows(bases, self._changes(upto, limit))

    def _rows(self, bases: dict[int, int], changes: list[str]) -> DataFrame | None:
        """What the bases of some buckets hold, and all changes of the folders."""
        paths = [f"{self.path}/base/upto={n:012d}/__bucket={b}" for b, n in sorted(bases.items())]
        paths += [part for folder in changes for _, part in self._buckets(folder)]
        return self.spark.read.parquet(*paths) if paths else None

    def _buckets(self, folder: str) -> list[tuple[int, str]]:
        found = files.folders(self.spark, f"{folder}/__bucket=*")
        return sorted((int(part.rsplit("=", 1)[1]), part) for part in found)

    def _manifest(self, limit: float) -> tuple[int, dict[int, int]]:
        """The last batch and the bases by bucket of the newest compaction before a batch."""
        found = files.listed(self.spark, f"{self.path}/manifests/upto=*.json")
        numbers = sorted((int(f.rsplit("=", 1)[1].split(".")[0]), f) for f in found)
        for number, file in reversed(numbers):
            if number < limit:
                bases = json.loads(files.read_text(self.spark, file) or "")["bases"]
                return number, {int(b): n for b, n in bases.items()}
        return -1, {}

    def _changes(self, after: int, limit: float) -> list[str]:
        return [
            f
            for n, f in self._named("changes/batch")
            if after < n < limit and files.exists(self.spark, f"{f}/{files.MARKER}")
        ]


def merge_sql(
    target: str, source: str, keys: Sequence[str], columns: Sequence[str], order: str = "seq"
) -> str:
    """MERGE for a lake table that keeps ``order`` and ``deleted`` with its rows."""
    match = " AND ".join(f"t.{k} <=> s.{k}" for k in keys)
    names = [*columns, order, "deleted"]
    update = ", ".join(f"t.{c} = s.{c}" for c in names if c not in keys)
    return (
        f"MERGE INTO {target} t USING {source} s ON {match} "
        f"WHEN MATCHED AND s.{order} > t.{order} THEN UPDATE SET {update} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) "
        f"VALUES ({', '.join(f's.{c}' for c in names)})"
    )


@dataclass
class LakeUpsert:
    """Upsert into a lake table that supports MERGE and has ``order`` and ``deleted`` columns."""

    target: str
    keys: Sequence[str]
    order: str = "seq"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        newest = latest_by_key(batch, self.keys, self.order, keep_deleted=True)
        columns = [c for c in newest.columns if c not in (self.order, "deleted")]
        newest.createOrReplaceTempView("__upsert")
        newest.sparkSession.sql(
            merge_sql(self.target, "__upsert", self.keys, columns, self.order)
        )

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows that no change has removed, without the columns that the merge needs."""
        return spark.table(self.target).where(~F.col("deleted")).drop(self.order, "deleted")
