"""Tables that a stream appends to often, with closed partitions packed into few files.

Each batch adds small files. Once a partition is closed, its files are rewritten into as
many as its bytes ask for, in a folder of their own. A pointer, written last, says which
folder holds a packed partition and up to which batch; readers go by the newest pointer,
so they see a partition before or after, never both, and nothing is moved or deleted.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.streaming import files

FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class Packed:
    """Where the rows of a partition are up to a batch, and how many files that is."""

    generation: int
    batch: int


@dataclass
class PackedTable:
    """Append-only Parquet partitioned by one column; as ``foreachBatch`` writer it owns a folder per batch.

    ``schema`` is the table's, the partition column included. `pack` rewrites the
    partitions that ``closed`` accepts and that have come in since they were packed; rows
    that come later are read beside the packed ones, and packed with them by the next.
    """

    spark: SparkSession
    path: str
    schema: str | T.StructType
    partition: str
    file_bytes: int = FILE_BYTES

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.append(batch, batch_id)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        named = rows.select(*[f.name for f in self._fields()])
        named.write.mode("overwrite").partitionBy(self.partition).parquet(f"{self.path}/arrived/batch={batch_id:012d}")

    def read(self) -> DataFrame:
        """All rows, by the newest pointer when this is called."""
        _, packed = self._pointer()
        return self._rows([f for found in self._folders(packed).values() for f in found])

    def pack(self, closed: Callable[[str], bool] = lambda value: True) -> dict[str, int]:
        """Rewrite closed partitions with new files; the number of files by partition."""
        number, packed = self._pointer()
        folders = self._folders(packed)
        arrived = self._arrived(packed)
        due = sorted(v for v in arrived if closed(v))
        if not due:
            return {}
        sizes = {v: sum(files.size_of(self.spark, f) for f in folders[v]) for v in due}
        counts = {v: max(1, -(-size // self.file_bytes)) for v, size in sizes.items()}
        rows = self._rows([f for v in due for f in folders[v]])
        shares = self.spark.createDataFrame(list(counts.items()), "value string, files int")
        value = F.coalesce(F.col(self.partition).cast("string"), F.lit(_NULL))
        spread = rows.withColumn("__value", value).join(F.broadcast(shares), F.col("__value") == F.col("value"))  # a row per partition
        share = F.pmod(F.xxhash64(*rows.columns), F.col("files"))
        placed = spread.withColumn("__file", share).repartition(sum(counts.values()), "__value", "__file")
        out = f"{self.path}/generations/{number + 1:012d}"
        placed.select(*rows.columns).write.mode("overwrite").partitionBy(self.partition).parquet(out)
        newest = {v: max(n for n, _ in arrived[v]) for v in due}
        packed = packed | {v: Packed(number + 1, newest[v]) for v in due}
        self._point(number + 1, packed)
        return counts

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        """Rows of partition folders of whatever batches and generations."""
        fields = self._fields()
        if not folders:
            return self.spark.createDataFrame([], fields)
        inner = T.StructType([f for f in fields if f.name != self.partition])
        rows = self.spark.read.schema(inner).parquet(*folders)
        folder = F.regexp_extract(F.col("_metadata.file_path"), f"/{self.partition}=([^/]*)/[^/]*$", 1)
        # The path is an address, in which the escaped name is escaped once more.
        value = F.when(folder != _NULL, _unescaped(_unescaped(folder)))
        kind = fields[self.partition].dataType
        return rows.withColumn(self.partition, value.cast(kind)).select(*[f.name for f in fields])

    def _folders(self, packed: dict[str, Packed]) -> dict[str, list[str]]:
        """By partition the folders with its rows."""
        found = {v: [f"{self.path}/generations/{p.generation:012d}/{self.partition}={_escaped(self.spark, v)}"] for v, p in packed.items()}
        for value, arrived in self._arrived(packed).items():
            found.setdefault(value, []).extend(folder for _, folder in arrived)
        return found

    def _arrived(self, packed: dict[str, Packed]) -> dict[str, list[tuple[int, str]]]:
        """By partition the batches that have come since it was packed, from one listing of complete batches."""
        done = {f.rsplit("/", 2)[1] for f in files.listed(self.spark, f"{self.path}/arrived/batch=*/{files.MARKER}")}
        found: dict[str, list[tuple[int, str]]] = {}
        for folder in files.folders(self.spark, f"{self.path}/arrived/batch=*/{self.partition}=*"):
            batch, part = folder.rsplit("/", 2)[1:]
            value, number = unquote(part.split("=", 1)[1]), int(batch.split("=")[1])
            if batch in done and (value not in packed or number > packed[value].batch):
                found.setdefault(value, []).append((number, folder))
        return found

    def _pointer(self) -> tuple[int, dict[str, Packed]]:
        found = sorted(files.listed(self.spark, f"{self.path}/pointers/*.json"))
        if not found:
            return 0, {}
        number = int(found[-1].rsplit("/", 1)[1].split(".")[0])
        text = files.read_text(self.spark, found[-1]) or "{}"
        return number, {v: Packed(*entry) for v, entry in json.loads(text).items()}

    def _point(self, number: int, packed: dict[str, Packed]) -> None:
        """The pointer appears whole, by renaming; of two packers at the same time one fails."""
        text = json.dumps({v: [p.generation, p.batch] for v, p in sorted(packed.items())})
        draft = f"{self.path}/drafts/{number:012d}.json"
        files.write_text(self.spark, draft, text)
        files.rename(self.spark, draft, f"{self.path}/pointers/{number:012d}.json")

    def _fields(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema


# Fixed value: the folder of rows whose partition column is NULL.
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _unescaped(text: F.Column) -> F.Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _escaped(spark: SparkSession, value: str) -> str:
    """A value as Spark writes it into a folder's name."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.escapePathName(value)
