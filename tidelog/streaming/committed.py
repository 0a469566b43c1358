"""Topic output without repeats: readers follow a manifest of complete batches.

Spark writes to a topic at least once: a batch that fails is written again, and what the
first attempt had sent stays in the topic. Here every record says by which attempt of
which batch it was written, and a batch is complete once a manifest names its attempt. A
reader takes the records of that attempt only, however long ago the others were sent.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.streaming import files

# Fixed value: the name of the header that carries query, batch and attempt.
HEADER = "written_by"
_ENTRY = "query string, batch bigint, attempt string"


def send_to_topic(options: dict[str, str]) -> Callable[[DataFrame], None]:
    """Sends records by the topic writer, with ``topic`` and servers in the options."""
    return lambda records: records.write.format("kafka").options(includeHeaders="true", **options).save()


def send_to_files(path: str) -> Callable[[DataFrame], None]:
    """Records a topic as files, to which every attempt adds."""
    return lambda records: records.write.mode("append").parquet(path)


@dataclass
class CommittedBatches:
    """``foreachBatch`` writer of topic records with a manifest of what is complete.

    Records have ``value`` and perhaps ``key`` and ``headers``. A batch that the manifest
    has is not sent again. Its entry appears by renaming, so of two attempts at the same
    time one wins, and the other's records count as never sent.
    """

    manifest: str
    query: str
    send: Callable[[DataFrame], None]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, entry = batch.sparkSession, f"{self.manifest}/{self.query}-{batch_id:012d}.json"
        if files.exists(spark, entry):
            return
        attempt = uuid.uuid4().hex
        header = F.struct(
            F.lit(HEADER).alias("key"), F.lit(f"{self.query} {batch_id} {attempt}").cast("binary").alias("value")
        )
        given = [F.col("headers")] if "headers" in batch.columns else []
        self.send(batch.withColumn("headers", F.concat(*given, F.array(header)) if given else F.array(header)))
        written = f"{self.manifest}/_{attempt}"
        text = json.dumps({"query": self.query, "batch": batch_id, "attempt": attempt})
        files.write_text(spark, written, text)
        try:
            files.rename(spark, written, entry)
        except OSError:
            if not files.exists(spark, entry):
                raise


def entries(spark: SparkSession, manifest: str) -> DataFrame:
    """The attempt that completed each batch."""
    files.make_folder(spark, manifest)
    return spark.read.schema(_ENTRY).json(manifest)


def _writer(headers: Column) -> Column:
    named = F.filter(headers, lambda h: h["key"] == HEADER)
    return F.split(F.get(named, F.lit(0))["value"].cast("string"), " ")


def _marked(records: DataFrame) -> DataFrame:
    parts = records.withColumn("__by", _writer(F.col("headers")))
    return parts.select(
        *records.columns, F.get("__by", F.lit(0)).alias("__query"),
        F.get("__by", F.lit(1)).cast("bigint").alias("__batch"), F.get("__by", F.lit(2)).alias("__attempt"),
    )


def _judged(records: DataFrame, manifest: str) -> DataFrame:
    """``__state``: done, or open while no attempt of the batch is complete; those of lost attempts go.

    A record without the header was written by something else and counts as done.
    """
    known = entries(records.sparkSession, manifest).select(
        F.col("query").alias("__query"), F.col("batch").alias("__batch"), F.col("attempt").alias("__won")
    )
    joined = _marked(records).join(known, ["__query", "__batch"], "left")
    plain, won = F.col("__attempt").isNull(), F.col("__won")
    state = F.when(plain | (won == F.col("__attempt")), "done").when(won.isNull(), "open")
    kept = joined.withColumn("__state", state).filter("__state IS NOT NULL")
    return kept.select(*records.columns, "__state")


def committed(records: DataFrame, manifest: str) -> DataFrame:
    """Of a recorded topic the records of complete batches, each once."""
    return _judged(records, manifest).filter("__state = 'done'").drop("__state")


@dataclass
class CommittedReader:
    """``foreachBatch`` reader of a topic whose writer is `CommittedBatches`.

    ``path/batch=<id>/__state=done`` holds the records that this batch released. Records of
    a batch that isn't complete yet wait under ``__state=open`` for the next one, which
    judges them again. A replay replaces its own folder.
    """

    path: str
    manifest: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        waiting = f"{self._folder(batch_id - 1)}/__state=open"
        if files.exists(spark, waiting):
            batch = batch.unionByName(spark.read.schema(batch.schema).parquet(waiting))
        _judged(batch, self.manifest).write.mode("overwrite").partitionBy("__state").parquet(self._folder(batch_id))

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id:012d}"

    def read(self, spark: SparkSession, schema: str) -> DataFrame:
        """All released records."""
        found = files.folders(spark, f"{self.path}/batch=*/__state=done")
        return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
