"""Late rows: kept beside the rows that come in time, instead of dropped."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import instant
from tidelog.streaming import files


@dataclass
class LateGate:
    """``foreachBatch`` writer that parts late rows from the others, before any window.

    ``kept/batch=<id>`` holds what comes in time, ``late/batch=<id>`` the rest, so both
    together are the input. A row is late if its window of ``size`` (without one, its
    time) lies before the watermark of the batches before: the latest time seen, of the
    slowest ``partition`` if a column names it, less ``delay``. ``partitions`` lists those
    that hold the watermark back before their first row. A row without a time is kept.

    The watermark is stored with each batch under ``marks``, so a restart goes on from it.
    A batch is read once. It becomes visible under ``kept`` as a whole, by renaming its
    folder, and is final from then on: a replay leaves it. So a query over `kept_rows`
    with the same delay, and without a limit of files, drops no row.
    """

    path: str
    col: str
    delay: str
    size: str | None = None
    partition: str | None = None
    partitions: Sequence[int] = ()

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, kept = batch.sparkSession, f"{self.path}/kept/batch={batch_id:012d}"
        if files.exists(spark, kept):
            return
        latest, before = self._mark(spark, batch_id - 1)
        staged = f"{self.path}/staged/batch={batch_id:012d}"
        flagged = batch.withColumn("__late", self._late(batch, before))
        flagged.write.mode("overwrite").partitionBy("__late").parquet(staged)
        self._store_mark(spark, batch_id, self._latest(spark, staged, flagged.schema, latest), before)
        late = f"{self.path}/late/batch={batch_id:012d}"
        files.delete(spark, late)  # of an attempt that didn't come to its end
        if files.exists(spark, f"{staged}/__late=true"):
            files.rename(spark, f"{staged}/__late=true", late)
        if files.exists(spark, f"{staged}/__late=false"):
            files.rename(spark, f"{staged}/__late=false", kept)
        else:
            files.make_folder(spark, kept)

    def watermark(self, spark: SparkSession, batch_id: int) -> int | None:
        """Microseconds of the watermark after a batch, or None if there is none yet."""
        return self._mark(spark, batch_id)[1]

    def _time(self, df: DataFrame) -> F.Column:
        return instant(self.col) if dict(df.dtypes)[self.col] == "timestamp_ntz" else F.col(self.col)

    def _late(self, batch: DataFrame, before: int | None) -> F.Column:
        if before is None:
            return F.lit(False)
        time, mark = F.unix_micros(self._time(batch)), F.lit(before)
        if self.size is None:
            late = time < mark
        else:  # the end of the window; Spark's own function would drop rows without a time
            size = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {self.size}"))
            late = time - F.pmod(time, size) + size <= mark
        return F.coalesce(late, F.lit(False))

    def _latest(
        self, spark: SparkSession, staged: str, schema: T.StructType, latest: dict[str, int]
    ) -> dict[str, int]:
        """Latest time less the delay of each partition, from what was written; a row for each."""
        rows = spark.read.schema(schema).parquet(staged)
        name = F.col(self.partition).cast("string") if self.partition else F.lit("0")
        time = F.unix_micros(F.max(self._time(rows)) - F.expr(f"interval {self.delay}"))
        found = rows.groupBy(name.alias("part")).agg(time.alias("time")).filter("time IS NOT NULL").collect()
        return latest | {r.part: max(r.time, latest.get(r.part, r.time)) for r in found}

    def _mark(self, spark: SparkSession, batch_id: int) -> tuple[dict[str, int], int | None]:
        text = files.read_text(spark, self._mark_file(batch_id))
        if text is None:
            if batch_id >= 0:
                raise FileNotFoundError(f"no watermark of batch {batch_id} under {self.path}/marks")
            return {}, None
        mark = json.loads(text)
        return mark["latest"], mark["watermark"]

    def _store_mark(
        self, spark: SparkSession, batch_id: int, latest: dict[str, int], before: int | None
    ) -> None:
        awaited = {str(p) for p in self.partitions} - set(latest)
        now = min(latest.values()) if latest and not awaited else None
        mark = max((m for m in (before, now) if m is not None), default=None)
        text = json.dumps({"latest": latest, "watermark": mark})
        files.write_text(spark, self._mark_file(batch_id), text)

    def _mark_file(self, batch_id: int) -> str:
        return f"{self.path}/marks/{batch_id:012d}.json"


def kept_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The rows a gate let through, as a stream of whole batches."""
    return spark.readStream.schema(schema).parquet(f"{path}/kept")


def late_rows(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The side table: late rows with the ``batch`` they came in."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files.make_folder(spark, f"{path}/late")
    whole = T.StructType([*fields.fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).parquet(f"{path}/late")
