"""Retracting sums on a stream: the batch operator, continued batch by batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.changes import retract_sum, retract_totals
from tidelog.operators.ordered import HOT_ROWS
from tidelog.streaming.keyed import KeyedFiles


@dataclass
class RetractingSum:
    """``foreachBatch`` writer of the changelog of ``sum(value)`` per key.

    The sums before a batch come from a keyed table next to the output, read as
    of that batch, so a replay computes and replaces the same files. Rows of a
    batch are taken in ``order``. Hot keys are cut into slices as in the batch
    operator; ``compact`` gives one change per key and batch instead of per row.

    The batch is read once: its few columns are written under ``rows``, and everything
    else is worked out from there, so a topic isn't fetched again for each step.
    """

    path: str
    keys: Sequence[str]
    value: str
    order: str
    total: str = "total"
    compact: bool = False
    compact_every: int = 50
    hot_rows: int = HOT_ROWS

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, stored = batch.sparkSession, f"{self.path}/rows/batch={batch_id:012d}"
        batch.select(*self.keys, self.value, self.order).write.mode("overwrite").parquet(stored)
        batch = spark.read.schema(batch.select(*self.keys, self.value, self.order).schema).parquet(stored)
        if batch.isEmpty():
            return
        sums = KeyedFiles(
            spark, f"{self.path}/sums", self.keys, compact_every=self.compact_every
        )
        opening = self._touched(sums.read(before_batch=batch_id), batch)
        if self.compact:
            changes = retract_totals(batch, self.keys, self.value, self.total, opening)
        else:
            changes = retract_sum(
                batch, self.keys, self.value, self.order, self.total, opening, self.hot_rows
            )
        changes.write.mode("overwrite").parquet(f"{self.path}/changes/batch={batch_id:012d}")
        sums.upsert(self._closing(batch, opening, batch_id), batch_id)

    def _touched(self, sums: DataFrame | None, batch: DataFrame) -> DataFrame | None:
        """Sums of the batch's keys only: all later work is on these."""
        if sums is None:
            return None
        new = batch.select(*[F.col(k).alias(f"__new_{k}") for k in self.keys]).distinct()
        same = F.lit(True)
        for k in self.keys:
            same = same & F.col(k).eqNullSafe(F.col(f"__new_{k}"))
        return sums.join(new, same, "left_semi")

    def _closing(self, batch: DataFrame, opening: DataFrame | None, batch_id: int) -> DataFrame:
        """Sum per touched key after the batch."""
        values = batch.select(*self.keys, F.col(self.value).alias(self.total))
        if opening is not None:
            values = values.unionByName(opening.select(*self.keys, self.total))
        added = values.groupBy(*self.keys).agg(F.sum(self.total).alias(self.total))
        return added.select(
            *self.keys,
            self.total,
            F.lit(batch_id).cast("bigint").alias("seq"),
            F.lit("+U").alias("kind"),
        )
