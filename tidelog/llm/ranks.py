"""The place of every row in a total order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.session import scratch_dir


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> tuple[DataFrame, int]:
    """``df`` with its 0-based place in ``order``, and its number of rows.

    Range partitions are sorted and written with places of their own; only their row
    counts, one per partition, come to the driver. Ties go by where a row was read, so
    ever so many equal rows are cut into ranges like any others.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "ranks")
    tied = df.withColumn("__tie", F.monotonically_increasing_id())
    placed = tied.repartitionByRange(*order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie")
    placed.withColumn("__place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    part = F.shiftright("__place", 33)
    counts = sorted(tuple(r) for r in placed.groupBy(part).count().collect())
    offsets, total = [], 0
    for number, count in counts:
        offsets.append((number, total))
        total += count
    starts = spark.createDataFrame(offsets, "__part bigint, __start bigint")
    local = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")  # a row for each partition
        .withColumn(name, F.col("__start") + local)
        .drop("__part", "__place", "__start"),
        total,
    )
