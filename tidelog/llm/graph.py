"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and kept for lost executors."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def _nearest(edges: DataFrame) -> DataFrame:
    """For each node the least of itself and its neighbours; a hub is aggregated before it shuffles."""
    return edges.groupBy("v").agg(F.min("u").alias("least")).select(
        F.col("v").alias("w"), F.least("least", "v").alias("least")
    )


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node with an edge to another; the root is the least node reached.

    Alternates large stars and small stars (Kiveris et al., "Connected components in
    MapReduce and beyond", 2014) until the edges stay as they are. Loops and repeated
    edges don't matter; no edges give no rows.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a != b")
    stars = stored(pairs.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).distinct(), "edges")
    mark = (F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")))
    before = stars.agg(*mark).first()
    while before[0]:
        both = stars.unionByName(stars.select(F.col("u").alias("v"), F.col("v").alias("u")))
        large = both.join(_nearest(both), F.col("v") == F.col("w")).filter(F.col("u") > F.col("v"))
        large = stored(large.select(F.col("u").alias("v"), F.col("least").alias("u")).distinct(), "large")
        least = _nearest(large)
        small = large.join(least, F.col("v") == F.col("w")).filter(F.col("u") != F.col("least"))
        small = small.select(F.col("u").alias("v"), F.col("least").alias("u"))
        own = least.select(F.col("w").alias("v"), F.col("least").alias("u"))
        stars = stored(small.unionByName(own).distinct(), "small")
        after = stars.agg(*mark).first()
        if after == before:
            break
        before = after
    return stars.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        stars.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )
