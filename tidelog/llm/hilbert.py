"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is cut into cells of about equally many documents. Documents are
sorted by the index of their cell on the curve and the order is cut into runs of
equal length, so that a shard spans few values of every dimension and a filter on
any of them skips most shards.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.ranks import ranked
from tidelog.llm.texts import renamed

BITS = 5
SHARDS = 40
BLOCKS = 1000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the curve of each row of cells (rows x dimensions, below 2^bits).

    Skilling, "Programming the Hilbert curve" (2004): undo the excess rotations from
    the top bit down, Gray-encode, and interleave the bits.
    """
    x = np.array(cells, np.int64).T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            high = (x[d] >> bit) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(high, low, swap)
            x[d] ^= swap if d else 0
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    index = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            index = index << 1 | (x[d] >> bit) & 1
    return index


def _text_cuts(df: DataFrame, dims: Sequence[str], parts: int) -> list[list[str | None]]:
    """For each dimension the values at which 1, 2, ... of ``parts`` equal shares of the rows end, nulls first.

    Values are compared whole. They are counted and ranked; the row counts of ``BLOCKS``
    runs of values and at most ``parts`` values of each dimension come to the driver.
    """
    fields = F.array(*[F.struct(F.lit(i).alias("dim"), F.col(f"`{d}`").alias("value")) for i, d in enumerate(dims)])
    values = df.select(F.explode(fields).alias("of")).groupBy("of.dim", "of.value").agg(F.count("*").alias("n"))
    placed, count = ranked(values, F.col("dim"), F.col("value").asc_nulls_first())
    placed = placed.withColumn("run", F.expr(f"rank div {count // BLOCKS + 1}"))
    starts, totals = [], [0] * len(dims)
    for dim, run, n in sorted(tuple(r) for r in placed.groupBy("dim", "run").agg(F.sum("n")).collect()):
        starts.append((dim, run, totals[dim]))
        totals[dim] += n
    if not starts:
        return [[] for _ in dims]
    starts = df.sparkSession.createDataFrame(
        [(*s, totals[s[0]]) for s in starts], "dim int, run bigint, start bigint, total bigint"
    )
    so_far = F.sum("n").over(Window.partitionBy("dim", "run").orderBy("rank"))
    placed = placed.withColumn("through", so_far).join(F.broadcast(starts), ["dim", "run"])  # a row for each run
    first = F.expr(f"(start + through - n) * {parts} div total")
    last = F.expr(f"(start + through) * {parts} div total")
    cuts: list[list[str | None]] = [[] for _ in dims]
    ends = placed.select("dim", "rank", "value", first.alias("first"), last.alias("last")).filter("last > first")
    for dim, _, value, before, after in sorted(ends.collect(), key=lambda e: e.rank):
        cuts[dim] += [value] * (min(after, parts - 1) - before)
    return cuts


def _text_cell(value: Column, cuts: Sequence[str | None]) -> Column:
    """How many of the cuts aren't above the value; a null is the lowest value."""
    cell = F.lit(sum(c is None for c in cuts))
    for cut, times in Counter(c for c in cuts if c is not None).items():
        cell += F.when(value >= cut, times).otherwise(0)
    return cell.cast("double")


def with_index(docs: DataFrame, dims: Sequence[str], bits: int = BITS, name: str = "hilbert") -> DataFrame:
    """``docs`` with its place on the curve through ``dims``; a null is the lowest value."""
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    texts = [d for d in dims if isinstance(kinds[d], T.StringType)]
    codes = {d: F.coalesce(F.col(f"`{d}`").cast("double"), F.lit(-1e300)) for d in dims if d not in texts}
    # Equal cuts stay: a frequent value then lies as far along its dimension as its share says.
    cuts = {}
    if codes:
        shares = [k / (1 << bits) for k in range(1, 1 << bits)]
        found = docs.agg(*[F.percentile_approx(code, shares, 10_000) for code in codes.values()]).first()
        cuts = {d: np.sort(np.array(c or [], float)) for d, c in zip(codes, found, strict=True)}
    if texts:
        for d, values in zip(texts, _text_cuts(docs, texts, 1 << bits), strict=True):
            codes[d] = _text_cell(F.col(f"`{d}`"), values)
            cuts[d] = np.arange(1.0, 1 << bits)
    cuts = [cuts[d] for d in dims]

    @F.pandas_udf("bigint")
    def index(values: pd.DataFrame) -> pd.Series:
        cells = [np.searchsorted(cuts[i], values.iloc[:, i].to_numpy(float), "right") for i in range(len(cuts))]
        return pd.Series(hilbert_index(np.stack(cells, 1), bits))

    return docs.withColumn(name, index(F.struct(*[codes[d].alias(f"c{i}") for i, d in enumerate(dims)])))


def _cut(placed: DataFrame, total: int, shards: int) -> DataFrame:
    """Runs of the order whose lengths differ by one at most."""
    total = max(total, 1)
    return placed.withColumn("shard", F.expr(f"cast(rank * {shards} div {total} as int)")).withColumn(
        "slot", F.expr(f"rank - (cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    )


def _size_and_crc() -> tuple[Column, Column]:
    text = F.col("text").cast("string")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")
    return size, F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``hilbert``, ``shard`` and ``slot``.

    Columns of these names are replaced; all others pass through. The order is by
    index on the curve through source, language and size, then text checksum, then
    ``doc_id``: equal texts of equal metadata lie side by side. Repeated rows are
    ties and each has its slot. A null or empty text has no bytes; null metadata is
    the lowest value. An empty table gives no rows.
    """
    size, crc = _size_and_crc()
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("size", "text_crc32", "hilbert", "shard", "slot")])
    rows, back = renamed(docs, "source", "lang", "doc_id", "text")
    indexed = with_index(rows.withColumns({"size": size, "text_crc32": crc}), ("source", "lang", "size"))
    placed, total = ranked(indexed, F.col("hilbert"), F.col("text_crc32"), F.col("doc_id"))
    return _cut(placed, total, shards).select(*back, "size", "text_crc32", "hilbert", "shard", "slot")


def layout(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Where every document goes, without its text, and the law that holds."""
    size, crc = _size_and_crc()
    narrow = docs.select("doc_id", "lang", "source", size.alias("size"), crc.alias("text_crc32"))
    indexed = with_index(narrow, ("source", "lang", "size"))
    placed, total = ranked(indexed, F.col("hilbert"), F.col("text_crc32"), F.col("doc_id"))
    return _cut(placed, total, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "hilbert",
    )
