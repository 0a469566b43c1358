"""Words of whole texts as arrays, over the bytes of Arrow batches.

A batch is worked through in pieces of about ``PIECE_BYTES`` bytes, so memory is
bounded by the piece or by the longest single text. Words and runs of words are
known by 64-bit hashes of all their bytes.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 22

# Separators by byte value. Bytes of multi-byte characters are never separators.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALPHANUMERIC = np.zeros(256, bool)
NOT_ALPHANUMERIC[:0x80] = [not chr(b).isalnum() for b in range(0x80)]

_random = np.random.default_rng(20240521)
_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER_CODES = _CODES.copy()
_LOWER_CODES[ord("A") : ord("Z") + 1] = _CODES[ord("a") : ord("z") + 1]
_PLACES = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all output bits (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_of_base(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for slot, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[slot] = np.cumprod(steps)
    return _powers[0], _powers[1]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and its row offsets; a null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64) if len(offsets) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, or of one longer row."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


class Words:
    """The words of the rows of one piece: byte ranges, and the first word of each row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
        self.data, self.offsets = data, offsets
        inside = ~separators[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        begins, ends = offsets[:-1][full], offsets[1:][full] - 1
        first[begins], last[ends] = inside[begins], inside[ends]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool) -> np.ndarray:
        """Of each word; ``lower`` takes A-Z as a-z."""
        return self.hasher(lower)(self.starts, self.ends)

    def hasher(self, lower: bool) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """What hashes the bytes from given starts to given ends."""
        codes = (_LOWER_CODES if lower else _CODES)[self.data]
        powers, inverse = _powers_of_base(len(codes) + 1)
        codes *= powers[: len(codes)]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes, out=sums[1:])
        return lambda starts, ends: mix((sums[ends] - sums[starts]) * inverse[starts])


def runs(hashes: np.ndarray, words: int) -> np.ndarray:
    """The hash of each run of so many consecutive entries; entry i starts at i."""
    count = max(0, len(hashes) - words + 1)
    total = np.zeros(count, np.uint64)
    for k in range(words):
        total += hashes[k : k + count] * _PLACES[k]
    return mix(total)


def reach_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it.

    A cluster whose machines don't share that path gets the package with
    ``--py-files``, as any other.
    """
    place = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if place not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [place, known]))


def map_pieces(
    df: DataFrame,
    text: str,
    work: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch],
    schema: str,
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """``work(rows, bytes, offsets)`` for every piece of every batch of ``df``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(text))
            for low, high in pieces(offsets, limit):
                cut = offsets[low : high + 1]
                yield work(batch.slice(low, high - low), data[cut[0] : cut[-1]], cut - cut[0])

    return df.mapInArrow(each, schema)


def key_crc(doc_id: Column) -> Column:
    """crc32 of the id as text: the folds are its remainders."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def word_count(text: Column) -> Column:
    """Words between ASCII white space; none in a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def renamed(docs: DataFrame, *kept: str) -> tuple[DataFrame, list[Column]]:
    """``docs`` with names that no helper column has, but for the ``kept`` ones; and the columns under their own names."""
    names = {c: c if c in kept else f"c{i}" for i, c in enumerate(docs.columns)}
    return (
        docs.select(*[F.col(f"`{c}`").alias(name) for c, name in names.items()]),
        [F.col(name).alias(c) for c, name in names.items()],
    )
