"""Benchmark decontamination with an FM-index of each training shard.

Each task indexes its documents shard by shard. A shard's symbols are the words
that the benchmark knows; any other word is a separator. Runs of known words
shorter than the shortest window can't hold one and stay out. All windows are
searched backwards at once through the ranks of a wavelet matrix, occurrences are
located by walking to sampled suffix positions, and their spans are merged.

A benchmark larger than ``BLOCK_WORDS`` words is searched in blocks, each a pass
over the documents, so what a task holds doesn't grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.texts import NOT_ALPHANUMERIC, Words, pieces, renamed, text_buffer
from tidelog.session import scratch_dir

WINDOW = 13
BLOCK_WORDS = 1 << 19
SHARD_SYMBOLS = 1 << 19
SAMPLE = 16
ADDED = T.StructType(
    [
        T.StructField("__words", T.LongType()),
        T.StructField(
            "__spans",
            T.ArrayType(
                T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
            ),
        ),
        T.StructField("__items", T.ArrayType(T.StringType())),
    ]
)


class Patterns:
    """The distinct windows of one block of items, as rows of symbols."""

    def __init__(self, names: list[str | None], texts: list[str | None]):
        data, offsets = text_buffer(pa.array(texts, pa.large_string()))
        words = Words(data, offsets, NOT_ALPHANUMERIC)
        self.known, symbols = np.unique(words.hashes(lower=True), return_inverse=True)
        symbols = symbols.astype(np.int32) + 1
        lengths = np.minimum(words.counts, WINDOW)
        windows = np.maximum(words.counts - WINDOW + 1, words.counts > 0)
        item = np.repeat(np.arange(len(texts)), windows)
        start = np.arange(len(item)) - np.repeat(np.cumsum(windows) - windows, windows)
        start += words.bounds[:-1][item]
        table = np.zeros((len(item), WINDOW), np.int32)
        for k in range(WINDOW):
            has = k < lengths[item]
            table[has, k] = symbols[start[has] + k]
        self.windows, of = np.unique(table, axis=0, return_inverse=True)
        self.lengths = (self.windows > 0).sum(1)
        self.shortest = int(self.lengths.min(initial=WINDOW))
        pairs = np.unique(np.stack([of.reshape(-1), item], 1), axis=0).reshape(-1, 2)
        self.items = pairs[:, 1]
        self.first_item = np.searchsorted(pairs[:, 0], np.arange(len(self.windows) + 1))
        self.names = names


def _suffixes(symbols: np.ndarray) -> np.ndarray:
    """The suffix array by prefix doubling. Each separator (0) is a symbol of its own."""
    n, gap = len(symbols), symbols == 0
    ranks = symbols.astype(np.int64) + np.count_nonzero(gap)
    ranks[gap] = np.arange(np.count_nonzero(gap))
    step = 1
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[:-step] = ranks[step:] + 1
        key = ranks * (int(ranks.max()) + 2) + ahead
        order = np.argsort(key, kind="stable")
        key = key[order]
        ranks[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        if ranks[order[-1]] == n - 1 or step >= n:
            return order
        step *= 2


class WaveletMatrix:
    """A wavelet tree laid out level by level: packed bits and a count for each word of them."""

    def __init__(self, values: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            bits = (values >> bit) & 1 == 1
            packed = np.zeros(len(bits) // 64 * 8 + 8, np.uint8)
            raw = np.packbits(bits, bitorder="little")
            packed[: len(raw)] = raw
            packed = packed.view(np.uint64)
            counts = np.cumsum(np.bitwise_count(packed)) - np.bitwise_count(packed)
            zeros = len(bits) - int(bits.sum())
            self.levels.append((bit, packed, counts.astype(np.int64), zeros))
            values = np.concatenate([values[~bits], values[bits]])

    @staticmethod
    def _ones(packed: np.ndarray, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
        cell, shift = at >> 6, (at & 63).astype(np.uint64)
        below = packed[cell] & ((np.uint64(1) << shift) - np.uint64(1))
        return counts[cell] + np.bitwise_count(below)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol comes before each position."""
        begin = np.zeros_like(at)
        for bit, packed, counts, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            ones_at, ones_begin = (self._ones(packed, counts, x) for x in (at, begin))
            at = np.where(one, zeros + ones_at, at - ones_at)
            begin = np.where(one, zeros + ones_begin, begin - ones_begin)
        return at - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        symbol = np.zeros(len(at), np.int64)
        for bit, packed, counts, zeros in self.levels:
            one = (packed[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            symbol |= one.astype(np.int64) << bit
            ones = self._ones(packed, counts, at)
            at = np.where(one, zeros + ones, at - ones)
        return symbol


class FMIndex:
    """Of a sequence of symbols in which 0 separates runs; it begins and ends with 0."""

    def __init__(self, symbols: np.ndarray):
        suffixes = _suffixes(symbols)
        before = symbols[suffixes - 1].astype(np.int64)
        top = int(symbols.max())
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=top + 1))])
        self.matrix = WaveletMatrix(before, top)
        # A walk to the left must stop before a separator: run starts are sampled too.
        sampled = (suffixes % SAMPLE == 0) | (before == 0)
        self.sampled = WaveletMatrix(sampled.astype(np.int64), 1)
        self.positions = suffixes[sampled]

    def search(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
        """Windows that occur, and the range of suffixes of each."""
        low = np.zeros(len(windows), np.int64)
        high = np.full(len(windows), self.below[-1])
        live = np.arange(len(windows))
        for k in range(windows.shape[1] - 1, -1, -1):
            symbol = windows[live, k].astype(np.int64)
            inside = symbol > 0
            known = inside & (symbol < len(self.below) - 1)
            step, symbol = live[known], symbol[known]
            low[step] = self.below[symbol] + self.matrix.rank(symbol, low[step])
            high[step] = self.below[symbol] + self.matrix.rank(symbol, high[step])
            live = np.concatenate([live[~inside], step[low[step] < high[step]]])
        live = np.sort(live[lengths[live] > 0])
        return live, low[live], high[live]

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffixes given by their place in the order."""
        at, walked = at.copy(), np.zeros(len(at), np.int64)
        found, open_ = np.zeros(len(at), np.int64), np.arange(len(at))
        while len(open_):
            here = at[open_]
            done = self.sampled.access(here) == 1
            ended = open_[done]
            rank = self.sampled.rank(np.ones(len(ended), np.int64), at[ended])
            found[ended] = self.positions[rank] + walked[ended]
            open_ = open_[~done]
            symbol = self.matrix.access(at[open_])
            at[open_] = self.below[symbol] + self.matrix.rank(symbol, at[open_])
            walked[open_] += 1
        return found


def _known_runs(symbols: np.ndarray, bounds: np.ndarray, shortest: int) -> np.ndarray:
    """Of the words, those in runs of known ones (within a row) that could hold a window."""
    known = symbols > 0
    if not len(known):
        return np.zeros(0, np.int64)
    cut = np.zeros(len(known) + 1, bool)
    cut[0] = cut[-1] = True
    cut[1:-1] = known[1:] != known[:-1]
    cut[bounds] = True
    edges = np.flatnonzero(cut)
    length = np.diff(edges)
    return np.flatnonzero(np.repeat(known[edges[:-1]] & (length >= shortest), length))


class _Shard:
    """Rows of one index: their words, and of the kept words the symbol, row and place."""

    def __init__(self, patterns: Patterns):
        self.patterns, self.rows, self.batches = patterns, 0, []
        self.symbols, self.row, self.place, self.counts = [], [], [], []
        self.size = 0

    def add(self, rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> None:
        words = Words(data, offsets, NOT_ALPHANUMERIC)
        known = self.patterns.known
        symbols = np.zeros(len(words.starts), np.int32)
        if len(known):
            hashes = words.hashes(lower=True)
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            symbols = np.where(known[at] == hashes, at + 1, 0).astype(np.int32)
        kept = _known_runs(symbols, words.bounds, self.patterns.shortest)
        row = np.searchsorted(words.bounds, kept, "right") - 1
        self.symbols.append(symbols[kept])
        self.row.append(row + self.rows)
        self.place.append(kept - words.bounds[row])
        self.counts.append(words.counts)
        self.rows += len(words.counts)
        self.size += len(kept)
        self.batches.append(rows)

    def finish(self) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list, list]]:
        """Each batch of rows with its word counts, hit spans and names of items found."""
        spans = [[] for _ in range(self.rows)]
        items = [set() for _ in range(self.rows)]
        symbols, row, place = (np.concatenate(x) for x in (self.symbols, self.row, self.place))
        if len(symbols):
            self._search(symbols.astype(np.int64), row, place, spans, items)
        names, begin = self.patterns.names, 0
        for rows, counts in zip(self.batches, self.counts, strict=True):
            end = begin + len(counts)
            found = [sorted({names[i] for i in own}, key=lambda x: x or "") for own in items[begin:end]]
            yield rows, counts, spans[begin:end], found
            begin = end

    def _search(self, symbols, row, place, spans, items) -> None:
        joined = (row[1:] == row[:-1]) & (place[1:] == place[:-1] + 1)
        at = np.arange(len(symbols)) + 1 + np.concatenate([[0], np.cumsum(~joined)])
        sequence = np.zeros(at[-1] + 2, np.int64)
        sequence[at] = symbols
        index = FMIndex(sequence)
        patterns = self.patterns
        window, low, high = index.search(patterns.windows, patterns.lengths)
        if not len(window):
            return
        count = high - low
        window = np.repeat(window, count)
        rank = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
        start = np.searchsorted(at, index.locate(np.repeat(low, count) + rank))
        covered = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(covered, start, 1)
        np.add.at(covered, start + patterns.lengths[window], -1)
        hit = np.flatnonzero(np.cumsum(covered)[:-1] > 0)
        split = np.ones(len(hit), bool)
        split[1:] = ~((row[hit[1:]] == row[hit[:-1]]) & (place[hit[1:]] == place[hit[:-1]] + 1))
        firsts = hit[split]
        lasts = hit[np.append(np.flatnonzero(split)[1:] - 1, len(hit) - 1)]
        for r, a, b in zip(row[firsts], place[firsts], place[lasts], strict=True):
            spans[r].append({"first": int(a), "last": int(b)})
        pairs = np.unique(np.stack([row[start], window], 1), axis=0)
        for r, w in pairs:
            items[r].update(patterns.items[patterns.first_item[w] : patterns.first_item[w + 1]].tolist())


def merge_spans(spans: list[dict]) -> list[dict]:
    """Spans of words, last included; those that overlap or touch become one."""
    merged: list[dict] = []
    for span in sorted(spans, key=lambda x: x["first"]):
        if merged and span["first"] <= merged[-1]["last"] + 1:
            merged[-1]["last"] = max(merged[-1]["last"], span["last"])
        else:
            merged.append(dict(span))
    return merged


def _blocks(benchmark: DataFrame) -> Iterator[Patterns]:
    names, texts, words = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for name, text in rows.toLocalIterator(prefetchPartitions=False):
        names.append(name)
        texts.append(text)
        words += len((text or "").encode()) // 2 + 1  # as many words at most
        if words >= BLOCK_WORDS:
            yield Patterns(names, texts)
            names, texts, words = [], [], 0
    if names:
        yield Patterns(names, texts)


def find_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__words``, ``__spans`` (merged hit words) and ``__items``, sorted.

    A window is 13 consecutive words of an item, or all of a shorter one. A null or
    empty text has no words and no spans; an item without words has no window; items
    of a null id hit words but are named null. Repeated items count once, repeated
    documents each. Columns of ``docs`` pass through, whatever their names, unless
    they begin with ``__``.
    """
    spark = docs.sparkSession
    for number, patterns in enumerate(_blocks(benchmark)):
        if number:
            path = scratch_dir(spark, "decontaminate")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
        docs = _find_block(docs, patterns, text)
    if "__spans" not in docs.columns:
        docs = _find_block(docs, Patterns([], []), text)
    return docs


def _find_block(docs: DataFrame, patterns: Patterns, text: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(patterns)  # BLOCK_WORDS words at most
    own = [c for c in docs.columns if c not in ("__words", "__spans", "__items")]
    later = "__spans" in docs.columns
    schema = T.StructType([f for f in docs.schema.fields if f.name in own] + ADDED.fields)

    def finish(shard: _Shard) -> Iterator[pa.RecordBatch]:
        for rows, counts, spans, items in shard.finish():
            if later:
                old_spans, old_items = (rows.column(c).to_pylist() for c in ("__spans", "__items"))
                spans = [merge_spans(a + b) for a, b in zip(old_spans, spans, strict=True)]
                items = [
                    sorted({*a, *b}, key=lambda x: x or "") for a, b in zip(old_items, items, strict=True)
                ]
            kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
            added = [pa.array(counts, pa.int64()), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(
                [rows.column(c) for c in own] + added, [*own, "__words", "__spans", "__items"]
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = _Shard(sent.value), 0
        for batch in batches:
            data, offsets = text_buffer(batch.column(text))
            for low, high in pieces(offsets):
                cut = offsets[low : high + 1]
                shard.add(batch.slice(low, high - low), data[cut[0] : cut[-1]], cut - cut[0])
                held += int(cut[-1] - cut[0])
                if shard.size >= SHARD_SYMBOLS or held >= 1 << 26:
                    yield from finish(shard)
                    shard, held = _Shard(sent.value), 0
        if shard.rows:
            yield from finish(shard)

    return docs.mapInArrow(search, schema)


def _hits() -> F.Column:
    return F.aggregate(
        "__spans", F.lit(0).cast("long"), lambda total, s: total + s["last"] - s["first"] + 1
    )


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per document: its words, hit words, items, and whether it is contaminated.

    Contaminated: at least one word is hit, and at least one in twenty.
    """
    found = find_spans(docs.select(F.col(key).alias("doc_id"), F.col("text").cast("string").alias("text")), benchmark)
    return found.select(
        "doc_id",
        F.col("__words").alias("n_words"),
        _hits().alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        ((_hits() > 0) & (20 * _hits() >= F.col("__words"))).alias("contaminated"),
        F.col("__spans").alias("spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; all other rows and columns as they are, whatever their names.

    A null or empty text has no words and stays; so do null ids. Repeated rows go or stay
    together. Without items, or in an empty table, nothing goes.
    """
    own, back = renamed(docs, "text")
    found = find_spans(own, benchmark)
    return found.filter(~((_hits() > 0) & (20 * _hits() >= F.col("__words")))).select(*back)
