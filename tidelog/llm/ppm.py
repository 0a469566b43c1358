"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts up to four bytes deep with the counts of what
followed each in the training texts, A-Z taken as a-z. A symbol is predicted from the
longest context that saw it; each context that didn't costs an escape (method D: half a
count for each distinct follower), and its followers are excluded below it. The counts of
a shorter context are those of update exclusion: how many contexts of one byte more have
seen the symbol. A text ends with an end symbol, so the probabilities of all texts sum
to at most one.

The trie is never in one place. Tables of five-byte paths, from all training texts,
are dealt by the two bytes nearest to the predicted one, so that a task has every
context of two to four bytes that ends alike; only the counts of single bytes and of
pairs (2^16 at most) go to every task. Texts are cut into chunks; a chunk asks for the
paths and tokens that it has, and gets their code lengths and counts back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.graph import stored
from tidelog.llm.texts import Words, key_crc, pieces, text_buffer

ORDER = 4
CHUNK_BYTES = 1 << 25
SPREAD, MOST_PARTS = 32, 4096  # partitions for each chunk, and for few chunks together
END = 0xFF  # no byte of UTF-8: ends a text, and stands before it
END_TOKEN = np.uint64(0)
_PIECE = 1 << 22
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def paths(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every byte of every row, and its end, the four bytes before it and itself as one number."""
    lengths = np.diff(offsets)
    padded = np.full(len(data) + (ORDER + 1) * len(lengths), END, np.uint64)
    starts = offsets[:-1] + (ORDER + 1) * np.arange(len(lengths)) + ORDER
    padded[np.arange(len(data)) + np.repeat(starts - offsets[:-1], lengths)] = _LOWER[data]
    code = np.zeros(len(padded) - ORDER, np.uint64)
    for k in range(ORDER + 1):
        code |= padded[k : len(padded) - ORDER + k] << np.uint64(8 * (ORDER - k))
    inside = np.zeros(len(code) + 1, np.int64)
    np.add.at(inside, starts - ORDER, 1)
    np.add.at(inside, starts - ORDER + lengths + 1, -1)
    return code[np.cumsum(inside)[:-1] > 0]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, an end after each row, and the row of each."""
    words = Words(data, offsets)
    ends = words.bounds[1:]
    hashes = np.insert(words.hashes(lower=True), ends, END_TOKEN)
    return hashes, np.repeat(np.arange(len(words.counts)), words.counts + 1)


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    unique, of = np.unique(np.concatenate(keys), return_inverse=True)
    return unique, np.bincount(of.reshape(-1), np.concatenate(counts), len(unique)).astype(np.int64)


def _chunked(docs: DataFrame) -> DataFrame:
    """The rows with ``chunk``: numbered runs of about ``CHUNK_BYTES`` of a task's rows."""
    names = [*docs.columns, "chunk"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            _, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets):
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(np.full(high - low, chunk))], names)
                held += int(offsets[high] - offsets[low])
                if held >= CHUNK_BYTES:
                    chunk, held = chunk + 1, 0

    return docs.mapInArrow(number, T.StructType([*docs.schema.fields, T.StructField("chunk", T.LongType())]))


def _asked(table: DataFrame, keys: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(chunk, key, n): the distinct keys of each chunk and their counts in its training texts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, found, counts = None, [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if found:
                key, n = _merge(found, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), chunk)), pa.array(key.view(np.int64)), pa.array(n)], ["chunk", "key", "n"]
                )

        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            learned = batch.column("learned").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(numbers, prepend=numbers[:1] - 1, append=numbers[-1:] + 1)) if len(numbers) else []
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                if numbers[begin] != chunk:
                    yield from flush()
                    chunk, found, counts = int(numbers[begin]), [], []
                for wanted in (True, False):
                    rows = batch.slice(begin, end - begin).filter(pa.array(learned[begin:end] == wanted))
                    data, offsets = text_buffer(rows.column("text"))
                    for low, high in pieces(offsets, _PIECE):
                        cut = offsets[low : high + 1]
                        key, n = np.unique(keys(data[cut[0] : cut[-1]], cut - cut[0]), return_counts=True)
                        found.append(key)
                        counts.append(n if wanted else np.zeros(len(n), np.int64))
                if len(found) > 12:
                    merged = _merge(found, counts)
                    found, counts = [merged[0]], [merged[1]]
        yield from flush()

    return table.select("chunk", "learned", "text").mapInArrow(ask, "chunk bigint, key bigint, n bigint")


def _level(context: np.ndarray, symbol_counts: np.ndarray, parents: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per context (a dense number per entry): counts, distinct followers, and its followers' counts in the parent."""
    size = int(context.max()) + 1
    seen = symbol_counts > 0
    return (
        np.bincount(context, symbol_counts, size),
        np.bincount(context, seen, size),
        np.bincount(context, np.where(seen, parents, 0), size),
    )


def _step(total: np.ndarray, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of the parts of a context and of its escape; a context without followers costs nothing."""
    parts = np.log10(np.maximum(2 * total, 1))
    return parts, np.where(distinct > 0, np.log10(np.maximum(distinct, 1)) - parts, 0.0)


def code_lengths(codes: np.ndarray, counts: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each path after the four before it.

    ``codes`` are all paths of the same third and fourth byte with their training
    counts, ``pairs`` says after how many bytes before it each byte (row) was followed by
    each (column).
    """
    codes = codes.astype(np.int64)
    symbol, counts = codes & 0xFF, counts.astype(np.float64)
    last = int(codes[0] >> 8) & 0xFF
    c0, c1 = (pairs > 0).sum(0).astype(np.float64), pairs[last].astype(np.float64)
    key3, of3 = np.unique(codes & 0xFFFFFFFF, return_inverse=True)
    c3 = np.bincount(of3, counts > 0, len(key3))
    c2 = np.bincount(key3 & 0xFF, c3 > 0, 256)
    context3 = np.unique(key3 >> 8, return_inverse=True)[1]
    context4 = np.unique(codes >> 8, return_inverse=True)[1]
    total4, distinct4, shared4 = _level(context4, counts, c3[of3])
    total3, distinct3, shared3 = _level(context3, c3, c2[key3 & 0xFF])
    three = context3[of3]

    # Without what the longer context excludes:
    steps = [
        _step(total4[context4], distinct4[context4]),
        _step(total3[three] - shared4[context4], distinct3[three] - distinct4[context4]),
        _step(c2.sum() - shared3[three], (c2 > 0).sum() - distinct3[three]),
        _step(np.array([c1.sum() - c1[c2 > 0].sum()]), np.array([(c1 > 0).sum() - (c2 > 0).sum()])),
        _step(np.array([c0.sum() - c0[c1 > 0].sum()]), np.array([(c0 > 0).sum() - (c1 > 0).sum()])),
    ]
    score, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
    for own, (parts, escape) in zip((counts, c3[of3], c2[symbol], c1[symbol], c0[symbol]), steps, strict=True):
        hit = open_ & (own > 0)
        gain = np.where(hit, np.log10(np.maximum(2 * own - 1, 1)) - parts, escape)
        score += np.where(open_, gain, 0.0)
        open_ &= ~hit
    return score - np.where(open_, np.log10(max(1, 256 - int((c0 > 0).sum()))), 0.0)


def _learned_paths(totals: DataFrame) -> DataFrame:
    """(key, value): the code length of every path that some text has."""
    pair = F.col("triple").bitwiseAND(F.lit(0xFFFF)).alias("pair")
    triples = totals.filter("n > 0").select(F.col("key").bitwiseAND(F.lit(0xFFFFFF)).alias("triple")).distinct()
    rows = triples.groupBy(pair).agg(F.count("*").alias("n")).collect()  # 2^16 rows at most
    counts = np.zeros((256, 256), np.int64)
    for row in rows:
        counts[row.pair >> 8, row.pair & 0xFF] = row.n

    def length(group: pa.Table) -> pa.Table:
        key = group.column("key").to_numpy()
        value = code_lengths(key, group.column("n").to_numpy(), counts)
        return pa.table({"key": pa.array(key), "value": pa.array(value)})

    near = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    return totals.withColumn("near", near).groupBy("near").applyInArrow(length, "key bigint, value double")


def _scored(table: DataFrame, answers: DataFrame, total: int, distinct: int) -> DataFrame:
    names = [f.name for f in table.schema.fields if f.name not in ("text", "chunk")]
    below = float(np.log10(total + distinct + 1))

    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        kind = answers.column("kind").to_numpy()
        lookup = []
        for number in (0, 1):
            own = answers.filter(pa.array(kind == number))
            key, value = own.column("key").to_numpy().view(np.uint64), own.column("value").to_numpy()
            order = np.argsort(key)
            lookup.append((key[order], value[order]))
        (paths_known, lengths), (tokens_known, counts) = lookup
        logs = np.log10(counts + 1) - below
        columns: list[list[np.ndarray]] = [[], [], [], []]
        for batch in texts.select(["text"]).to_batches():
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets, _PIECE):
                cut = offsets[low : high + 1]
                part, cut = data[cut[0] : cut[-1]], cut - cut[0]
                token, row = tokens(part, cut)
                at = np.searchsorted(tokens_known, token)
                columns[0].append(np.bincount(row, minlength=high - low))
                columns[1].append(np.bincount(row, counts[at] > 0, high - low).astype(np.int64))
                columns[2].append(np.bincount(row, logs[at], high - low))
                value = lengths[np.searchsorted(paths_known, paths(part, cut))]
                begins = cut[:-1] + np.arange(high - low)
                columns[3].append(np.add.reduceat(value, begins))
        added = [pa.array(np.concatenate(c)) for c in columns]
        return pa.table(
            [*[texts.column(n) for n in names], *added], [*names, "n_tokens", "n_known", "base_score", "score"]
        )

    kept = [f for f in table.schema.fields if f.name in names]
    added = T.StructType.fromDDL("n_tokens bigint, n_known bigint, base_score double, score double").fields
    # A chunk is a few seconds' work: with many more partitions than chunks no task has several.
    chunks = table.select("chunk").distinct().count()
    usual = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(min(SPREAD * chunks, max(usual, MOST_PARTS)), 1)
    texts, known = table.repartition(parts, "chunk"), answers.repartition(parts, "chunk")
    return texts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(score, T.StructType(kept + added))


def score(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs`` (doc_id, text, learned): model and token scores, log10.

    ``learned`` marks the training texts. Both scores take A-Z as a-z. A null or empty text is only its end. Tokens
    are told apart by 64-bit hashes. Without training texts every symbol has the same
    probability. Repeated rows count, and are scored, each.
    """
    table = stored(_chunked(docs), "chunks")
    # A token has a row for each chunk that has it, however often: a window needs one shuffle less than a join.
    every = Window.partitionBy("key")
    found = _asked(table, lambda data, offsets: tokens(data, offsets)[0])
    found = found.withColumns({
        "value": F.sum("n").over(every), "first": F.row_number().over(every.orderBy("chunk")) == 1
    })
    found = stored(found, "tokens")
    total, distinct = found.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("first") & (F.col("value") > 0), 1))
    ).first()
    asked = stored(_asked(table, paths), "paths")
    totals = stored(asked.groupBy("key").agg(F.sum("n").alias("n")), "totals")
    lengths = _learned_paths(totals)
    answers = asked.select("chunk", "key").join(lengths, "key").select(
        "chunk", F.lit(0).alias("kind"), "key", "value"
    ).unionByName(found.select("chunk", F.lit(1).alias("kind"), "key", F.col("value").cast("double").alias("value")))
    scored = _scored(table, answers, total, distinct)
    return scored.withColumn("train_tokens", F.lit(total).cast("long"))


def held_out_scores(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """Scores of all documents by a model of those outside one fold; a null id is in none."""
    held_out = F.coalesce(key_crc(F.col("doc_id")) % folds == fold, F.lit(False))
    rows = docs.select(
        "doc_id", held_out.alias("held_out"), (~held_out).alias("learned"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return score(rows).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
