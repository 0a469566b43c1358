"""Alignment of two tokenizers: groups of tokens that cover the same bytes.

Both tokenizers encode the same bytes, so every place where a token of each ends cuts
the text. The cuts of a text are found by dividing: from the middle token of a span,
bisection hops between the ends of both sides to the nearest common end before and after
it. What lies between these two has no cut and is a group; what lies outside is divided
on. All spans of a piece of text are divided at once, level by level.

How often a pair of tokens is linked over the whole corpus never lies in one place: a
chunk of text asks for the pairs that it has, and gets their counts back.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property
from hashlib import sha256
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm.graph import stored
from tidelog.llm.texts import pieces, text_buffer
from tidelog.llm.token_counts import byte_characters

SECTION = 1 << 20  # bytes of text worked on at once
CHUNK_BYTES = 1 << 23  # text of a chunk, which is a row of the stored table
KEPT = 1 << 18  # segments whose tokens a task keeps, at most


# ---------------------------------------------------------------- tokens


class _Side:
    """The tokens of a tokenizer by id, and the ids of the segments it has encoded, one after the other."""

    def __init__(self, tokens: list[bytes]):
        if len(tokens) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.forget()

    def forget(self) -> None:
        self.ids, self.ends = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def learn(self, found: list[list[int]], segments: list[bytes]) -> np.ndarray:
        """Adds the ids of segments; True for those whose bytes their tokens give back."""
        ids = np.fromiter(chain.from_iterable(found), np.uint16)
        ends = np.cumsum([len(x) for x in found])
        self.ids = np.concatenate([self.ids, ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + ends])
        tokens = self.tokens
        bytes_ = np.concatenate([[0], np.cumsum(self.sizes[ids])])[ends]
        if np.array_equal(bytes_, np.cumsum([len(s) for s in segments])):
            if b"".join([tokens[i] for i in ids.tolist()]) == b"".join(segments):
                return np.ones(len(segments), bool)
        return np.array([b"".join([tokens[i] for i in x]) == s for x, s in zip(found, segments, strict=True)])

    def gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of segments by number, and how many each has."""
        lengths = np.diff(self.ends)[which]
        ends = np.cumsum(lengths)
        steps = np.repeat(self.ends[which] - ends + lengths, lengths)
        return self.ids[np.arange(len(steps)) + steps], lengths


class Encoders:
    """Both tokenizers, over segments of text that neither joins across.

    A segment begins at a space that follows something else and is followed by something
    else than white space. The pattern of A begins a word there; B has no piece with a
    word mark after another character (which is checked), and puts the mark before each
    segment itself. So the tokens of a text are those of its segments.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        byte = {c: b for b, c in byte_characters().items()}
        words = self._a.get_vocab(with_added_tokens=False)
        table = [b""] * (max(words.values()) + 1)
        for word, number in words.items():
            table[number] = bytes(byte[c] for c in word)
        self.a = _Side(table)
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = [self._b.id_to_piece(i) for i in range(self._b.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in shown):
            raise ValueError("pieces with an inner word mark can't be cut at spaces")
        self.b = _Side([
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else b"" if self._b.is_control(i) or self._b.is_unknown(i)
            else p.replace("▁", " ").encode()
            for i, p in enumerate(shown)
        ])
        self._forget()

    def _forget(self) -> None:
        self._known: dict[bytes, int] = {}
        self.same = np.zeros(0, bool)  # whether the tokens of both sides give back a segment's bytes
        self.a.forget()
        self.b.forget()

    def number(self, segments: list[bytes]) -> np.ndarray:
        """The numbers of segments on both sides; new ones are encoded."""
        if len(self._known) > KEPT:
            self._forget()
        found = list(map(self._known.get, segments))
        if None in found:
            new = list(dict.fromkeys(s for s, n in zip(segments, found, strict=True) if n is None))
            texts = [s.decode() for s in new]
            ids_a = [x.ids for x in self._a.encode_batch_fast(texts, add_special_tokens=False)]
            ids_b = self._b.encode([t[1:] for t in texts], num_threads=1)
            self.same = np.concatenate([self.same, self.a.learn(ids_a, new) & self.b.learn(ids_b, new)])
            self._known.update(zip(new, range(len(self._known), len(self._known) + len(new)), strict=True))
            found = list(map(self._known.get, segments))
        return np.array(found, np.int64)


@cache
def _encoders(path_a: str, path_b: str) -> Encoders:
    return Encoders(path_a, path_b)


_SPLITS = np.zeros(256, bool)  # first bytes of characters of which none is white space
_SPLITS[0x21:0x7F] = _SPLITS[0xC3:0xE1] = _SPLITS[0xE4:0xEF] = True


def segment_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where segments begin: at the begin of every text, and at single spaces before a word."""
    space = data == 0x20
    cut = np.zeros(len(data), bool)
    cut[1:-1] = space[1:-1] & ~space[:-2] & _SPLITS[data[2:]]
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut)


# ---------------------------------------------------------------- cuts


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of both sides that end at a common place, in order.

    ``ends_a`` and ``ends_b`` rise and begin with a 0 before the first token. A row of
    ``spans`` is (first, last) of A and of B: tokens whose ends are common. Each level
    hops once over every group that it completes, and halves every span.
    """
    cuts_a, cuts_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    cuts_a[spans[:, 1]] = cuts_b[spans[:, 3]] = True
    while len(spans):
        spans = spans[(spans[:, 1] - spans[:, 0] > 1) & (spans[:, 3] - spans[:, 2] > 1)]
        middle = (spans[:, 0] + spans[:, 1]) // 2
        after_a, after_b = _hop(ends_a, ends_b, middle, "left", 0)
        before_a, before_b = _hop(ends_a, ends_b, middle, "right", -1)
        lower, upper = before_a > spans[:, 0], after_a < spans[:, 1]
        cuts_a[before_a[lower]] = cuts_a[after_a[upper]] = True
        cuts_b[before_b[lower]] = cuts_b[after_b[upper]] = True
        halves = np.stack([spans[:, 0], before_a, spans[:, 2], before_b, after_a, spans[:, 1], after_b, spans[:, 3]], 1)
        # Both halves of a span side by side: spans stay in the order of the text, and so near in memory.
        spans = halves.reshape(-1, 4)[np.stack([lower, upper], 1).reshape(-1)]
    return np.flatnonzero(cuts_a), np.flatnonzero(cuts_b)


def _hop(ends_a: np.ndarray, ends_b: np.ndarray, start: np.ndarray, side: str, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """From tokens of A the nearest common end after (left, 0) or before (right, -1) it, by bisection."""
    at_a, at_b = start.copy(), np.zeros_like(start)
    open_ = np.arange(len(start))
    while len(open_):
        place = ends_a[at_a[open_]]
        at_b[open_] = np.searchsorted(ends_b, place, side) + shift
        other = ends_b[at_b[open_]]
        open_, other = open_[other != place], other[other != place]
        at_a[open_] = np.searchsorted(ends_a, other, side) + shift
        open_ = open_[ends_a[at_a[open_]] != other]
    return at_a, at_b


@dataclass
class Aligned:
    """The tokens of some texts, and their groups; ``counts`` has one entry per text of a side."""

    a: np.ndarray
    b: np.ndarray
    ends_a: np.ndarray
    ends_b: np.ndarray
    counts_a: np.ndarray
    counts_b: np.ndarray
    cuts_a: np.ndarray  # tokens of A before the end of each group
    cuts_b: np.ndarray

    @cached_property
    def counts_groups(self) -> np.ndarray:
        edges = np.searchsorted(self.cuts_a, np.cumsum(self.counts_a), "right")
        return np.diff(edges, prepend=0)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of ids whose bytes overlap, A in the upper half; and how many each text has."""
        size = int(self.ends_a[-1])
        marks_a, marks_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        marks_a[self.ends_a[1:]] = marks_b[self.ends_b[1:]] = True
        places = np.flatnonzero(marks_a | marks_b)  # a link ends where one of its tokens does
        at_a, at_b = (np.cumsum(m)[places] - m[places] for m in (marks_a, marks_b))
        codes = self.a[at_a].astype(np.uint32) << np.uint32(16) | self.b[at_b]
        return codes, self.counts_a + self.counts_b - self.counts_groups

    def written(self) -> tuple[pa.Buffer, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3`` of all texts, each closed by a semicolon, and where each ends."""
        if not len(self.a):
            return pa.py_buffer(b""), np.zeros(len(self.counts_a), np.int64)
        items = np.empty(len(self.a) + len(self.b), np.int64)
        sides = ((self.a, self.cuts_a, np.concatenate([[0], self.cuts_b[:-1]]), 1), (self.b, self.cuts_b, self.cuts_a, 2))
        for own, cuts, other, last in sides:
            sizes = np.diff(cuts, prepend=0)
            marks = np.zeros(len(own), np.int64)
            marks[cuts - 1] = last
            items[np.arange(len(own)) + np.repeat(other, sizes)] = 3 * own.astype(np.int64) + marks
        text = _written_ids().take(pa.array(items))
        _, offsets, data = text.buffers()
        ends = np.frombuffer(offsets, np.int64)[np.cumsum(self.counts_a + self.counts_b)]
        return data, ends


@cache
def _written_ids() -> pa.Array:
    return pa.array([f"{i}{mark}" for i in range(1 << 16) for mark in ",|;"], pa.large_string())


def aligned(encoders: Encoders, data: np.ndarray, offsets: np.ndarray) -> Aligned:
    """Both sides of the texts in ``data``, each with the space before it; without bytes or alike bytes, no tokens."""
    count = len(offsets) - 1
    full = np.diff(offsets) > 1
    starts = segment_starts(data, offsets)
    raw, edges = data.tobytes(), [*starts.tolist(), len(data)]
    which = encoders.number([raw[x:y] for x, y in zip(edges, edges[1:], strict=False)])
    row = np.searchsorted(offsets, starts, "right") - 1
    full[row[~encoders.same[which]]] = False
    which, row = which[full[row]], row[full[row]]
    (a, sizes_a), (b, sizes_b) = encoders.a.gather(which), encoders.b.gather(which)
    counts_a, counts_b = (np.bincount(row, s, count).astype(np.int64) for s in (sizes_a, sizes_b))
    ends_a, ends_b = (np.concatenate([[0], np.cumsum(side.sizes[ids])]) for side, ids in ((encoders.a, a), (encoders.b, b)))
    last_a, last_b = np.cumsum(counts_a), np.cumsum(counts_b)
    spans = np.stack([last_a - counts_a, last_a, last_b - counts_b, last_b], 1)[full]
    cuts_a, cuts_b = common_ends(ends_a, ends_b, spans)
    return Aligned(a, b, ends_a, ends_b, counts_a, counts_b, cuts_a, cuts_b)


# ---------------------------------------------------------------- tables


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return (
        path_a or public_tokenizers.path("byte_bpe_50k.json"), path_b or public_tokenizers.path("piece_bpe_32k.model")
    )


def _texts(docs: DataFrame) -> DataFrame:
    """The texts with the space that B puts before them."""
    text = F.concat(F.lit(" "), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: ``doc_id`` and ``groups``, an array of (a, b) with the ids of both sides.

    A null or empty text, or one whose tokens don't give back its bytes, has no groups.
    Repeated rows have a row each; other columns are not read.
    """
    path_a, path_b = _paths(path_a, path_b)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets, SECTION):
                cut = offsets[low : high + 1]
                found = aligned(_encoders(path_a, path_b), data[cut[0] : cut[-1]], cut - cut[0])
                sides = [
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], cuts]), pa.int32()), pa.array(ids.astype(np.int32)))
                    for ids, cuts in ((found.a, found.cuts_a), (found.b, found.cuts_b))
                ]
                rows = np.concatenate([[0], np.cumsum(found.counts_groups)])
                each = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.StructArray.from_arrays(sides, ["a", "b"]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), each], ["doc_id", "groups"])

    return _texts(docs).mapInArrow(work, "doc_id bigint, groups array<struct<a:array<int>,b:array<int>>>")


_CHUNK = (
    "chunk bigint, codes binary, docs binary, steps binary, times binary, pairs binary, doc_id array<bigint>, "
    "n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, groups_sha256 array<string>"
)


def _planes(values: np.ndarray) -> bytes:
    """32-bit numbers, all lowest bytes first: small ones compress to their lowest bytes."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


class _Chunk:
    """Rows of a task until a chunk is full: figures per document, and its distinct pairs."""

    def __init__(self) -> None:
        self.size, self.ids = 0, []
        self.figures: list[list[np.ndarray]] = [[], [], [], []]
        self.digests: list[str] = []
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.pairs: list[np.ndarray] = []

    def add(self, ids: pa.Array, found: Aligned) -> None:
        codes, counts = found.links()
        rows = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
        distinct, times = np.unique(rows << np.uint64(32) | codes, return_counts=True)
        self.codes.append(distinct.astype(np.uint32))
        self.times.append(times)
        self.pairs.append(np.bincount((distinct >> np.uint64(32)).astype(np.int64), minlength=len(counts)))
        for column, values in zip(self.figures, (found.counts_a, found.counts_b, found.counts_groups, counts), strict=True):
            column.append(values)
        data, ends = found.written()
        whole, begin = memoryview(data), 0
        for end in ends.tolist():
            self.digests.append(sha256(whole[begin : end - 1]).hexdigest() if end > begin else "")
            begin = end
        self.ids.append(ids)
        self.size += int(found.ends_a[-1]) + len(ids)

    def row(self, number: int) -> pa.RecordBatch:
        codes, times, pairs = (np.concatenate(x) for x in (self.codes, self.times, self.pairs))
        own, which, docs = np.unique(codes, return_inverse=True, return_counts=True)
        which = which.reshape(-1).astype(np.int64)
        steps = np.diff(which, prepend=0)
        first = (np.cumsum(pairs) - pairs)[pairs > 0]
        steps[first] = which[first]  # pairs rise within a document
        blobs = [own.astype("<u4").tobytes(), docs.astype("<u4").tobytes(), _planes(steps), _planes(times), _planes(pairs)]
        lists = [pa.concat_arrays(self.ids), *[pa.array(np.concatenate(f)) for f in self.figures], pa.array(self.digests, pa.string())]
        return pa.RecordBatch.from_arrays(
            [pa.array([number]), *[pa.array([b], pa.binary()) for b in blobs],
             *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]],
            ["chunk", "codes", "docs", "steps", "times", "pairs", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"],
        )


def _chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, _Chunk()
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets, SECTION):
                cut = offsets[low : high + 1]
                found = aligned(_encoders(path_a, path_b), data[cut[0] : cut[-1]], cut - cut[0])
                held.add(batch.column("doc_id").slice(low, high - low), found)
                if held.size >= CHUNK_BYTES:
                    yield held.row(number)
                    number, held = number + 1, _Chunk()
        if held.ids:
            yield held.row(number)

    return _texts(docs).mapInArrow(work, _CHUNK)


def _asked(chunks: DataFrame) -> DataFrame:
    """(chunk, code, docs): the distinct pairs of each chunk and how many of its documents link them."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, codes, docs in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                codes, docs = np.frombuffer(codes, "<u4").astype(np.int64), np.frombuffer(docs, "<u4").astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(codes), chunk)), pa.array(codes), pa.array(docs)], ["chunk", "code", "docs"]
                )

    return chunks.select("chunk", "codes", "docs").mapInArrow(ask, "chunk bigint, code bigint, docs bigint")


def pair_counts(asked: DataFrame) -> DataFrame:
    """(code, count, best): the documents that link each pair, and whether no pair of its A id has more."""
    counts = asked.groupBy("code").agg(F.sum("docs").alias("count"))
    counts = counts.withColumn("a", F.shiftright("code", 16))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # a row for each A id, 2^16 at most
    return counts.join(F.broadcast(most), "a").select("code", "count", (F.col("count") == F.col("most")).alias("best"))


_RESULT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _judge(chunks: pa.Table, answers: pa.Table) -> pa.Table:
    """The result rows of one chunk, from the counts of its pairs."""
    order = np.argsort(answers.column("code").to_numpy())  # as the chunk numbers them
    count = answers.column("count").to_numpy()[order]
    best = answers.column("best").to_numpy()[order]
    steps, times, pairs = (_numbers(chunks.column(n)[0].as_py()).astype(np.int64) for n in ("steps", "times", "pairs"))
    which = np.cumsum(steps)
    first = np.cumsum(pairs) - pairs
    held = np.concatenate([[0], which])[first]
    which = which - np.repeat(held, pairs)  # steps begin anew in each document
    sums = [np.concatenate([[0], np.cumsum(times * x[which])]) for x in (best.astype(np.int64), count)]
    n_best, count_sum = (s[first + pairs] - s[first] for s in sums)
    flat = {n: chunks.column(n).combine_chunks().flatten() for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
    digests = flat.pop("groups_sha256")
    return pa.table({**flat, "n_best": pa.array(n_best), "count_sum": pa.array(count_sum), "groups_sha256": digests})


def link_figures(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: numbers of tokens, groups and links, and what the corpus says of its links.

    ``n_best`` counts links whose pair is in as many documents as any pair of its A id,
    ``count_sum`` adds up the documents over all links, ``groups_sha256`` is the digest
    of ``groups`` as text. A null or empty text, or one whose tokens don't give back its
    bytes, has zeros and an empty digest. Repeated rows count, and are returned, each.
    """
    chunks = stored(_chunks(docs, *_paths(path_a, path_b)), "chunks")
    asked = stored(_asked(chunks), "asked")
    answers = asked.select("chunk", "code").join(pair_counts(asked), "code").select("chunk", "code", "count", "best")
    return chunks.drop("codes", "docs").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_judge, _RESULT)
