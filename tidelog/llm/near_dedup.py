"""Near-duplicates by min-max hashing.

A document is the set of its five-word shingles. Under each of ``PERMUTATIONS`` hash
functions the least and the greatest value are kept, so that a signature has twice as
many values as hash functions were evaluated. Bands of values propose pairs, narrower ones
for a lower threshold; every link is confirmed on the full sets.

Documents of equal sets are one class before anything is compared. The hub of a bucket
is the class that shares most buckets with others; each class is compared with the
hubs of its buckets, which gives its difference from them. Where the classes around a
hub are then still of different components, all pairs of different components are
compared, in blocks of bounded size and by these differences, from which the size of
any intersection follows exactly. So a group of copies costs a comparison for each,
and a link between classes that meet in any band is never lost. A pair at the
threshold meets in no band with probability ``MISSED`` at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.graph import components, stored
from tidelog.llm.texts import Words, mix, pieces, renamed, runs, text_buffer

SHINGLE = 5
PERCENT = 85
PERMUTATIONS = 63
MISSED = 5e-7
BLOCK = 256
SALTS = 32  # tasks that the classes around one hub are dealt over

_random = np.random.default_rng(8712)
_FACTORS = _random.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_SHORT = _random.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """For each row the sorted hashes of its shingles; one of all words if they are fewer than five."""
    words = Words(data, offsets)
    hashes = words.hashes(lower=True)
    shingles = runs(hashes, SHINGLE)
    for begin, end in zip(words.bounds[:-1], words.bounds[1:], strict=True):
        if end - begin >= SHINGLE:
            yield np.unique(shingles[begin : end - SHINGLE + 1])
        elif end > begin:
            yield mix(np.sum(hashes[begin:end] * _SHORT[: end - begin], keepdims=True))
        else:
            yield np.zeros(0, np.uint64)


def signature(members: np.ndarray) -> np.ndarray:
    """The least value under each permutation, then the greatest under each."""
    low = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(PERMUTATIONS, np.uint64)
    for begin in range(0, len(members), 1 << 14):
        values = members[None, begin : begin + (1 << 14)] * _FACTORS[:, None]
        np.minimum(low, values.min(1), out=low)
        np.maximum(high, values.max(1), out=high)
    return np.concatenate([low, high])


def band_width(percent: int) -> int:
    """The most values a band can have so that a pair at the threshold is missed with ``MISSED`` at most."""
    for width in range(PERMUTATIONS, 0, -1):
        if (1 - (percent / 100) ** width) ** (2 * PERMUTATIONS // width) <= MISSED:
            return width
    raise ValueError(f"{PERMUTATIONS} functions are too few for a threshold of {percent} per cent")


def band_keys(signatures: np.ndarray, width: int) -> np.ndarray:
    """One key for each band of each signature (rows). A permutation's two values are in different bands."""
    bands = 2 * PERMUTATIONS // width
    cut = signatures[:, : bands * width].reshape(len(signatures), bands, width)
    weights = mix(np.arange(1, width + 1, dtype=np.uint64))
    number = mix(np.arange(1, bands + 1, dtype=np.uint64))
    return mix((mix(cut) * weights).sum(2, dtype=np.uint64) + number).view(np.int64)


def linked(shared: np.ndarray, one: np.ndarray, other: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of these sizes are similar: intersection at least ``percent`` per cent of the union."""
    return (shared > 0) & (100 * shared >= percent * (one + other - shared))


SIGNED = T.StructType(
    [
        T.StructField("__class", T.BinaryType()),
        T.StructField("__n", T.LongType()),
        T.StructField("__bands", T.ArrayType(T.LongType())),
    ]
)


def signed(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` with the class (a digest of the set), its size and keys of bands of ``width``; no words, no class."""
    names = docs.columns

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets):
                cut = offsets[low : high + 1]
                sets = list(shingle_sets(data[cut[0] : cut[-1]], cut - cut[0]))
                full = [i for i, s in enumerate(sets) if len(s)]
                marks = np.stack([signature(sets[i]) for i in full]) if full else np.zeros((0, 2 * PERMUTATIONS), np.uint64)
                keys = band_keys(marks, width)
                columns = [[None] * len(sets) for _ in range(2)]
                for at, i in enumerate(full):
                    columns[0][i] = blake2b(sets[i].tobytes(), digest_size=16).digest()
                    columns[1][i] = keys[at]
                added = [
                    pa.array(columns[0], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(columns[1], pa.list_(pa.int64())),
                ]
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays([*rows.columns, *added], [*names, *SIGNED.names])

    return docs.mapInArrow(sign, T.StructType(docs.schema.fields + SIGNED.fields))


def _differences(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """For pairs (class, hub): sizes, what the hub has more, all that only one has, and whether they are linked."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, np.zeros(0, np.uint64)
        for batch in batches:
            columns = [[] for _ in range(5)]
            for i, name in enumerate(batch.column("hub").to_pylist()):
                if name != hub:
                    hub, hub_set = name, next(shingle_sets(*text_buffer(batch.column("hub_text").slice(i, 1))))
                own = next(shingle_sets(*text_buffer(batch.column("text").slice(i, 1))))
                apart = np.setxor1d(own, hub_set, assume_unique=True)
                lacks = (len(apart) - len(own) + len(hub_set)) // 2
                link = bool(linked(len(hub_set) - lacks, len(own), len(hub_set), percent))
                values = len(own), len(hub_set), lacks, apart.tobytes(), link
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()
            yield pa.RecordBatch.from_arrays(
                [batch.column("class"), batch.column("hub"), *map(pa.array, columns, kinds)],
                ["class", "hub", "n", "hub_n", "lacks", "apart", "linked"],
            )

    own = texts.select(F.col("__class").alias("class"), "text")
    hubs = texts.select(F.col("__class").alias("hub"), F.col("text").alias("hub_text"))
    joined = pairs.join(hubs, "hub").join(own, "class").select("class", "hub", "text", "hub_text")
    return joined.mapInArrow(
        compare, "class binary, hub binary, n bigint, hub_n bigint, lacks bigint, apart binary, linked boolean"
    )


def _shared(apart: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets; memory doesn't grow with the sets."""
    owner = np.repeat(np.arange(len(apart)), [len(a) for a in apart])
    values, at, count = np.unique(np.concatenate(apart), return_inverse=True, return_counts=True)
    common = count > 1
    place = (np.cumsum(common) - 1)[at]
    held = common[at]
    owner, place = owner[held], place[held]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    shared = np.zeros((len(apart), len(apart)), np.float32)
    for begin in range(0, int(common.sum()), 4096):
        low, high = np.searchsorted(place, [begin, begin + 4096])
        part = np.zeros((len(apart), 4096), np.float32)
        part[owner[low:high], place[low:high] - begin] = 1
        shared += part @ part.T
    return shared.astype(np.int64)


def _block_links(rows: list[dict], within: bool, percent: int) -> list[tuple[bytes, bytes]]:
    """Pairs of components of a block that links between their classes connect, as stars."""
    roots, of = np.unique([r["root"].hex() for r in rows], return_inverse=True)
    block, n, lacks = (np.array([r[k] for r in rows]) for k in ("block", "n", "lacks"))
    # Both sets lie around the hub: |A & B| = |hub| - |hub - A| - |hub - B| + |(A ^ hub) & (B ^ hub)|.
    shared = _shared([np.frombuffer(r["apart"], np.uint64) for r in rows])
    shared += rows[0]["hub_n"] - lacks[:, None] - lacks[None, :]
    link = linked(shared, n[:, None], n[None, :], percent) & (of[:, None] != of[None, :])
    if not within:
        link &= block[:, None] != block[None, :]
    joined = {tuple(sorted(p)) for p in zip(of[np.nonzero(link)[0]].tolist(), of[np.nonzero(link)[1]].tolist())}
    label = list(range(len(roots)))

    def find(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    found = []
    for a, b in joined:
        a, b = find(a), find(b)
        if a != b:
            label[max(a, b)] = min(a, b)
            found.append((bytes.fromhex(roots[a]), bytes.fromhex(roots[b])))
    return found


def _rest(around: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of components (a, b) that links between classes around the same hub connect."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("rows")[i].as_py()
                found = _block_links(rows, batch.column("within")[i].as_py(), percent) if len(rows) > 1 else []
                sides = list(zip(*found, strict=True)) or [(), ()]
                yield pa.RecordBatch.from_arrays([pa.array(s, pa.binary()) for s in sides], ["a", "b"])

    rooted = around.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "root", F.coalesce("root", "class")
    )
    mixed = rooted.groupBy("hub").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")
    ).filter("low != high")
    # A hub with many classes is met in parts.
    salted = rooted.withColumn("salt", F.pmod(F.xxhash64(F.lit(1), "class"), F.lit(SALTS)).cast("int"))
    parts = mixed.select("hub", "blocks", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    rows = salted.join(parts, ["hub", "salt"]).drop("salt")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # A block meets every block of its hub once: itself and each other.
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = rows.groupBy("hub", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")).agg(
        F.collect_list(F.struct("root", "block", "n", "hub_n", "lacks", "apart")).alias("rows")
    )
    blocks = blocks.select((F.col("p") == F.col("q")).alias("within"), "rows")
    return blocks.mapInArrow(compare, "a binary, b binary").distinct()


def grouped(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The signed rows, each with a number, and (class, component) of every class linked to another."""
    table = stored(signed(docs, band_width(percent)).withColumn("__row", F.monotonically_increasing_id()), "signed")
    first = F.min_by(F.struct("__row", "__bands"), F.col("__row"))
    classes = table.filter("__class is not null").groupBy("__class").agg(first.alias("one")).select("__class", "one.*")
    classes = stored(classes, "classes")
    bands = classes.select("__class", F.explode("__bands").alias("key"))
    sizes = stored(bands.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    multi = stored(bands.join(sizes, "key"), "buckets")
    met = multi.groupBy("__class").agg(F.sum("size").alias("met"))
    hubs = multi.join(met, "__class").groupBy("key").agg(F.max_by("__class", F.struct("met", "__class")).alias("hub"))
    pairs = multi.join(hubs, "key").select(F.col("__class").alias("class"), "hub").distinct()
    rows = classes.join(met.select("__class"), "__class").select("__row", "__class")
    texts = stored(table.select("__row", "text").join(rows, "__row").select("__class", "text"), "texts")
    around = stored(_differences(pairs, texts, percent), "around")
    roots = components(around.filter("linked"), "class", "hub")
    rest = components(_rest(around, roots, percent), "a", "b").select(F.col("node").alias("root"), F.col("root").alias("top"))
    nodes = around.select(F.col("class").alias("node")).distinct().join(roots, "node", "left")
    nodes = nodes.withColumn("root", F.coalesce("root", "node")).join(rest, "root", "left")
    found = nodes.select(F.col("node").alias("__class"), F.coalesce("top", "root").alias("__component"))
    return table, stored(found, "roots")


def _with_component(table: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows without their texts, and ``__component``: a class's own digest if it has no links, null without words."""
    joined = table.select("doc_id", "__row", "__class", "__n").join(roots, "__class", "left")
    return joined.withColumn("__component", F.coalesce("__component", "__class"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Documents are linked from a similarity of ``percent`` per cent up.
    A text without words has an empty set and is linked with nothing: its component is
    its own ``doc_id`` and it is kept. A component's id is its smallest ``doc_id`` that
    isn't null. Repeated rows are copies of each other; rows with a component's id are
    all kept, and so are rows of a component without any id.
    """
    table, roots = grouped(docs.select("doc_id", F.col("text").cast("string").alias("text")), percent)
    rows = _with_component(table, roots).select("doc_id", "__n", "__component")
    least = rows.filter("__component is not null").groupBy("__component").agg(F.min("doc_id").alias("least"))
    named = rows.join(stored(least, "least"), "__component", "left")
    component = F.when(F.col("__component").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return named.select(
        "doc_id", F.col("__n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with exactly one row of each group: the least ``doc_id``, nulls last.

    Documents are linked from a similarity of ``percent`` per cent up. Of repeated rows one stays.
    Texts without words, null ones too, belong to no group and stay. Columns pass through,
    whatever their names; an empty table stays empty.
    """
    own, back = renamed(docs, "doc_id", "text")
    table, roots = grouped(own, percent)
    rows = _with_component(table, roots)
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__row"))
    least = rows.filter("__component is not null").groupBy("__component").agg(F.min_by("__row", order).alias("__row"))
    chosen = least.select("__row").unionByName(rows.filter("__component is null").select("__row"))
    # Texts shuffle once and aren't sorted: a task's row numbers are the hash table.
    kept = table.join(stored(chosen, "chosen").hint("shuffle_hash"), "__row", "left_semi")
    return kept.select(*back)
