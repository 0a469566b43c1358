"""A Merkle manifest of a dataset: blocks of digests in van Emde Boas order.

Every group of rows (a language, say) has a tree of digests, eight children to a node,
and the roots of the groups have one above them. A tree is built in rounds. In each, a
block of 8^4 consecutive nodes is reduced to its root; the block roots are the nodes of
the next round. A block lies in one array: its subtree is split at half its height, the
upper part first, then the lower parts from left to right, each laid out alike. Where a
node lies is computed from its depth and number, when a block is built and when siblings
are read, so a walk from a leaf up stays within few stretches of memory whatever their size.

Rows get their places by a range sort, so no group is in one task, however large.
"""

from __future__ import annotations

from binascii import hexlify
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.graph import stored
from tidelog.llm.ranks import ranked
from tidelog.llm.texts import key_crc

FAN = 8
HEIGHT = 4  # levels of a block above its leaves
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---------------------------------------------------------------- layout


def nodes_in(levels: int) -> int:
    """The nodes of a full tree of so many levels."""
    return (FAN**levels - 1) // (FAN - 1)


def address(levels: int, depth: int, number: np.ndarray) -> np.ndarray:
    """Where the nodes ``number`` at ``depth`` below the root lie in a tree of so many levels."""
    number = np.asarray(number, np.int64)
    if levels == 1:
        return np.zeros_like(number)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, number)
    lower, each = levels - upper, FAN ** (depth - upper)
    return nodes_in(upper) + number // each * nodes_in(lower) + address(lower, depth - upper, number % each)


def height(total: int, most: int = HEIGHT) -> int:
    """The levels above the leaves of a block, in a group of ``total`` nodes."""
    levels = 0
    while levels < most and total > 1:
        total, levels = -(-total // FAN), levels + 1
    return levels


def digest(*parts: bytes) -> bytes:
    return hexlify(sha256(b"".join(parts)).digest())


class Block:
    """A subtree in van Emde Boas order; digests are hex text of 64 bytes."""

    def __init__(self, total: int, leaves: int, nodes: np.ndarray | None = None, most: int = HEIGHT):
        self.levels = height(total, most) + 1
        self.counts = [leaves]  # nodes by level, leaves first
        for _ in range(1, self.levels):
            self.counts.append(-(-self.counts[-1] // FAN))
        self.at = [address(self.levels, self.levels - 1 - k, np.arange(n)) for k, n in enumerate(self.counts)]
        if nodes is None:
            nodes = np.zeros(1 + max(int(a[-1]) for a in self.at), "S64")
        self.nodes = nodes

    @classmethod
    def build(cls, total: int, leaves: np.ndarray, most: int = HEIGHT) -> Block:
        """From the digests of the leaves in order."""
        block = cls(total, len(leaves), most=most)
        block.nodes[block.at[0]] = leaves
        for level in range(1, block.levels):
            below, own = block.at[level - 1], block.at[level]
            for n, place in enumerate(own.tolist()):
                block.nodes[place] = digest(block.nodes[below[FAN * n : FAN * n + FAN]].tobytes())
        return block

    @property
    def root(self) -> bytes:
        return self.nodes[0]

    def siblings(self, level: int) -> list[tuple[bytes, bytes]]:
        """For every node of a level below the root, the siblings before and after it."""
        found = []
        for first in range(0, self.counts[level], FAN):
            run = self.nodes[self.at[level][first : first + FAN]].tobytes()
            found += [(run[:i], run[i + 64 :]) for i in range(0, len(run), 64)]
        return found


# ---------------------------------------------------------------- rounds


def _built(nodes: DataFrame, most: int) -> DataFrame:
    """Blocks from (grp, pos, total, leaf) and what else a row has: arrays of those columns, in order."""
    extra = [f for f in nodes.schema.fields if f.name not in ("grp", "pos", "total", "leaf")]
    names = ["grp", "block", "total", "leaves", "nodes", *[f.name for f in extra]]

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        total = rows.column("total")[0].as_py()
        leaves = np.frombuffer(b"".join(rows.column("leaf").to_pylist()), "S64")
        block = Block.build(total, leaves, most)
        lists = [pa.array([rows.column(f.name).to_pylist()], pa.list_(rows.schema.field(f.name).type)) for f in extra]
        kept = [pa.array([key[0]]), pa.array([key[1]]), pa.array([total]), pa.array([len(leaves)]), pa.array([block.nodes.tobytes()], pa.binary())]
        return pa.table([*kept, *lists], names)

    schema = "grp bigint, block bigint, total bigint, leaves bigint, nodes binary"
    schema += "".join(f", {f.name} array<{f.dataType.simpleString()}>" for f in extra)
    grouped = nodes.withColumn("block", F.floor(F.col("pos") / FAN**most)).groupBy("grp", "block")
    return stored(grouped.applyInArrow(build, schema), "blocks")


def _root() -> Column:
    """The first node of a block is its root."""
    return F.substring("nodes", 1, 64)


def rounds(nodes: DataFrame, most: int = HEIGHT) -> list[DataFrame]:
    """The blocks of each round, until every group has one; (grp, pos, total, leaf) in."""
    found, size = [_built(nodes, most)], FAN**most
    while found[-1].filter(F.col("total") > size).take(1):
        above = found[-1].filter(F.col("total") > size).select(
            "grp", F.col("block").alias("pos"), F.ceil(F.col("total") / size).alias("total"), _root().alias("leaf")
        )
        found.append(_built(above, most))
    return found


def group_roots(found: Sequence[DataFrame], most: int = HEIGHT) -> DataFrame:
    """(grp, leaf): the root of every group, from the round in which it had one block."""
    last = [blocks.filter(F.col("total") <= FAN**most).select("grp", _root().alias("leaf")) for blocks in found]
    whole = last[0]
    for more in last[1:]:
        whole = whole.unionByName(more)
    return whole


# A path goes up from a node: the siblings before and after at each level, and the root.
_PATH = "lefts array<binary>, rights array<binary>, subroot binary, root binary"


def _descend(blocks: DataFrame, most: int) -> DataFrame:
    """(grp, block, path) of the blocks whose roots are the leaves of ``blocks``, which have paths themselves."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["total"], row["leaves"], np.frombuffer(row["nodes"], "S64"), most)
                levels = [block.siblings(k) for k in range(block.levels - 1)]
                ups = [[s[i // FAN**k] for k, s in enumerate(levels)] for i in range(row["leaves"])]
                number = row["block"] * FAN**most + np.arange(row["leaves"])
                count = len(number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["grp"]] * count, pa.int64()), pa.array(number),
                        *[pa.array([[x[side] for x in up] + row[name] for up in ups], pa.list_(pa.binary())) for side, name in enumerate(("lefts", "rights"))],
                        *[pa.array([row[name]] * count, pa.binary()) for name in ("subroot", "root")],
                    ],
                    ["grp", "block", "lefts", "rights", "subroot", "root"],
                )

    wanted = blocks.select("grp", "block", "total", "leaves", "nodes", "lefts", "rights", "subroot", "root")
    return wanted.mapInArrow(each, f"grp bigint, block bigint, {_PATH}")


def with_paths(found: Sequence[DataFrame], top: DataFrame, most: int = HEIGHT) -> DataFrame:
    """The blocks of the first round with their paths to the root; ``top`` has (grp, path) of the groups."""
    own = top.withColumn("block", F.lit(0).cast("bigint"))
    single = F.col("total") <= FAN**most
    joined = found[-1].join(own, ["grp", "block"])
    for blocks in reversed(found[:-1]):
        above = _descend(joined, most)
        joined = blocks.filter(single).join(own, ["grp", "block"]).unionByName(
            blocks.filter(~single).join(above, ["grp", "block"])
        )
    return joined


def _top_paths(roots: DataFrame, groups: int, most: int) -> DataFrame:
    """(grp, path) of every group from the tree over their roots."""
    nodes = roots.select(F.lit(0).cast("bigint").alias("grp"), F.col("grp").alias("pos"), F.lit(groups).cast("bigint").alias("total"), "leaf")
    found = rounds(nodes, most)
    root = found[-1].select(_root().alias("root"))  # one row
    none = F.array().cast("array<binary>")
    start = root.select(
        F.lit(0).cast("bigint").alias("grp"), none.alias("lefts"), none.alias("rights"), F.col("root").alias("subroot"), "root"
    )
    paths = _descend(with_paths(found, start, most), most).select(F.col("block").alias("grp"), "lefts", "rights", "root")
    return paths.join(roots.withColumnRenamed("leaf", "subroot"), "grp").select("grp", "lefts", "rights", "subroot", "root")


# ---------------------------------------------------------------- rows


def field(value: Column) -> Column:
    """A value as it enters a leaf: its bytes with their number before them, or a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


_RESULT = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def _verifier(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["total"], row["leaves"], np.frombuffer(row["nodes"], "S64"), most)
                levels = [block.siblings(k) for k in range(block.levels - 1)]
                above = list(zip(row["lefts"], row["rights"], strict=True))
                # What follows the lowest level is the same for the leaves of a run.
                runs = [
                    [s[n // FAN**k] for k, s in enumerate(levels[1:])] + above for n in range(-(-row["leaves"] // FAN))
                ]
                after = [b"".join(x + y for x, y in steps) for steps in runs]
                leaves = block.nodes[block.at[0]].tolist()
                root = row["root"]
                proofs, folded = [], []
                for i, (leaf, now) in enumerate(zip(leaves, row["now"], strict=True)):
                    left, right = levels[0][i] if levels else (b"", b"")
                    proofs.append(sha256(left + right + after[i // FAN]).hexdigest())
                    held = now or leaf
                    if levels:
                        held = digest(left, held, right)
                    for before, behind in runs[i // FAN]:
                        held = digest(before, held, behind)
                    folded.append(held)
                count = len(leaves)
                text = lambda values: pa.array([v.decode() for v in values], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_id"], pa.int64()), text(leaves), text([row["subroot"]] * count), text([root] * count),
                        pa.array(proofs, pa.string()), text(folded), pa.array([f == root for f in folded], pa.bool_()),
                    ],
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
                )

    return verify


def manifest(rows: DataFrame, group: str, most: int = HEIGHT) -> DataFrame:
    """Proofs of every row, and what they fold to.

    ``rows`` has ``doc_id``, the ``leaf`` of a row as hex text, ``now`` (the leaf found
    today; null if it is the same) and the column ``group``. Leaves of a group ascend by
    ``doc_id`` (null first), equal ids by leaf; groups ascend by their value (null first,
    bytewise). ``most`` levels make a block. A row per row comes back; an empty table gives none.
    """
    order = [F.col("key").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed, _ = ranked(
        rows.select(F.col(group).alias("key"), "doc_id", F.col("leaf").cast("binary").alias("leaf"), F.col("now").cast("binary").alias("now")),
        *order, name="place",
    )
    starts = placed.groupBy("key").agg(F.min("place").alias("start"), F.count("*").alias("total"))
    starts, groups = ranked(starts, F.col("key").asc_nulls_first(), name="grp")
    # Spark broadcasts the groups if they are few, or else splits a large one among tasks.
    keyed = placed.join(starts.withColumnRenamed("key", "of"), F.col("key").eqNullSafe(F.col("of")))
    found = rounds(keyed.select("grp", (F.col("place") - F.col("start")).alias("pos"), "total", "leaf", "doc_id", "now"), most)
    top = _top_paths(stored(group_roots(found, most), "roots"), groups, most)
    return with_paths(found, top, most).mapInArrow(_verifier(most), _RESULT)


def tampered_text(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def audit(docs: DataFrame, one_in: int = 3, most: int = HEIGHT) -> DataFrame:
    """One row per document: its leaf, the roots, the digest of its proof, and what the proof makes of its row today.

    Today the texts are in lower case (A-Z) where ``one_in`` divides the checksum of the
    id; a null id has none. A null text stays as it is. Every column may be null. Repeated
    rows are leaves each.
    """
    names = [F.col(n) for n in FIELDS]
    changed = [tampered_text(F.col("text").cast("string")) if n == "text" else F.col(n) for n in FIELDS]
    hit = F.coalesce(key_crc(F.col("doc_id")) % one_in == 0, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf_of(*names).alias("leaf"), F.when(hit, leaf_of(*changed)).alias("now"),
    )
    # A range sort looks at its rows twice; texts are read once.
    return manifest(stored(rows, "leaves"), "lang", most)
