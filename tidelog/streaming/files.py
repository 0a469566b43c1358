"""Folders of sinks: listings, marker files, and small files that tasks write in place."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = "_SUCCESS"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = re.compile(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def _open(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _open(spark, path)
    return fs.exists(jvm_path)


def address(spark: SparkSession, path: str) -> str:
    """The whole address of a folder, as pyarrow reads it in tasks."""
    fs, jvm_path = _open(spark, path)
    whole = fs.makeQualified(jvm_path).toString()
    return re.sub(r"^file:/(?!/)", "file:///", whole)


def touched(folders: DataFrame, path: str) -> DataFrame:
    """``folder`` of each row of ``folders`` (below ``path``), after a task has put a marker into it."""
    base = address(folders.sparkSession, path)

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = FileSystem.from_uri(base)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                store.open_output_stream(f"{place}/{folder}/{MARKER}").close()
            yield batch

    return folders.select("folder").mapInArrow(touch, "folder string")


def folder_name(names: Sequence[str], values: Sequence[str | None]) -> str:
    """Folders ``name=value`` as Spark's writers name them."""
    shown = [_ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", v) if v else NO_VALUE for v in values]
    return "/".join(f"{n}={v}" for n, v in zip(names, shown, strict=True))


def write_lines(
    lines: DataFrame, path: str, names: Sequence[str], below: str, ending: str, tasks: int | None = None
) -> int:
    """Puts ``line`` of each row into files under folders by ``names`` (text) and ``below``; how many files.

    A file holds the rows of a folder and ``share``, and has its name from these, so another
    attempt replaces it. It gets the name when it is whole. Tasks write into the folders
    themselves: with a folder or two per second of input, moving files there when all
    are written would be the longest part, and the driver's. ``tasks`` says how many tasks.
    """
    base, keys = address(lines.sparkSession, path), [*names, "share"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = FileSystem.from_uri(base)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        count = 0
        for (*values, share), found in groupby(rows, lambda row: row[:-1]):
            folder, name = f"{place}/{folder_name(names, values)}/{below}", f"part-{share:05d}.{ending}"
            staged = f"{folder}/_{uuid.uuid4().hex}"
            store.create_dir(folder)
            with store.open_output_stream(staged) as out:
                for *_, line in found:
                    out.write(f"{line}\n".encode())
            store.move(staged, f"{folder}/{name}")
            count += 1
        yield pa.RecordBatch.from_arrays([pa.array([count], pa.int64())], ["files"])

    dealt = lines.select(*keys, "line").repartition(*[tasks] if tasks else [], *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(write, "files bigint").agg(F.sum("files")).first()[0] or 0


def remove_folders(rows: DataFrame, path: str, names: Sequence[str], below: str) -> None:
    """Removes the folders that `write_lines` would put the rows into, in tasks."""
    base = address(rows.sparkSession, path)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = FileSystem.from_uri(base)
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder = f"{place}/{folder_name(names, values)}/{below}"
                if store.get_file_info(folder).type != FileType.NotFound:
                    store.delete_dir(folder)
            yield batch

    found = rows.select(*names).distinct()
    found.mapInArrow(remove, found.schema).count()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files in a folder and below it."""
    fs, jvm_path = _open(spark, path)
    return fs.getContentSummary(jvm_path).getLength()


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Moves a folder in one step; ``new`` must not exist."""
    fs, jvm_old = _open(spark, old)
    jvm_new = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(jvm_new.getParent())
    if fs.exists(jvm_new) or not fs.rename(jvm_old, jvm_new):
        raise OSError(f"can't rename {old} to {new}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _open(spark, path)
    fs.mkdirs(jvm_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _open(spark, path)
    fs.delete(jvm_path, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, or None if there is no such file."""
    fs, jvm_path = _open(spark, path)
    if not fs.exists(jvm_path):
        return None
    stream = fs.open(jvm_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, jvm_path = _open(spark, path)
    stream = fs.create(jvm_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob pattern."""
    return [s.getPath().toString() for s in _matches(spark, pattern) if s.isDirectory()]


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Files that match a glob pattern."""
    return [s.getPath().toString() for s in _matches(spark, pattern) if s.isFile()]


def first_folder(spark: SparkSession, pattern: str) -> str | None:
    """A folder that matches a glob pattern, if there is one."""
    fs, jvm_path = _open(spark, pattern)
    found = next((s for s in fs.globStatus(jvm_path) or [] if s.isDirectory()), None)
    return found and found.getPath().toString()


def _matches(spark: SparkSession, pattern: str) -> list:
    fs, jvm_path = _open(spark, pattern)
    return list(fs.globStatus(jvm_path) or [])
