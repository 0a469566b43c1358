"""Curve order, runs of equal length, and what shards prune."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import hilbert, queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2), (1, 5)])
def test_curve_steps_to_neighbours(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    index = hilbert.hilbert_index(cells, bits)
    assert sorted(index) == list(range(1 << bits * dims))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def laws_hold(rows, texts, shards):
    counts = Counter(r.shard for r in rows)
    sizes = [counts[s] for s in range(shards)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1 and max(counts) < shards
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected


def test_whole_table(spark):
    docs = queries.read(spark, SF, "documents").collect()
    rows = queries.op3_hilbert_shards(spark, SF).collect()
    laws_hold(rows, [(r.doc_id, r.text) for r in docs], 40)
    order = [r.hilbert for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert order == sorted(order) and len(set(order)) > 30
    assert {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}


def test_shards_prune(spark):
    docs = queries.read(spark, "/root/testdata/sf0.01", "documents")
    placed = hilbert.shard(docs).select("source", "lang", "shard").collect()
    for column, most in (("source", 20), ("lang", 32)):
        shards = defaultdict(set)
        for r in placed:
            shards[r[column]].add(r.shard)
        assert np.mean([len(s) for s in shards.values()]) < most


@pytest.mark.parametrize("count", [0, 1, 39, 41, 300])
def test_odd_rows(spark, count):
    texts = [(None if i % 7 == 0 else i // 2, [None, "", "x", "long " * 200][i % 4]) for i in range(count)]
    rows = [(i, t, [None, "en"][j % 2], [None, "src1", "src", ""][j % 4], "s") for j, (i, t) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, shard string")
    laws_hold(hilbert.layout(df).collect() if count else [], texts, 40) if count else None
    full = hilbert.shard(df, 7)
    assert full.count() == count
    assert set(full.columns) == {*df.columns, "size", "text_crc32", "hilbert", "slot"}
    if count:
        laws_hold(full.collect(), texts, 7)


def test_clashing_names(spark):
    rows = [(i, "w " * i, "en", "s", i, f"p{i}", "q", "r") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, rank int, `__place` string, `__part` string, c0 string")
    full = hilbert.shard(df, 3)
    assert full.columns == [*df.columns, "size", "text_crc32", "hilbert", "shard", "slot"]
    assert sorted(tuple(r)[:8] for r in full.collect()) == rows
    assert hilbert.shard(df.limit(0)).collect() == [] and hilbert.layout(df.limit(0)).collect() == []


def test_very_long_texts(spark):
    df = spark.createDataFrame([(i, "x" * 300_000 if i % 2 else "y", "en", "s") for i in range(9)], "doc_id bigint, text string, lang string, source string")
    laws_hold(hilbert.layout(df).collect(), [(i, "x" * 300_000 if i % 2 else "y") for i in range(9)], 40)


def test_equal_rows_are_dealt_over_ranges(spark):
    """A third of all rows are one row: no range has them all."""
    from tidelog.llm import ranks

    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        rows = spark.range(0, 30_000, 1, 4).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS id")
        tied = rows.withColumn("__tie", F.monotonically_increasing_id())
        parts = tied.repartitionByRange(12, "id", "__tie").groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.when(F.col("id") == 7, 1)).alias("n"))
        assert max(r.n for r in parts.collect()) < 5_000
        placed, total = ranks.ranked(rows, F.col("id"))
        found = placed.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert total == 30_000 and sorted(r["rank"] for r in found) == list(range(30_000))
    assert [r.id for r in sorted(found, key=lambda r: r["rank"])] == sorted(r.id for r in found)
    assert placed.columns == ["id", "rank"]
