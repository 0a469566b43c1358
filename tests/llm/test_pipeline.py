"""The stages one by one against plain versions of what each decides."""

import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F
from test_decontaminate import brute as contaminated
from test_near_dedup_threshold import least_ids

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    extra = docs.limit(1).selectExpr("100000L as doc_id", "'12 34 !?' as text", "lang", "source", "n_chars")
    extra = extra.unionByName(docs.limit(3))  # one to reject, three repeated rows
    given = docs.unionByName(extra).withColumn("lang", F.when(F.col("doc_id") % 11 != 3, F.col("lang")))
    true_lang = {r.doc_id: r.lang for r in docs.collect()}
    before = [(r.doc_id, r.text, r.source) for r in given.collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    path = str(tmp_path / "0")
    given.write.parquet(path)
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, spark.read.parquet(path), SF)
        assert found.columns[: len(columns)] == columns or name == "sharding"
        path = str(tmp_path / str(number + 1))
        found.write.parquet(path)
        after = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(path).collect()]
        if name == "language_id":
            want = Counter(d for d in before if re.search(r"[^\W\d_]", d[1]))
            filled = {r.doc_id: r.lang for r in spark.read.parquet(path).collect()}
            assert all(filled[i] == true_lang[i] for i in filled if i % 11 != 3)
            guessed = [filled[i] == true_lang[i] for i in filled if i % 11 == 3]
            assert None not in filled.values() and sum(guessed) > 0.9 * len(guessed) > 9
        elif name == "near_dedup":
            least = least_ids(sorted({d[:2] for d in before}), corpus_pipeline.SIMILAR)
            want = Counter(set(d for d in before if d[0] in least))
        elif name == "decontamination":
            bad = {r[0] for r in contaminated([d[:2] for d in before], items) if r[5]}
            assert bad
            want = Counter(d for d in before if d[0] not in bad)
        elif name == "source_mixture":
            counts = Counter(after)
            assert set(counts) <= set(before) and max(counts.values()) <= 2
            words = sum(len(d[1].split()) for d in before)
            assert abs(sum(len(d[1].split()) for d in after) - 1.5 * words) < 0.01 * words
            want = counts
        else:
            shards = Counter(r.shard for r in spark.read.parquet(path).collect())
            assert max(shards.values()) - min(shards.values()) <= 1 and len(shards) == 40
            want = Counter(before)
        assert Counter(after) == want, name
        before = after


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "shard", "slot"} <= set(found.columns)
    assert found.count() > 100
    assert found.select("shard", "slot").distinct().count() == found.count()
