"""Near-duplicates below the threshold of op5_near_dedup, against all pairs."""

import corpus_pipeline
import numpy as np
import pytest
from test_near_dedup import shingles
from tidelog.llm import near_dedup


def least_ids(docs, percent):
    """The least id of each group of (doc_id, text) at this threshold."""
    sets, root = [shingles(t) for _, t in docs], list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(least.values())


def test_stage_links_from_80_per_cent(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    kept = sorted(r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, "").select("doc_id").collect())
    assert kept == least_ids(texts, 80) != least_ids(texts, 85)


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_around_the_threshold(spark, percent):
    """100 common shingles of a union of 115 to 127: similarities of 0.787 to 0.870."""
    docs = []
    for k in range(13):
        base = [f"w{k}_{i}" for i in range(104)]
        docs.append((2 * k, " ".join(base)))
        docs.append((2 * k + 1, " ".join(base + [f"v{k}_{i}" for i in range(15 + k)])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    kept = sorted(r.doc_id for r in near_dedup.deduplicate(df, percent).collect())
    assert kept == least_ids(docs, percent)


def test_bands():
    assert [near_dedup.band_width(p) for p in (85, 80)] == [5, 4]
    marks = np.zeros((2, 2 * near_dedup.PERMUTATIONS), np.uint64)
    assert near_dedup.band_keys(marks, 4).shape == (2, 31)
    with pytest.raises(ValueError):
        near_dedup.band_width(5)
