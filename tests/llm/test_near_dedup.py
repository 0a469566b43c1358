"""Groups of near-duplicates against all pairs."""

import re

import numpy as np
from pyspark.sql import functions as F

from tidelog.llm import near_dedup, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    own = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def brute(docs):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)):
                shared = len(a & b)
                if 100 * shared >= 85 * (len(a) + len(b) - shared):
                    root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(
        (doc_id, len(s), own, doc_id == own)
        for i, ((doc_id, _), s) in enumerate(zip(docs, sets))
        for own in [least.get(find(i)) if s else doc_id]
    )


def check(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in near_dedup.near_duplicates(df).collect()) == brute(docs)


def test_whole_table(spark):
    docs = [tuple(r) for r in queries.read(spark, SF, "documents").select("doc_id", "text").collect()]
    rows = sorted(tuple(r) for r in queries.op5_near_dedup(spark, SF).collect())
    assert rows == brute(docs)
    assert any(not r[3] for r in rows)


def test_hub_that_is_not_the_least_and_chains(spark):
    """Copies that are linked to their original only, and a chain of small steps."""
    rng = np.random.default_rng(11)
    base = [f"b{i}" for i in range(200)]
    docs = []
    for k in range(120):
        changed = list(base)
        for at in rng.choice(40, 4, replace=False) * 5:
            changed[at] = f"x{k}_{at}"
        docs.append((k, " ".join(changed)))
    docs.append((900, " ".join(base)))
    chain = [f"c{i}" for i in range(400)]
    for k in range(40):
        docs.append((300 + k, " ".join(chain[3 * k : 3 * k + 150])))
    for k in range(40):
        docs.append((500 + k, "shared passage of many words " * 12 + " ".join(f"own{k}_{i}" for i in range(60))))
    order = rng.permutation(len(docs))
    check(spark, [docs[i] for i in order])


def test_blocks_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = np.random.default_rng(2)
    base = [f"b{i}" for i in range(100)]
    docs = []
    for k in range(60):
        changed = list(base)
        for at in rng.choice(20, int(rng.integers(1, 4)), replace=False) * 5:
            changed[at] = f"y{int(rng.integers(0, 6))}"
        docs.append((k, " ".join(changed)))
    check(spark, docs)


def test_odd_texts(spark):
    docs = [(5, "A b c"), (3, "a B  c\n"), (9, None), (8, ""), (7, " \t"), (4, "a b c d e f"), (4, "a b c d e f"),
            (10, "a b c d e f g h i j k l"), (2, "word " * 9000), (1, "word word word word word"), (6, "é ü")]
    check(spark, docs)
    df = spark.createDataFrame(docs + [(None, "lone text"), (None, "lone text"), (None, "A b C")],
                               "doc_id bigint, text string").selectExpr("*", "'k' as n_shingles", "1 as key")
    kept = near_dedup.deduplicate(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id is None, r.doc_id or 0) for r in kept.collect())) == sorted(
        [(False, i) for i in (3, 9, 8, 7, 4, 10, 1, 6)] + [(True, 0)]
    )
    assert near_dedup.near_duplicates(df.limit(0)).collect() == []


def test_many_unlinked_members_around_a_hub(spark, monkeypatch):
    """2,000 classes share one passage and aren't linked: nothing goes, and the tasks that meet them are even."""
    rng = np.random.default_rng(6)
    passage = " ".join(f"p{i}" for i in range(100))
    docs = [(k, passage + " " + " ".join(f"o{k}_{i}" for i in range(int(rng.integers(15, 25))))) for k in range(2000)]
    monkeypatch.setattr(near_dedup, "BLOCK", 64)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(df).collect()}
    sets = {}
    for doc_id, text in docs:
        sets[doc_id] = len(shingles(text))
    common = 96  # shingles of the passage
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * common >= 85 * (sets[a] + sets[b] - common)}
    assert not linked and all(got[i] == i for i in got) and len(got) == 2000


def test_salts_deal_a_hub(spark):
    """The rows of one hub go to many keys of the join."""
    classes = spark.range(3000).select(F.xxhash64("id").cast("string").cast("binary").alias("class"))
    salt = F.pmod(F.xxhash64(F.lit(1), "class"), F.lit(near_dedup.SALTS))
    counts = [r["count"] for r in classes.groupBy(salt).count().collect()]
    assert len(counts) == near_dedup.SALTS and max(counts) < 3 * 3000 / near_dedup.SALTS


def test_clashing_names(spark):
    rows = [(i, f"some text of words number {i // 2}", "a", i, "b", "c") for i in range(10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, `__row` string, `__class` int, `__n` string, `__bands` string")
    kept = near_dedup.deduplicate(df)
    assert kept.dtypes == df.dtypes and sorted(map(tuple, kept.collect())) == rows[::2]
