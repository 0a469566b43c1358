"""Decontamination against a plain search of every window."""

import hashlib
import re

import numpy as np

from tidelog.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(lower)


def brute(docs, items):
    windows = {}
    for item, text in items:
        own = words(text)
        for i in range(max(len(own) - 12, min(1, len(own)))):
            windows.setdefault(tuple(own[i : i + 13]), set()).add(item)
    lengths = {len(w) for w in windows}
    rows = set()
    for doc_id, text in docs:
        own, hit, found = words(text), set(), set()
        for i in range(len(own)):
            for n in lengths:
                if tuple(own[i : i + n]) in windows and i + n <= len(own):
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(own[i : i + n])]
        digest = hashlib.sha256(",".join(sorted(str(x) for x in found if x is not None)).encode())
        rows.add(
            (doc_id, len(own), len(hit), len(found), digest.hexdigest(), bool(hit) and 20 * len(hit) >= len(own))
        )
    return rows


def check(spark, docs, items):
    result = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    ).drop("spans")
    assert {tuple(r) for r in result.collect()} == brute(docs, items)
    assert result.count() == len(docs)


def test_whole_table(spark):
    docs = [tuple(r) for r in queries.read(spark, SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in queries.read(spark, SF, "benchmark").select("item_id", "text").collect()]
    rows = {tuple(r) for r in queries.op1_decontamination(spark, SF).collect()}
    assert rows == brute(docs, items)
    assert any(r[5] for r in rows)


def test_odd_texts_and_items(spark):
    items = [(1, "One two"), (2, " ".join(f"w{i}" for i in range(20))), (2, "one TWO"), (3, None), (4, "?!"),
             (None, "lonely item"), (12, "été ÉTÉ x1"), (5, "a a a"), (6, "zz")]
    docs = [(1, None), (2, ""), (3, "one-two ONE two x"), (4, " ".join(f"W{i}" for i in range(2, 16))),
            (4, " ".join(f"W{i}" for i in range(2, 16))), (None, "a lonely item"), (5, "été ÉTÉ X1 a a a a a a"),
            (6, "one " * 50 + "two"), (7, "zz " * 3000), (8, "... !!"), (9, "one\ntwo")]
    check(spark, docs, items)


def test_random_texts(spark):
    rng = np.random.default_rng(5)
    make = lambda n: " ".join("abc"[i] for i in rng.integers(0, 3, n))
    items = [(i, make(int(rng.integers(1, 18)))) for i in range(30)]
    docs = [(i, make(int(rng.integers(0, 300)))) for i in range(60)]
    check(spark, docs, items)


def test_empty_tables(spark):
    docs = [(1, "some words here"), (2, None)]
    check(spark, docs, [])
    check(spark, [], [(1, "some words")])


def test_many_blocks_give_the_same(spark, monkeypatch, tmp_path):
    items = [(i, f"alpha beta{i % 3} gamma") for i in range(9)]
    docs = [(i, f"x alpha beta{i % 4} gamma alpha beta1 gamma y " + "pad " * 30 * i) for i in range(6)]
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 12)
    check(spark, docs, items)


def test_decontaminate_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame(
        [(1, "one two three", "a", 5), (2, "nothing here", None, 6), (3, None, "b", 7)],
        "doc_id bigint, text string, n_words string, spans int",
    )
    items = spark.createDataFrame([(1, "two three")], "item_id bigint, text string")
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_clashing_names(spark):
    rows = [(1, "one two three", "a", "b", "c", "d"), (2, "nothing here", "e", "f", "g", "h"), (None, None, "i", "j", "k", "l"), (2, "nothing here", "e", "f", "g", "h")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `__words` string, `__spans` string, `__items` string, c0 string")
    kept = decontaminate.decontaminate(docs, spark.createDataFrame([(1, "two three")], "item_id bigint, text string"))
    assert kept.dtypes == docs.dtypes and sorted(map(tuple, kept.collect()), key=str) == sorted(rows[1:], key=str)
    assert decontaminate.decontaminate(docs.limit(0), docs.selectExpr("doc_id AS item_id", "text")).collect() == []
