"""Held-out accuracy and odd inputs of the language, toxicity and quality operators."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import features, languages, quality, queries, toxicity

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n", "1234 5678 !!!", "x", "é", "You idiot!! " * 300, "ΑΒΓ δ", "w " * 20000]


def fold(doc_id, folds, number):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == number


def area(pairs):
    """Of pairs (score, label): the chance that a 1 scores above a 0, ties half."""
    ranks = {}
    scores = sorted(s for s, _ in pairs)
    for s in set(scores):
        ranks[s] = (scores.index(s) + len(scores) - scores[::-1].index(s) + 1) / 2
    ones = sum(label for _, label in pairs)
    return (sum(ranks[s] for s, label in pairs if label) - ones * (ones + 1) / 2) / (ones * (len(pairs) - ones))


def shuffled_columns(spark, name):
    """The documents with ``lang`` and ``source`` that say nothing and ids that don't either."""
    docs = queries.read(spark, SF, "documents")
    return docs.withColumns({"lang": F.lit("xx"), "source": F.lit(name)})


def test_language(spark):
    docs = {r.doc_id: r for r in queries.read(spark, SF, "documents").collect()}
    rows = queries.op8_language(spark, SF).collect()
    assert len(rows) == len(docs) and all(r.held_out == fold(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.97


def test_language_of_odd_texts(spark):
    rows = [(i, f"the of and ing tion {i}", "en") for i in range(1, 40)] + [(100 + i, f"der und keit ung ß {i}", "de") for i in range(40)]
    rows += [(200 + i, f"qu’el las ción ñ {i}", "es") for i in range(40)] + [(300 + i, f"zzyzx qq {i}", "tlh") for i in range(40)]
    rows += [(1000 + i, t, None) for i, t in enumerate(ODD)] + [(None, "the ing", "en"), (2000, "der keit und", None), (2000, "der keit und", None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 as score", "'k' as lang_pred")
    found = {(r.doc_id): r for r in languages.identify(df).collect()}
    assert {found[1000 + i].lang_pred for i in range(4)} == {"und"} and found[1001].score == 0
    assert found[2000].lang_pred == "de" and all(r.lang_pred in ("en", "de", "es", "tlh", "und") for r in found.values())
    assert languages.keep_known(df).columns == df.columns
    assert languages.keep_known(df).count() == len(rows) - 4
    assert languages.identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in languages.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_families():
    assert languages.family("pt-BR") == languages.family("it") == "romance" and languages.family("xx") == "only xx"


def test_machine_separates():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(400, 6)).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    sides = np.where(rows[:, 0] - 0.5 * rows[:, 1] > 0.1, 1.0, -1.0).astype(np.float32)
    weights = languages.fit_machine(rows, sides)
    assert np.mean(np.sign(rows @ weights[:-1] + weights[-1]) == sides) > 0.97


@pytest.mark.parametrize(
    ("operator", "label", "folds", "number", "level", "least"),
    [(toxicity, "toxic", 5, 0, 0.5, 0.7), (quality, "quality", 4, 2, 0.7, 0.8)],
)
def test_held_out(spark, operator, label, folds, number, level, least):
    docs, labels = queries.read(spark, SF, "documents"), queries.read(spark, SF, "labels")
    rows = operator.score(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == fold(r.doc_id, folds, number) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= level) for r in rows)
    known = {r.doc_id: r[label] for r in labels.collect()}
    held = [(r.score, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert area(held) > least
    # Neither language nor source matters, and labels of the held-out fold don't either.
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == number
    flipped = labels.withColumn(label, F.when(out, 1 - F.col(label)).otherwise(F.col(label)))
    again = operator.score(shuffled_columns(spark, "s"), flipped).collect()
    assert {(r.doc_id, round(r.score, 9)) for r in again} == {(r.doc_id, round(r.score, 9)) for r in rows}


@pytest.mark.parametrize(("operator", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_odd_texts_and_labels(spark, operator, label):
    docs = spark.createDataFrame(list(enumerate(ODD)) + [(None, "x"), (1, "")], "doc_id bigint, text string")
    docs = docs.selectExpr("*", "'k' as score", "1 as label")
    empty = spark.createDataFrame([], f"doc_id bigint, {label} int")
    assert {r.score for r in operator.score(docs, empty).collect()} == {0.0}
    some = spark.createDataFrame([(1, 1), (2, 1), (3, None), (None, 0), (77, 0)], f"doc_id bigint, {label} int")
    rows = operator.score(docs, some).collect()
    assert len(rows) == len(ODD) + 2 and {r.score for r in rows} == {1.0}
    assert operator.score(docs.limit(0), some).collect() == []


def test_toxic_features():
    from tidelog.llm.texts import text_buffer
    import pyarrow as pa

    texts = ["You are an idiot, sir", "calm words only", "you 1d10t", "s.t.u.p.i.d man", "IDIOT " + "far " * 9 + "you", "", None]
    table = features.toxic_features(*text_buffer(pa.array(texts)))
    get = lambda name: table[:, features.TOXIC.index(name)].tolist()
    assert get("insults") == [1, 0, 0, 0, 1, 0, 0]
    assert get("plain_insults") == [1, 0, 1, 1, 1, 0, 0]
    assert get("near_you") == [1, 0, 0, 0, 0, 0, 0]
    assert get("shouted_rate")[4] == pytest.approx(1 / 11) and not table[5].any() and not table[6].any()


def test_rules_of_a_tree():
    tree = "\n".join([
        "DecisionTreeClassificationModel: depth=2", "  If (feature 0 <= 2.5)", "   If (feature 1 <= 0.5)", "    Predict: 0.0",
        "   Else (feature 1 > 0.5)", "    Predict: 1.0", "  Else (feature 0 > 2.5)", "   Predict: 1.0",
    ])
    found = quality.paths(tree, ("a", "b"))
    assert found == {
        (("a", "<=", 2.5),), (("a", "<=", 2.5), ("b", "<=", 0.5)), (("a", "<=", 2.5), ("b", ">", 0.5)), (("a", ">", 2.5),),
    }
    assert quality.simplified((("a", "<=", 3.0), ("a", "<=", 1.0), ("a", ">", 0.0))) == (("a", "<=", 1.0), ("a", ">", 0.0))


def test_compiled_rules(spark):
    rules = {(("a", ">", 1.0),): 2.0, (("a", "<=", 3.0), ("b", ">", 0.0)): -1.0}
    rng = random.Random(2)
    rows = [(rng.uniform(0, 4), rng.uniform(-1, 1)) for _ in range(50)]
    for r in spark.createDataFrame(rows, "a double, b double").withColumn("p", quality.compiled(rules, 0.5)).collect():
        total = 0.5 + 2.0 * (r.a > 1) - 1.0 * (r.a <= 3 and r.b > 0)
        assert r.p == pytest.approx(1 / (1 + np.exp(-total)))
