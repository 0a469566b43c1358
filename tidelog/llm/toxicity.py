"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Some features are densities of a fixed list of insults, others of a lexicon that is
learned from half of the labelled documents. The trees and the calibration see only the
other half, on which the lexicon is as good as on any new text.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.features import TOXIC, labelled, with_features
from tidelog.llm.graph import stored
from tidelog.llm.lexicon import Lexicon, learned
from tidelog.llm.texts import key_crc

SAMPLE = 40_000  # labelled rows to learn from, at most; as many ids for the lexicon
TREES = 20
DEPTH = 3
UNTIED = 0.001  # the share in a score of what orders the ties of isotonic steps: the trees, then the lexicon


def held_out(folds: int, fold: int) -> Column:
    return F.coalesce(key_crc(F.col("doc_id")) % folds == fold, F.lit(False))


def _part(of: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(8)) < of


def lexicon_of(docs: DataFrame, labels: DataFrame, held: Column, sample: int = SAMPLE) -> Lexicon:
    """From half of the documents that have a label and aren't ``held``, ``sample`` ids at most on average.

    An id labelled more than once has its greatest label.
    """
    known = labels.select("doc_id", F.col("toxic").cast("double").alias("label")).filter("label in (0, 1)")
    known = known.filter(~held & _part(4)).groupBy("doc_id").agg(F.max("label").alias("label"))
    share = min(1.0, sample / max(known.count(), 1))
    chance = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = known.filter(chance < share)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return learned(stored(texts.join(F.broadcast(chosen), "doc_id").select("text", "label"), "learned"))  # sample ids


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted``.

    Learns from labelled documents outside one fold: the lexicon from half of them, the
    trees from three in four of the others, the calibration from the rest. A null id is in no fold and has no label; a
    null label teaches nothing; a document labelled twice counts twice. A null or empty
    text has features of zero and is scored by them. With labels of one kind only, or
    none, every score is the share of label 1 (0 without any). Equal texts score alike.
    """
    words = lexicon_of(docs, labels, held_out(folds, fold), sample)
    rows = stored(with_features(docs, TOXIC, words), "features")
    known = labelled(rows, labels, "toxic", ~held_out(folds, fold) & ~_part(4), sample)
    known = known.withColumn("calibrates", _part(5))
    vectors = VectorAssembler(inputCols=list(TOXIC), outputCol="features")
    known = stored(vectors.transform(known).select("features", "label", "calibrates").coalesce(4), "labelled")
    kinds = known.groupBy("label").agg(
        F.count(F.when(~F.col("calibrates"), 1)).alias("fit"), F.count("*").alias("all")
    ).collect()
    found = rows.withColumn("held_out", held_out(folds, fold))
    if sum(k.fit > 0 for k in kinds) < 2:
        share = sum(k.all for k in kinds if k.label == 1) / max(sum(k.all for k in kinds), 1)
        found = found.withColumn("score", F.lit(float(share)))
    else:
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, minInstancesPerNode=5, seed=7)
        model = trees.fit(known.filter("not calibrates"))
        margin = vector_to_array("probability")[1]
        rest = model.transform(known.filter("calibrates")).select(margin.alias("margin"), "label")
        found = model.transform(vectors.transform(found)).withColumn("margin", margin)
        if rest.take(1):
            steps = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(rest)
            found = steps.transform(found.drop("prediction"))
            within = 0.9 * F.col("margin") + 0.1 * F.col("learned_rate") / (1 + F.col("learned_rate"))
            found = found.withColumn("score", F.col("score") * (1 - UNTIED) + within * UNTIED)
        else:
            found = found.withColumn("score", F.col("margin"))
    score = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0))
    return found.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
