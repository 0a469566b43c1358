"""Quality: a sparse ensemble of rules taken from trees.

Every path of a small forest is a rule, a conjunction of comparisons of statistics.
A lasso logistic regression gives most rules no weight. What remains is compiled into
one Spark column expression.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.features import QUALITY, labelled, with_features
from tidelog.llm.graph import stored
from tidelog.llm.texts import key_crc

SAMPLE = 20_000  # labelled rows to learn from, at most
TREES = 12
DEPTH = 3
LASSO = 0.002
THRESHOLD = 0.7

Rule = tuple[tuple[str, str, float], ...]


def paths(tree: str, names: tuple[str, ...] = QUALITY) -> set[Rule]:
    """The conjunctions along the paths of a tree, from its printed form: to inner nodes and leaves alike."""
    found: set[Rule] = set()
    held: list[tuple[int, tuple[str, str, float]]] = []
    for line in tree.splitlines():
        if test := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+.0-9eE]+)\)", line):
            depth = len(test[1])
            held = [x for x in held if x[0] < depth]
            held.append((depth, (names[int(test[2])], test[3], float(test[4]))))
            found.add(simplified(tuple(x[1] for x in held)))
    return found


def simplified(rule: Rule) -> Rule:
    """The tightest comparison of each feature and side, in order of names."""
    tight: dict[tuple[str, str], float] = {}
    for name, sign, value in rule:
        old = tight.get((name, sign), value)
        tight[name, sign] = min(old, value) if sign == "<=" else max(old, value)
    return tuple((name, sign, value) for (name, sign), value in sorted(tight.items()))


def holds(rule: Rule) -> Column:
    test = F.lit(True)
    for name, sign, value in rule:
        test &= F.col(name) <= value if sign == "<=" else F.col(name) > value
    return test


def compiled(rules: dict[Rule, float], intercept: float) -> Column:
    """The probability of label 1 by the weights of the rules that hold."""
    total = F.lit(float(intercept))
    for rule, weight in sorted(rules.items()):
        total += F.when(holds(rule), float(weight)).otherwise(0.0)
    return 1 / (1 + F.exp(-total))


def fit(known: DataFrame) -> tuple[dict[Rule, float], float]:
    """Weights of the rules that the lasso keeps, and the intercept, from features and a ``label``."""
    vectors = VectorAssembler(inputCols=list(QUALITY), outputCol="features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=10, seed=11)
    trees = forest.fit(vectors.transform(known).select("features", "label")).trees
    rules = sorted(set().union(*[paths(tree.toDebugString) for tree in trees]))
    if not rules:
        rules = [(("log_words", ">", 0.0),)]
    held = known.select("label", *[holds(rule).cast("double").alias(f"r{i}") for i, rule in enumerate(rules)])
    held = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held)
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False)
    model = lasso.fit(held.select("features", "label"))
    weights = model.coefficients.toArray()
    return {rule: float(w) for rule, w in zip(rules, weights, strict=True) if w}, float(model.intercept)


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, sample: int = SAMPLE) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``score`` and ``predicted`` (score at least 0.7).

    Learns from labelled documents outside one fold. A null id is in no fold and has no
    label; a null label teaches nothing; a document labelled twice counts twice. A null
    or empty text has statistics of zero and is scored by them. With labels of one kind
    only, or none, every score is the share of label 1 (0 without any).
    """
    out = F.coalesce(key_crc(F.col("doc_id")) % folds == fold, F.lit(False))
    rows = stored(with_features(docs, QUALITY), "features")
    known = stored(labelled(rows, labels, "quality", ~out, sample).coalesce(4), "labelled")
    kinds = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if len(kinds) < 2:
        found = F.lit(kinds.get(1.0, 0) / max(sum(kinds.values()), 1))
    else:
        found = compiled(*fit(known))
    return rows.select("doc_id", out.alias("held_out"), found.alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
