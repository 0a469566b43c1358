"""Sources of few long documents: the sum nearest to the budget, above it too."""

import itertools

import numpy as np
import pytest
from tidelog.llm import mixture


@pytest.mark.parametrize(("lengths", "counts", "budget", "words"), [
    ([400_000], [2], 700_000, 800_000),
    ([100_000], [1], 90_000, 100_000),
    ([100_000], [1], 40_000, 0),
    ([300_000, 350_000, 400_000], [1, 1, 1], 650_000, 650_000),
    ([50_000, 70_000], [3, 1], 140_000, 150_000),
    ([140_000, 900_000], [1, 1], 150_000, 140_000),
])
def test_long_documents(lengths, counts, budget, words):
    taken = mixture.fit_nearest(np.array(lengths), np.array(counts), budget)
    assert np.array(lengths) @ taken == words


def test_longest_that_fits_below():
    assert mixture.fit_budget(np.array([140_000, 900_000]), np.array([1, 1]), 150_000).tolist() == [1, 0]


@pytest.mark.parametrize("scale", [1, 9_973])
def test_nearest_of_all_subsets(scale):
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 60, 5)) * scale + (scale > 1) * rng.integers(0, 9)
        counts = rng.integers(1, 3, len(lengths))
        budget = int(rng.integers(0, lengths @ counts + 5))
        taken = mixture.fit_nearest(lengths, counts, budget)
        assert (taken <= counts).all() and (taken >= 0).all()
        nearest = min(
            abs(int(lengths @ np.array(n)) - budget) for n in itertools.product(*[range(int(c) + 1) for c in counts])
        )
        assert abs(int(lengths @ taken) - budget) == nearest


@pytest.mark.parametrize("count", [1, 2, 3, 17, 200])
def test_which_weights_are_used(count):
    rng = np.random.default_rng(count)
    weights = [int(w) for w in rng.integers(1, 1000, count)]
    total = sum(w for w in weights if rng.random() < 0.5)
    used = mixture._used(weights, total)
    assert len(set(used)) == len(used) and sum(weights[i] for i in used) == total


def test_long_documents_of_many_words():
    """Sums beyond a million words, no coarser than one word."""
    lengths = np.array([1_000_003, 1_500_007, 2_000_029, 3_000_017])
    counts = np.array([2, 1, 2, 1])
    for budget in (4_500_040, 6_000_061, 9_500_072):
        taken = mixture.fit_nearest(lengths, counts, budget)
        nearest = min(abs(int(lengths @ np.array(n)) - budget) for n in itertools.product(*[range(int(c) + 1) for c in counts]))
        assert abs(int(lengths @ taken) - budget) == nearest


def test_one_long_document_stays_in_the_mix(spark):
    docs = [(0, "w " * 1000, "a"), (1, "w " * 2000, "b"), (2, "w " * 1000, "b")]
    rows = mixture.shares(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()
    taken = {r.doc_id: r.taken for r in rows}
    # 6000 words, targets 2000 for a (its most) and 4000 for b: one pass and the document of 1000 again.
    assert taken == {0: 2000, 1: 2000, 2: 2000}
    docs = [(0, "w " * 1000, "a"), (1, "w " * 1000, "b"), (2, "w " * 400, "c")]
    rows = mixture.shares(spark.createDataFrame(docs, "doc_id bigint, text string, source string")).collect()
    for r in rows:
        copies = r.taken // r["size"]
        assert all(abs(r.taken - r.target) <= abs(n * r["size"] - r.target) for n in range(3) if n != copies)


def test_clashing_names(spark):
    rows = [(i, "w " * (i % 5), f"s{i % 2}", "a", i, "b", "c") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, row string, mark int, copies string, `part` string")
    mixed = mixture.mix(df)
    assert mixed.dtypes == df.dtypes and {tuple(r) for r in mixed.collect()} <= set(rows)
