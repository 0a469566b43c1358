"""Mixing sources to target weights by fitting each source's word budget exactly.

A source's budget is met with whole passes over it and one more pass over part of
it. The part is chosen by counts of documents of each exact length: a proportional
share of every length, then a bounded knapsack over what remains of the budget. The
documents of a length are taken in the order of a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.graph import stored
from tidelog.llm.ranks import ranked
from tidelog.llm.texts import word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
SEED = 17
KNAPSACK = 1 << 17  # words that the knapsack looks at, or two of the longest documents
PARTS = 256


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``sizes`` (source, source_size) with a ``target`` for each.

    Weights repeat along the sources by code point, null last. A target stops at
    ``MOST_REPEATS`` times its source's size; the excess goes to the others by weight.
    """
    placed, _ = ranked(sizes, F.col("source").asc_nulls_last())
    turn = F.col("rank") % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    placed = placed.withColumns({"weight": weight, "most": F.lit(float(MOST_REPEATS)) * F.col("source_size")})
    whole = share * (placed.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("most")
        free, full, count = placed.agg(
            F.sum(F.when(~over, F.col("weight"))), F.sum(F.when(over, F.col("most"))), F.count(F.when(over, 1))
        ).first()
        if count == capped:
            break
        level, capped = (whole - (full or 0.0)) / free if free else float("inf"), count
    return placed.select("source", "source_size", F.least(F.col("weight") * level, F.col("most")).alias("target"))


def _reach(lengths: np.ndarray) -> int:
    """How far the knapsack looks: two of the longest documents at least."""
    return max(KNAPSACK, 2 * int(lengths.max(initial=0)))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """How many documents of each length to take so that their words come to the budget.

    A proportional share of every length, one more of some while much is left, then the
    sum nearest to the rest from below. Memory is a bit for each word of two documents.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    whole = int(lengths @ counts)
    if budget >= whole:
        return counts.copy()
    taken = np.array([int(c) * budget // whole for c in counts], np.int64)
    left = budget - int(lengths @ taken)
    order, reach = np.random.default_rng(seed).permutation(len(lengths)), _reach(lengths)
    # One more of each length while much is left, so that no length is preferred. One of
    # each would come to more than the rest, so this ends within reach.
    for i in order:
        if left <= reach:
            break
        if taken[i] < counts[i]:
            taken[i] += 1
            left -= int(lengths[i])
    return taken + _nearest_sum(lengths, counts - taken, left, left, order)


def _nearest_sum(lengths: np.ndarray, free: np.ndarray, goal: int, most: int, order: np.ndarray) -> np.ndarray:
    """Of all sums up to ``most`` the one nearest to ``goal``, the lower of two: how many of each length it takes.

    The reachable sums are the bits of one number. Documents of a length come in batches
    of 1, 2, 4 and so on; a batch shifts the bits by its words. Lengths are added until
    no sum can be nearer.
    """
    picked = np.zeros(len(lengths), np.int64)
    if goal <= 0 or not free.any():
        return picked
    step = int(np.gcd.reduce(lengths[free > 0]))
    limit, low = most // step, goal // step
    least = min(goal - low * step, (low + 1) * step - goal if low < limit else goal)
    mask, sums, best = (1 << limit + 1) - 1, 1, 0
    batches: list[tuple[int, int, int]] = []
    for i in order:
        left, batch = int(free[i]), 1
        while left > 0:
            batch = min(batch, left)
            weight = batch * int(lengths[i]) // step
            if weight > limit:
                break
            more = (sums | sums << weight) & mask
            if more != sums:
                batches.append((int(i), batch, weight))
                sums = more
            left -= batch
            batch *= 2
        above = sums >> low + 1
        below = (sums & (1 << low + 1) - 1).bit_length() - 1
        near = [below, *([low + (above & -above).bit_length()] if above else [])]
        best = min(near, key=lambda n: (abs(n * step - goal), n))
        if abs(best * step - goal) <= least:
            break
    for at in _used([w for *_, w in batches], best):
        picked[batches[at][0]] += batches[at][1]
    return picked


def _used(weights: Sequence[int], total: int) -> list[int]:
    """Which weights, in order, make up ``total``, which some of them do.

    Halves the list: the bits after the first half say what that half can have added, so
    only as many numbers as the list can be halved are held at once.
    """
    found: list[int] = []

    def split(low: int, high: int, sums: int, total: int) -> int:
        """What is left of ``total`` for the weights before ``low``, whose sums are given."""
        if high - low <= 1:
            if high == low or sums >> total & 1:
                return total
            found.append(low)
            return total - weights[low]
        middle, mask, then = (low + high) // 2, (1 << total + 1) - 1, sums
        for weight in weights[low:middle]:
            then = (then | then << weight) & mask
        return split(low, middle, sums, split(middle, high, then, total))

    split(0, len(weights), 1, total)
    return found


def fit_nearest(lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int = SEED) -> np.ndarray:
    """As ``fit_budget``, but the nearest sum, above the budget too.

    If all documents are within reach of the knapsack, no sum of theirs is nearer. Else
    the best sum from below, from above (that which leaves out what ``fit_budget`` fits
    into the rest) and sums that hold a proportional share, or one document of each length
    less, are weighed; the nearest wins, the first of equals. The gap is half the longest
    document at most, and in a source of many lengths none.
    """
    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    best, whole, step = fit_budget(lengths, counts, budget, seed), int(lengths @ counts), int(np.gcd.reduce(lengths))
    least = min(budget % step, step - budget % step)

    def gap(taken: np.ndarray) -> int:
        return abs(int(lengths @ taken) - budget)

    if budget >= whole or budget <= 0 or gap(best) <= least:
        return best
    above = counts - fit_budget(lengths, counts, whole - budget, seed)
    best = above if gap(above) < gap(best) else best
    order = np.random.default_rng(seed).permutation(len(lengths))
    share = np.array([int(c) * budget // whole for c in counts], np.int64)
    starts = [np.zeros_like(share)] if whole <= _reach(lengths) else [share, np.maximum(share - 1, 0)]
    for start in starts:
        if gap(best) > least:
            goal = budget - int(lengths @ start)
            other = start + _nearest_sum(lengths, counts - start, goal, goal + gap(best), order)
            best = other if gap(other) < gap(best) else best
    return best


def _plan(lengths: DataFrame, aims: DataFrame, seed: int) -> DataFrame:
    """Per source and length: whole passes over it, and documents of one pass more."""

    def plan(rows: pd.DataFrame) -> pd.DataFrame:
        size, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        budget = int(round(target))
        passes = min(budget // size, MOST_REPEATS) if size else 0
        some = rows["size"].to_numpy() > 0
        more = np.zeros(len(rows), np.int64)
        if passes < MOST_REPEATS and some.any():
            order = np.argsort(rows["size"].to_numpy()[some], kind="stable")
            of = np.flatnonzero(some)[order]
            more[of] = fit_nearest(
                rows["size"].to_numpy()[of], rows["documents"].to_numpy()[of], budget - passes * size, seed
            )
        return rows.assign(passes=passes, more=more)

    joined = lengths.join(aims.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of")))
    return joined.drop("__of").groupBy("source").applyInPandas(
        plan,
        "source string, size bigint, documents bigint, source_size bigint, target double, passes bigint, more bigint",
    )


def with_copies(rows: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, and what else) with ``source_size``, ``target`` and ``copies`` in the mix.

    A null source is a source of its own; no document of size 0 is taken. Ties of a
    length go by hash of ``doc_id``, then by ``doc_id``; repeated rows count each.
    A hot length is dealt over ``PARTS`` hashed parts.
    """
    rows = rows.withColumn("mark", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string")))
    rows = rows.withColumn("part", F.pmod(F.col("mark"), F.lit(PARTS)))
    parts = stored(rows.groupBy("source", "size", "part").agg(F.count("*").alias("in_part")), "parts")
    lengths = parts.groupBy("source", "size").agg(F.sum("in_part").alias("documents"))
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("documents")).alias("source_size"))
    plan = _plan(lengths, targets(sizes), seed).select(
        F.col("source").alias("p_source"), F.col("size").alias("p_size"), "source_size", "target", "passes", "more"
    )
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("in_part").over(before), F.lit(0)))
    quotas = parts.join(plan, F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size"))).select(
        "p_source", "p_size", F.col("part").alias("p_part"), (F.col("more") - F.col("before")).alias("quota"),
        "passes", "source_size", "target",
    )
    joined = rows.join(
        quotas,
        F.col("source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")) & (F.col("part") == F.col("p_part")),
    )
    turn = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("mark", F.col("doc_id")))
    copies = F.col("passes") + (F.col("turn") <= F.col("quota")).cast("long")
    copies = F.when(F.col("size") > 0, copies).otherwise(0)
    return joined.withColumn("turn", turn).withColumn("copies", copies).drop(
        "p_source", "p_size", "p_part", "mark", "part", "quota", "passes", "turn"
    )


def _sized(docs: DataFrame, *more: Column) -> DataFrame:
    """A document's size is its number of words; a null or empty text has none."""
    size = word_count(F.col("text").cast("string")).alias("size")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), size, *more)


def shares(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document the words that the mix takes, without its text, which is read once.

    See ``with_copies``; a null or empty text has size 0. An empty table gives no rows.
    """
    mixed = with_copies(stored(_sized(docs), "sizes"), seed)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixed table: each document as often as it is taken, with the columns of ``docs``, whatever their names.

    See ``with_copies``; a document without words is not taken, so its rows go. An empty
    table gives no rows.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    repeated = with_copies(_sized(docs, whole), seed).filter("copies > 0")
    return repeated.select(F.explode(F.array_repeat("row", F.col("copies").cast("int"))).alias("row")).select("row.*")
