"""A ledger of quality rules: measurements and failure bits, each taken once.

``ledger`` evaluates every rule once per document and keeps one bit for each that
fails. A policy is a set of rules with a version, applied to the bits alone; an
ablation counts the distinct bit patterns and needs no document again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.texts import SPACES, Words, map_pieces, mix, runs

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_capitals",
)
REPEAT_WINDOW = 8

_NOT_NEWLINE = np.zeros(256, bool)
_NOT_NEWLINE[0x0A] = True
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
_CONTINUED = np.arange(256) & 0xC0 == 0x80
_CAPITALS = np.zeros(256, bool)
_CAPITALS[ord("A") : ord("Z") + 1] = True
# A letter: an ASCII one, or any character beyond ASCII.
_LETTERS = np.array([b >= 0xC0 or chr(b).isalpha() and b < 0x80 for b in range(256)])


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def measure(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    """The ids of a piece and its ``MEASURES``."""
    count = len(offsets) - 1
    words = Words(data, offsets)
    row_mark = mix(np.arange(count, dtype=np.uint64) + np.uint64(1))

    lines = Words(data, offsets, _NOT_NEWLINE)
    inked = np.concatenate([[0], np.cumsum(~SPACES[data])])
    full = inked[lines.ends] > inked[lines.starts]
    line_row = lines.rows[full]
    _, first = np.unique(lines.hashes(lower=False)[full] ^ row_mark[line_row], return_index=True)
    n_lines = np.bincount(line_row, minlength=count)

    windows = runs(words.hashes(lower=False), REPEAT_WINDOW)
    word_row = words.rows
    begin = np.flatnonzero(word_row[: len(windows)] == word_row[REPEAT_WINDOW - 1 :])
    windows = windows[begin] ^ row_mark[word_row[begin]]
    ordered = np.sort(windows)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    covered = np.zeros(len(word_row) + 1, np.int64)
    if len(twice):
        near = np.minimum(np.searchsorted(twice, windows), len(twice) - 1)
        begin = begin[twice[near] == windows]
        covered[begin] += 1
        np.subtract.at(covered, begin + REPEAT_WINDOW, 1)
    repeated = np.bincount(word_row[np.cumsum(covered)[:-1] > 0], minlength=count)

    columns = [
        words.counts,
        _per_row(~SPACES[data] & ~_CONTINUED[data], offsets),
        _per_row(_SYMBOLS[data], offsets),
        n_lines - np.bincount(line_row[first], minlength=count),
        repeated,
        n_lines,
        _per_row(_LETTERS[data], offsets),
        _per_row(_CAPITALS[data], offsets),
    ]
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", *MEASURES]
    )


@dataclass(frozen=True)
class Rule:
    """A named rule: the condition under which a document fails it."""

    name: str
    fails: str


# A rule's bit is its place here: append new rules, never reorder.
RULES = (
    Rule("too_short", "n_words < 20"),
    Rule("repeated_runs", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("capitals", "10 * n_capitals > 4 * n_letters"),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    Rule("few_letters", "10 * n_letters < 6 * word_chars"),
)

POLICIES = {
    "base": ("too_short", "repeated_runs"),
    "v1": ("too_short", "repeated_runs", "symbols", "repeated_lines"),
    "v2": tuple(rule.name for rule in RULES),
}
CURRENT = "v2"


def mask(policy: str) -> int:
    names = [rule.name for rule in RULES]
    return sum(1 << names.index(name) for name in POLICIES[policy])


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the measures and ``fail_bits``.

    A null text counts as an empty one: no words, so it fails ``too_short`` only.
    Repeated documents each have their row; other columns are not read.
    """
    measured = map_pieces(
        docs.select("doc_id", F.col("text").cast("string").alias("text")), "text", measure,
        "doc_id bigint, " + ", ".join(f"{name} bigint" for name in MEASURES),
    )
    bits = sum(
        (F.when(F.expr(rule.fails), 1 << bit).otherwise(0).cast("long") for bit, rule in enumerate(RULES)),
        F.lit(0).cast("long"),
    )
    return measured.withColumn("fail_bits", bits)


def passes(policy: str) -> Column:
    """Whether a ledger row passes every rule of the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy))) == 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that fail no other rule.

    Works on the counts of distinct bit patterns, at most two to the number of rules.
    """
    patterns = rows.groupBy("fail_bits").agg(F.count("*").alias("documents"))
    whole, measures = mask(policy), []
    for bit, rule in enumerate(RULES):
        if rule.name in POLICIES[policy]:
            fails = F.col("fail_bits").bitwiseAND(F.lit(1 << bit)) != 0
            alone = F.col("fail_bits").bitwiseAND(F.lit(whole)) == (1 << bit)
            measures.append(
                F.struct(
                    F.lit(rule.name).alias("rule"),
                    F.coalesce(F.sum(F.when(fails, F.col("documents"))), F.lit(0)).alias("failed"),
                    F.coalesce(F.sum(F.when(alone, F.col("documents"))), F.lit(0)).alias("failed_alone"),
                )
            )
    return patterns.agg(F.array(*measures).alias("all")).select(F.inline("all"))


def verdicts(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under the policy."""
    return ledger(docs).withColumns({"base_failed": ~passes("base"), "kept": passes("base") & passes(policy)})
