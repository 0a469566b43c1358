"""Language identification in two steps: the family, then the language within it.

Texts are counts of hashed letter trigrams. Families, and then the languages of the
family that won, are told apart by one-versus-one linear support vector machines.
They are fitted on a bounded sample; scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.texts import key_crc, mix, pieces, renamed, text_buffer

WIDTH = 2048
SAMPLE = 4000  # training texts in all, in equal parts for each language
LANGUAGES = 256  # the most frequent ones are learned
UNKNOWN = "und"

#: Fixed families of language codes; a code that isn't listed is a family of its own.
FAMILIES: Mapping[str, tuple[str, ...]] = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "tt", "ky"),
    "indic": ("hi", "bn", "mr", "ne", "pa", "gu", "ur"),
    "semitic": ("ar", "he", "am", "mt"),
}

# Bytes as they enter a trigram: ASCII letters in lower case, the rest of ASCII as one space.
_LETTERS = np.arange(256, dtype=np.uint64)
_LETTERS[: 0x80] = 0x20
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)


def family(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((name for name, codes in FAMILIES.items() if code in codes), f"only {lang}")


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of unit length for each text: damped counts of its trigrams by hash."""
    count = len(offsets) - 1
    letters = np.full(len(data) + 2, 0x20, np.uint64)
    letters[:-2] = _LETTERS[data]
    code = letters[:-2] << np.uint64(16) | letters[1:-1] << np.uint64(8) | letters[2:]
    row = np.repeat(np.arange(count), np.diff(offsets))
    # A trigram must lie in one text and have a letter.
    inside = np.arange(len(data)) + 2 < np.repeat(offsets[1:], np.diff(offsets))
    inside &= code != 0x202020
    cell = (mix(code[inside]) % np.uint64(WIDTH)).astype(np.int64) + row[inside] * WIDTH
    table = np.log1p(np.bincount(cell, minlength=count * WIDTH).reshape(count, WIDTH).astype(np.float32))
    return table / np.maximum(np.sqrt((table**2).sum(1, keepdims=True)), 1e-9)


def fit_machine(rows: np.ndarray, sides: np.ndarray, strength: float = 1e-3, steps: int = 200) -> np.ndarray:
    """Weights and bias of a linear support vector machine (squared hinge), by accelerated descent."""
    rows = np.concatenate([rows, np.ones((len(rows), 1), np.float32)], 1)
    share = np.where(sides > 0, 0.5 / max((sides > 0).sum(), 1), 0.5 / max((sides < 0).sum(), 1)).astype(np.float32)
    weights = ahead = np.zeros(rows.shape[1], np.float32)
    for step in range(steps):
        short = np.maximum(0, 1 - sides * (rows @ ahead))
        slope = strength * ahead - 2 * rows.T @ (share * sides * short)
        before, weights = weights, ahead - slope / np.float32(4.0 + strength)
        ahead = weights + np.float32(step / (step + 3)) * (weights - before)
    return weights


class Hierarchy:
    """Machines between families, and between the languages of each family."""

    def __init__(self, rows: np.ndarray, langs: np.ndarray):
        families = np.array([family(x) for x in langs])
        self.nodes: dict[str, list[str]] = {"": sorted(set(families))}
        for name in self.nodes[""]:
            self.nodes[name] = sorted(set(langs[families == name]))
        self.machines: dict[str, list[tuple[int, int, np.ndarray]]] = {}
        for node, members in self.nodes.items():
            of = families if not node else np.where(families == node, langs, "")
            self.machines[node] = []
            for i, j in combinations(range(len(members)), 2):
                pick = (of == members[i]) | (of == members[j])
                sides = np.where(of[pick] == members[i], 1.0, -1.0).astype(np.float32)
                self.machines[node].append((i, j, fit_machine(rows[pick], sides)))

    def _choose(self, node: str, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The member with most votes for each row, and its share of them; margins weigh the votes."""
        votes = np.zeros((len(rows), len(self.nodes[node])))
        for i, j, weights in self.machines[node]:
            sure = 1 / (1 + np.exp(-4 * (rows @ weights[:-1] + weights[-1])))
            votes[:, i] += sure
            votes[:, j] += 1 - sure
        if votes.shape[1] == 1:
            votes += 1
        best = votes.argmax(1)
        return best, votes[np.arange(len(rows)), best] / max(votes.shape[1] - 1, 1)

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The language of each row, and the product of both steps' shares."""
        chosen, score = self._choose("", rows)
        langs = np.empty(len(rows), object)
        for number, name in enumerate(self.nodes[""]):
            own = np.flatnonzero(chosen == number)
            if len(own):
                best, share = self._choose(name, rows[own])
                langs[own] = np.array(self.nodes[name], object)[best]
                score[own] *= share
        return langs, score


def fit(learned: DataFrame, sample: int = SAMPLE) -> Hierarchy | None:
    """From (doc_id, text, lang) without nulls in lang: about ``sample`` texts, chosen by a hash of id and text.

    The ``LANGUAGES`` most frequent values of lang are learned. Equal rows are one text,
    so however often a row is repeated, the sample stays as it is.
    """
    keyed = learned.withColumn("key", F.xxhash64(F.lit(5), F.col("doc_id").cast("string"), "text"))
    sizes = keyed.groupBy("lang").agg(F.approx_count_distinct("key").alias("texts"))
    counts = sizes.orderBy(F.col("texts").desc(), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    share = F.lit(0.0)
    for lang, count in sorted(counts):
        share = F.when(F.col("lang") == lang, min(1.0, sample / len(counts) / count)).otherwise(share)
    chance = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) / float(1 << 20)
    chosen = keyed.filter(chance < share).groupBy("lang", "key").agg(F.first("text").alias("text")).select("lang", "text")

    def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets, 1 << 20):
                cut = offsets[low : high + 1]
                table = trigrams(data[cut[0] : cut[-1]], cut - cut[0]).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(low, high - low), pa.array([r.tobytes() for r in table], pa.binary())],
                    ["lang", "counts"],
                )

    got = chosen.mapInArrow(count_rows, "lang string, counts binary").toArrow()
    if not got.num_rows:
        return None
    langs = np.array(got.column("lang").to_pylist(), object)
    rows = np.frombuffer(b"".join(got.column("counts").to_pylist()), np.float16).reshape(len(langs), WIDTH)
    order = np.lexsort((got.column("counts").to_pylist(), langs.astype(str)))  # whatever order the tasks end in
    return Hierarchy(rows[order].astype(np.float32), langs[order])


def _lettered(text: str) -> F.Column:
    return F.coalesce(F.col(f"`{text}`").rlike(r"\p{L}"), F.lit(False))


def predicted(docs: DataFrame, model: Hierarchy | None, text: str = "text") -> DataFrame:
    """``docs`` with ``__lang`` and ``__score``; ``und`` and 0 without a letter, or without a model."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # WIDTH weights for each pair of languages
    names = docs.columns
    lettered = docs.withColumn("__letter", _lettered(text))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(text))
            letter = batch.column("__letter").to_numpy(zero_copy_only=False)
            for low, high in pieces(offsets, 1 << 21):
                cut = offsets[low : high + 1]
                lang, score = np.full(high - low, UNKNOWN, object), np.zeros(high - low)
                own = letter[low:high]
                if sent.value is not None and own.any():
                    table = trigrams(data[cut[0] : cut[-1]], cut - cut[0])
                    lang[own], score[own] = sent.value.predict(table[own])
                rows = batch.slice(low, high - low).select(names)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(lang, pa.string()), pa.array(score)], [*names, "__lang", "__score"]
                )

    added = [T.StructField("__lang", T.StringType()), T.StructField("__score", T.DoubleType())]
    return lettered.mapInArrow(predict, T.StructType(docs.schema.fields + added))


def _held_out(folds: int, fold: int) -> F.Column:
    return F.coalesce(key_crc(F.col("doc_id")) % folds == fold, F.lit(False))


def _fitted(docs: DataFrame, folds: int, fold: int) -> Hierarchy | None:
    learned = docs.filter(~_held_out(folds, fold)).select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("lang").cast("string").alias("lang")
    )
    return fit(learned.filter("lang is not null"))


def identify(docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``lang_pred`` and ``score``.

    Learns from ``lang`` of the documents outside one fold; a null id is in no fold, a
    null ``lang`` teaches nothing. A text that is null or has no letter is ``und`` with
    score 0, as is every text if there is nothing to learn from. Repeated rows are
    predicted each, equal texts alike. Ties go to the first code in order.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = predicted(texts, _fitted(docs, folds, fold))
    return found.select(
        "doc_id", _held_out(folds, fold).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score")
    )


def keep_known(docs: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """``docs`` without those whose text is null or has no letter, and with a language for each of the others.

    A null ``lang`` is filled with the predicted one; all else stays as it is, whatever
    the columns are called. A document with letters stays whatever is predicted: also if
    nothing could be learned (its ``lang`` then stays null), and if ``und`` is a value of
    ``lang``. Repeated rows stay, each; an empty table stays empty.
    """
    rows, back = renamed(docs, "doc_id", "text", "lang")
    model = _fitted(rows, folds, fold)
    found = predicted(rows.filter(_lettered("text")), model)
    if model is not None:
        own = rows.schema["lang"].dataType
        found = found.withColumn("lang", F.coalesce("lang", F.col("__lang").cast(own)))
    return found.select(*back)
