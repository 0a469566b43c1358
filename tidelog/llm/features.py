"""Dense features of whole texts for the classifiers, each a rate or a damped count."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.lexicon import EMPTY, STRONG, Lexicon, contained, plain_hashes, plain_spelling
from tidelog.llm.rules import MEASURES, measure
from tidelog.llm.texts import NOT_ALPHANUMERIC, Words, map_pieces, mix, text_buffer

#: Fixed insults, in the languages of the texts.
INSULTS = (
    "clown", "coward", "cretin", "disgusting", "dumb", "filth", "fool", "freak", "garbage", "idiot", "imbecile", "jerk",
    "loser", "moron", "pathetic", "pig", "scum", "stupid", "trash", "ugly", "vermin", "worthless",
    "abschaum", "blöd", "dumm", "ekelhaft", "erbärmlich", "trottel", "versager", "wertlos",
    "crétin", "débile", "imbécile", "minable", "ordure", "pathétique", "répugnant", "stupide",
    "asqueroso", "basura", "escoria", "estúpido", "idiota", "imbécil", "inútil", "patético",
)
#: Fixed words of the second person.
YOU = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
    "tu", "te", "toi", "ton", "ta", "vous", "votre", "tú", "ti", "tus", "usted", "ustedes", "vosotros",
)
NEAR = 5

def _is(chars: Iterable[str]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_EXCLAIM, _ASK, _DIGIT = _is("!"), _is("?"), _is("0123456789")
_PUNCTUATION = np.array([b < 0x80 and chr(b).isprintable() and not chr(b).isalnum() and b != 0x20 for b in range(256)])
_UPPER = _is("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LOWER = _is("abcdefghijklmnopqrstuvwxyz")

TOXIC = (
    "log_words", "insults", "insult_rate", "plain_insults", "plain_insult_rate", "hidden_rate", "you_rate", "near_you",
    "near_you_rate", "capital_rate", "shouted_rate", "exclaim_rate", "ask_rate", "punctuation_rate", "digit_rate", "mixed_rate",
    "masked", "learned_first", "learned_second", "learned_third", "learned_rate", "strong", "strong_rate",
)
QUALITY = (
    "log_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate", "letter_rate", "capital_rate",
    "distinct_rate", "line_rate", "punctuation_rate", "digit_rate", "exclaim_rate",
)


def _known(words: Iterable[str]) -> np.ndarray:
    texts = pa.array(list(words), pa.large_string())
    return np.unique(Words(*text_buffer(texts)).hashes(lower=True))


def _masked(words: Iterable[str]) -> set[str]:
    """The words with one or two inner letters as asterisks, or both as one."""
    found = set()
    for word in words:
        for size in (1, 2):
            for at in range(1, len(word) - size):
                found |= {word[:at] + "*" * n + word[at + size :] for n in (1, size)}
    return found


_INSULTS, _YOU = _known(INSULTS), _known(YOU)
_PLAIN_INSULTS = plain_hashes(INSULTS)
_MASKING = NOT_ALPHANUMERIC.copy()
_MASKING[ord("*")] = False


def _known_masked() -> np.ndarray:
    texts = pa.array(sorted(_masked(INSULTS)), pa.large_string())
    return np.unique(Words(*text_buffer(texts), _MASKING).hashes(lower=True))


_MASKED_INSULTS = _known_masked()


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _greatest(values: np.ndarray, bounds: np.ndarray, count: int) -> list[np.ndarray]:
    """The greatest, second and so on of each row's values; 0 where a row has fewer."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((-values, rows))
    found = []
    for k in range(count):
        at = bounds[:-1] + k
        has = at < bounds[1:]
        best = np.zeros(len(at))
        best[has] = values[order[at[has]]]
        found.append(best)
    return found


def toxic_features(data: np.ndarray, offsets: np.ndarray, lexicon: Lexicon = EMPTY) -> np.ndarray:
    """A row of ``TOXIC`` for each text; an empty one has zeros."""
    words = Words(data, offsets, NOT_ALPHANUMERIC)
    hashes = words.hashes(lower=True)
    insult, you = contained(hashes, _INSULTS), contained(hashes, _YOU)
    row = words.rows
    reach = np.zeros(len(hashes) + 1, np.int64)
    at = np.flatnonzero(you)
    bounds = words.bounds
    np.add.at(reach, np.maximum(at - NEAR, bounds[:-1][row[at]]), 1)
    np.add.at(reach, np.minimum(at + NEAR + 1, bounds[1:][row[at]]), -1)
    near = insult & (np.cumsum(reach)[:-1] > 0)

    spelled = Words(*plain_spelling(data, offsets))
    hidden = contained(spelled.hashes(lower=True), _PLAIN_INSULTS)
    weights = lexicon.of_words(spelled)
    masked = Words(data, offsets, _MASKING)
    covered = contained(masked.hashes(lower=True), _MASKED_INSULTS)

    tokens = Words(data, offsets)
    sums = lambda mask: np.concatenate([[0], np.cumsum(mask[data])])
    upper, lower, odd = sums(_UPPER), sums(_LOWER), sums(_PUNCTUATION | _DIGIT)
    span = lambda total, inset=0: total[tokens.ends - inset] - total[tokens.starts + inset]
    shouted = (span(upper) >= 2) & (span(lower) == 0)
    long_ = tokens.ends - tokens.starts >= 3
    inner = np.where(long_, odd[np.maximum(tokens.ends - 1, 0)] - odd[np.minimum(tokens.starts + 1, len(data))], 0)
    mixed = (inner > 0) & (span(upper) + span(lower) > 0)

    n = np.maximum(words.counts, 1)
    n_tokens, size = np.maximum(tokens.counts, 1), np.maximum(np.diff(offsets), 1)
    bytes_ = lambda mask: _sums(mask[data], offsets)
    n_insult, n_near = _sums(insult, bounds), _sums(near, bounds)
    n_hidden, n_covered = _sums(hidden, spelled.bounds), _sums(covered, masked.bounds)
    n_strong, n_spelled = _sums(weights >= STRONG, spelled.bounds), np.maximum(spelled.counts, 1)
    learned = np.concatenate([[0], np.cumsum(weights)])
    letters = np.maximum(bytes_(_UPPER) + bytes_(_LOWER), 1)
    return np.stack(
        [
            np.log1p(words.counts), n_insult, n_insult / n, n_hidden, n_hidden / n_tokens,
            np.maximum(n_hidden + n_covered - n_insult, 0) / n_tokens, _sums(you, bounds) / n, n_near, n_near / n,
            bytes_(_UPPER) / letters, _sums(shouted, tokens.bounds) / n_tokens, bytes_(_EXCLAIM) / n_tokens,
            bytes_(_ASK) / n_tokens, bytes_(_PUNCTUATION) / size, bytes_(_DIGIT) / size,
            _sums(mixed, tokens.bounds) / n_tokens, n_covered, *_greatest(weights, spelled.bounds, 3),
            (learned[spelled.bounds[1:]] - learned[spelled.bounds[:-1]]) / n_spelled, n_strong, n_strong / n_spelled,
        ],
        axis=1,
    )


def quality_features(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``QUALITY`` for each text; an empty one has zeros."""
    m = {name: column.to_numpy().astype(float) for name, column in zip(MEASURES, measure(rows, data, offsets).columns[1:], strict=True)}
    words = Words(data, offsets)
    marks = mix(np.arange(len(offsets) - 1, dtype=np.uint64) + np.uint64(1))
    _, first = np.unique(words.hashes(lower=True) ^ marks[words.rows], return_index=True)
    distinct = np.bincount(words.rows[first], minlength=len(offsets) - 1)
    n, chars, size = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1), np.maximum(np.diff(offsets), 1)
    bytes_ = lambda mask: _sums(mask[data], offsets)
    return np.stack(
        [
            np.log1p(m["n_words"]), m["word_chars"] / n, m["n_symbols"] / n, m["n_dup_lines"] / np.maximum(m["n_lines"], 1),
            m["n_repeat_words"] / n, m["n_letters"] / chars, m["n_capitals"] / np.maximum(m["n_letters"], 1),
            distinct / n, m["n_lines"] / n, bytes_(_PUNCTUATION) / size, bytes_(_DIGIT) / size, bytes_(_EXCLAIM) / n,
        ],
        axis=1,
    )


def with_features(docs: DataFrame, names: tuple[str, ...], lexicon: Lexicon = EMPTY) -> DataFrame:
    """(doc_id, the named features): ``TOXIC`` or ``QUALITY`` of every whole text."""

    def work(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
        table = toxic_features(data, offsets, lexicon) if names == TOXIC else quality_features(rows, data, offsets)
        return pa.RecordBatch.from_arrays(
            [rows.column("doc_id"), *[pa.array(np.ascontiguousarray(c)) for c in table.T]], ["doc_id", *names]
        )

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_pieces(texts, "text", work, "doc_id bigint, " + ", ".join(f"{n} double" for n in names))


def labelled(rows: DataFrame, labels: DataFrame, label: str, learned: F.Column, most: int) -> DataFrame:
    """Rows that may be learned from with their ``label`` (0 or 1): all, or about ``most`` chosen by hash of the id."""
    known = labels.select("doc_id", F.col(label).cast("double").alias("label")).filter("label in (0, 1)")
    joined = rows.filter(learned).join(known, "doc_id")
    share = min(1.0, most / max(joined.count(), 1))
    chance = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
    return joined.filter(chance < share)
