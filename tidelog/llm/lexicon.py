"""Plain spellings of words, and a lexicon learned from labelled texts.

A plain spelling undoes what hides a word: digits and signs for letters, accents and
look-alikes of other scripts, marks or spaces between letters, repeated letters. The
entries of a lexicon are plain words and their first letters, known by 64-bit hashes; the
weight of an entry is the log-odds of label 1 among the texts that have it.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.texts import SPACES, Words, mix, pieces, text_buffer

STEMS = range(3, 11)  # bytes of a word's beginning that are entries of their own
ENTRIES = 1 << 16  # of a learned lexicon, at most
LEAST_TEXTS = 3  # of label 1 that have an entry
LEAST_WEIGHT = 1.0
STRONG = 3.0
SPACED = 3  # letters that stand alone, from which they are one word
_PIECE = 1 << 20
_LOW = (1 << 20) - 1

_DROP = 1  # in the table of foldings
#: Fixed look-alikes of Latin letters in other scripts.
ALIKE = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "к": "k",
    "м": "m", "т": "t", "в": "b", "н": "h", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "ν": "v", "κ": "k", "χ": "x", "ß": "s", "ı": "i", "ø": "o", "ł": "l", "đ": "d", "æ": "a", "œ": "o",
}
#: Fixed signs for letters, by place.
_SIGNS, _LETTERS_OF_SIGNS = "013457@$!|+", "oieastasiit"

_PLAIN = np.zeros(256, np.uint8)  # 0: not written
_PLAIN[0x80:] = np.arange(0x80, 256)
for _c in "abcdefghijklmnopqrstuvwxyz":
    _PLAIN[[ord(_c), ord(_c.upper())]] = ord(_c)
for _c, _to in zip(_SIGNS, _LETTERS_OF_SIGNS, strict=True):
    _PLAIN[ord(_c)] = ord(_to)
_PLAIN[SPACES] = np.flatnonzero(SPACES)


def _folding() -> np.ndarray:
    """For code points below 2^16 the letter they stand for, ``_DROP`` for marks without a body, or 0."""
    table = np.zeros(1 << 16, np.uint8)
    for code in range(0x80, 1 << 16):
        c = chr(code)
        low = c.lower()
        base = ALIKE.get(low) or unicodedata.normalize("NFKD", low)[:1].lower()
        if unicodedata.category(c) in ("Mn", "Cf"):
            table[code] = _DROP
        elif "a" <= base <= "z" and len(base) == 1:
            table[code] = ord(base)
    return table


_FOLDING = _folding()


def plain_spelling(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with plain words between their spaces, and their offsets."""
    out = _PLAIN[data]
    if len(data) and data.max() >= 0xC3:
        at = np.arange(len(data))
        for first, last, size in ((0xC2, 0xDF, 2), (0xE0, 0xEF, 3)):
            lead = at[(data >= first) & (data <= last)]
            code = data[lead].astype(np.int64) & (0x1F if size == 2 else 0x0F)
            for k in range(1, size):
                code = code << 6 | (data[lead + k] & 0x3F)
            to = _FOLDING[code]
            lead, to = lead[to > 0], to[to > 0]
            for k in range(size - 1):
                out[lead + k] = 0
            out[lead + size - 1] = np.where(to == _DROP, 0, to)
    data, offsets = _kept(out, offsets, out > 0)
    # Letters that stand alone, one after the other, lose the spaces between them.
    words = Words(data, offsets)
    alone = (words.ends - words.starts == 1) & (data[words.starts] < 0x80)
    tied = alone[:-1] & alone[1:] & (np.diff(words.rows) == 0)  # to the next word
    if tied.any():
        edges = np.flatnonzero(np.diff(np.concatenate([[0], tied, [0]])))
        for_run = np.repeat(edges[1::2] - edges[::2], edges[1::2] - edges[::2]) + 1 >= SPACED
        joint = np.flatnonzero(tied)[for_run]
        gaps = np.zeros(len(data) + 1, np.int64)
        np.add.at(gaps, words.ends[joint], 1)
        np.add.at(gaps, words.starts[joint + 1], -1)
        data, offsets = _kept(data, offsets, np.cumsum(gaps)[:-1] == 0)
    again = np.zeros(len(data), bool)
    again[1:] = (data[1:] == data[:-1]) & ~SPACES[data[1:]]
    again[offsets[:-1][offsets[:-1] < len(data)]] = False
    return _kept(data, offsets, ~again)


def _kept(data: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data[mask], np.concatenate([[0], np.cumsum(mask)])[offsets]


def plain_hashes(words: Iterable[str]) -> np.ndarray:
    """Sorted hashes of the plain spellings of words."""
    spelled = plain_spelling(*text_buffer(pa.array(list(words), pa.large_string())))
    return np.unique(Words(*spelled).hashes(lower=True))


def contained(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def entries(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, word) of the whole words, and of each stem of the words that are longer."""
    hashes = words.hasher(lower=True)
    longer = np.arange(len(words.starts))
    yield hashes(words.starts, words.ends), longer
    for size in STEMS:
        longer = longer[words.ends[longer] - words.starts[longer] > size]
        starts = words.starts[longer]
        yield mix(hashes(starts, starts + size) + np.uint64(size)), longer


@dataclass
class Lexicon:
    """Sorted hashes of entries and their weights."""

    known: np.ndarray
    weights: np.ndarray

    @cached_property
    def _maybe(self) -> np.ndarray:
        """By the low bits of a hash, whether an entry has them: most words fail here."""
        table = np.zeros(_LOW + 1, bool)
        table[self.known & np.uint64(_LOW)] = True
        return table

    def of_words(self, words: Words) -> np.ndarray:
        """The weight of every word: that of its best entry, 0 without one."""
        best = np.zeros(len(words.starts))
        if len(self.known):
            for value, word in entries(words):
                maybe = self._maybe[value & np.uint64(_LOW)]
                value, word = value[maybe], word[maybe]
                at = np.minimum(np.searchsorted(self.known, value), len(self.known) - 1)
                found = np.flatnonzero(self.known[at] == value)
                best[word[found]] = np.maximum(best[word[found]], self.weights[at[found]])
        return best


EMPTY = Lexicon(np.zeros(0, np.uint64), np.zeros(0))


def learned(texts: DataFrame, most: int = ENTRIES) -> Lexicon:
    """From (text, label 0 or 1), a bounded sample of rows: at most ``most`` entries of the greatest weight times texts.

    Entry counts are aggregated in Spark; a text counts once for an entry. Without rows
    of both labels there are no entries.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            label = batch.column("label").to_numpy().astype(np.int64)
            for low, high in pieces(offsets, _PIECE):
                cut = offsets[low : high + 1]
                spelled, bounds = plain_spelling(data[cut[0] : cut[-1]], cut - cut[0])
                words = Words(spelled, bounds)
                rows = words.rows
                keys, owners = [], []
                for value, word in entries(words):
                    keys.append(value)
                    owners.append(rows[word])
                key, owner = np.concatenate(keys), np.concatenate(owners)
                order = np.lexsort((owner, key))
                key, owner = key[order], owner[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
                key, owner = key[new], owner[new]
                unique, of = np.unique(key, return_inverse=True)
                one = np.bincount(of.reshape(-1), label[low:high][owner], len(unique)).astype(np.int64)
                both = np.bincount(of.reshape(-1), minlength=len(unique))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(unique.view(np.int64)), pa.array(one), pa.array(both - one)], ["entry", "ones", "zeros"]
                )

    kinds = {int(r.label): r["count"] for r in texts.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return EMPTY
    counts = texts.select("text", "label").mapInArrow(count, "entry bigint, ones bigint, zeros bigint")
    counts = counts.groupBy("entry").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    share = lambda name, n: F.log((F.col(name) + 0.5) / (n + 1.0))
    weighed = counts.filter(F.col("ones") >= LEAST_TEXTS).withColumn("weight", share("ones", kinds[1]) - share("zeros", kinds[0]))
    weighed = weighed.filter(F.col("weight") >= LEAST_WEIGHT)
    rows = weighed.orderBy((F.col("weight") * F.col("ones")).desc(), "entry").limit(most).select("entry", "weight").toArrow()
    known = rows.column("entry").to_numpy().view(np.uint64)
    order = np.argsort(known)
    return Lexicon(known[order], rows.column("weight").to_numpy()[order])
