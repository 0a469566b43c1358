"""Token counts by finite-state transducers compiled from a tokenizer file.

Two deterministic transducers count the tokens of a text without building them. The
first reads classes of characters and marks where words begin. The second reads the
bytes of a word, and each of its transitions carries the change in the number of tokens
of what was read so far (it may be negative: a longer token can replace several).

The first is run in chunks at once: the map of a chunk says for every state in which
state it is left; a parallel prefix scan composes the maps, which gives every chunk the
state it begins in. States of the second are made when a text first reaches them, since
few of all states are ever reached; their number is bounded, and beyond it they are
made anew.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.normalizers import Lowercase

from tidelog.llm.texts import pieces, text_buffer

LIMIT = 2048
SECTION = 1 << 20  # bytes of text worked on at once
CHUNK = 128  # characters per chunk of the scan
KEPT = 1 << 20  # transitions and words a task keeps, at most

# Classes of characters. An apostrophe that could begin a contraction has its own.
SPACE, LETTER, DIGIT, OTHER, SHORT, LONG = range(6)
# States between characters: none open, in letters, in other characters, and so many letters of a contraction to come.
OPEN, LETTERS, OTHERS, ONE_MORE, TWO_MORE = range(5)
#: Fixed contractions of the word pattern, without their apostrophe.
CONTRACTIONS = ("s", "t", "m", "d", "re", "ve", "ll")
_LAST = 0x33480  # code points from here on are neither letters, digits nor spaces


def _word_machine() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and whether a word begins, for state * 6 + class."""
    after, begins = np.zeros((5, 6), np.uint8), np.zeros((5, 6), bool)
    for state in (OPEN, LETTERS, OTHERS):
        after[state] = [OPEN, LETTERS, OPEN, OTHERS, ONE_MORE, TWO_MORE]
        begins[state] = [False, state != LETTERS, True, state != OTHERS, True, True]
    # A run of other characters takes the apostrophe along.
    after[OTHERS, [SHORT, LONG]], begins[OTHERS, [SHORT, LONG]] = OTHERS, False
    after[ONE_MORE], after[TWO_MORE] = OPEN, ONE_MORE
    return after.reshape(-1), begins.reshape(-1)


AFTER, BEGINS = _word_machine()


def composed(maps: np.ndarray) -> np.ndarray:
    """The map of all chunks up to and with each, by a scan of log2(n) steps."""
    maps, step = maps.copy(), 1
    while step < len(maps):
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step], 1)
        step *= 2
    return maps


def word_begins(classes: np.ndarray) -> np.ndarray:
    """Where words begin, as a mask over characters."""
    count = -(-len(classes) // CHUNK)
    table = np.zeros(count * CHUNK, np.uint8)
    table[: len(classes)] = classes
    table = np.ascontiguousarray(table.reshape(count, CHUNK).T)
    maps = np.broadcast_to(np.arange(5, dtype=np.uint8), (count, 5))
    for column in table:
        maps = AFTER[maps * np.uint8(6) + column[:, None]]
    state = np.zeros(count, np.uint8)
    if count > 1:
        state[1:] = composed(maps)[:-1, OPEN]
    marks = np.zeros((CHUNK, count), bool)
    for mark, column in zip(marks, table, strict=True):
        step = state * np.uint8(6) + column
        mark[:], state = BEGINS[step], AFTER[step]
    return marks.T.reshape(-1)[: len(classes)]


class Characters:
    """The class and the lower case of each code point, as the tokenizer file has them."""

    def __init__(self, tokenizer: Tokenizer):
        points = [chr(c) for c in range(_LAST) if not 0xD800 <= c < 0xE000]
        split = tokenizer.pre_tokenizer.pre_tokenize_str
        # After a letter only a letter stays in the word; after a dash only another mark does.
        joins = lambda first: self._alone(split("\n".join(first + c for c in points)), points)
        pairs, dashes = joins("a"), joins("-")
        kind = np.where(pairs == 1, LETTER, np.where(dashes == 1, OTHER, DIGIT))
        kind[pairs == 0] = SPACE
        codes = np.array([ord(c) for c in points])
        self.kind = np.full(_LAST + 1, OTHER, np.uint8)
        self.kind[codes] = kind
        self.lower = np.arange(_LAST + 1, dtype=np.uint32)
        self.longer: dict[str, str] = {}
        lowercase = Lowercase().normalize_str
        for c in points:
            low = lowercase(c)
            if len(low) == 1:
                self.lower[ord(c)] = ord(low)
            else:
                self.longer[c] = low

    @staticmethod
    def _alone(found: list, points: list[str]) -> np.ndarray:
        """For each probe of two characters: 0 if the second is a space, else into how many words it went."""
        ends = np.array([span[1] for _, span in found])
        begins = np.array([span[0] for _, span in found])
        probe = 3 * np.arange(len(points))
        words = np.searchsorted(begins, probe + 2) - np.searchsorted(begins, probe)
        covered = ends[np.searchsorted(begins, probe + 2) - 1] == probe + 2
        return np.where(covered, words, 0)


class Merges:
    """The word transducer of a merge vocabulary; a symbol is a byte, or 256 more at the end of a word.

    A state knows the symbols that a token still to end may begin with, the last token of
    the words cut off at each of them, and the token counts there, all relative to now.
    The last token of a longer word is the one token ending there that keeps apart from
    the last token before it, so the next state follows from the state and the symbol.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        byte = {c: chr(b) for b, c in byte_characters().items()}
        marked = len(suffix)

        def symbols(token: str) -> str:
            if token.endswith(suffix) and len(token) > marked:
                inner = [byte[c] for c in token[:-marked]]
                inner[-1] = chr(ord(inner[-1]) + 256)
                return "".join(inner)
            return "".join(byte[c] for c in token)

        self.tokens = {symbols(t) for t in vocabulary}
        self.prefixes = {t[:n] for t in self.tokens for n in range(len(t))}
        self.ranks = {(symbols(a), symbols(b)): rank for rank, (a, b) in reversed(list(enumerate(merges)))}
        self._forget()

    def _forget(self) -> None:
        start = ("", (None,), (0,))
        self.states, self.numbers = [start], {start: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.apart: dict[tuple[str | None, str], bool] = {}

    def encode(self, symbols: str) -> list[str]:
        """The tokens by merging the best pair first."""
        parts = list(symbols)
        while len(parts) > 1:
            rank, at = min((self.ranks.get(p, len(self.ranks)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _keeps_apart(self, before: str | None, token: str) -> bool:
        known = self.apart.get((before, token))
        if known is None:
            known = self.encode((before or "") + token) == ([before, token] if before else [token])
            self.apart[before, token] = known
        return known

    def _step(self, state: int, symbol: int) -> tuple[int, int]:
        recent, last, counts = self.states[state]
        read = recent + chr(symbol)
        for length in range(len(read), 0, -1):
            token = read[-length:]
            if token in self.tokens and self._keeps_apart(last[-length], token):
                break
        change = counts[-length] + 1
        kept = next(n for n in range(len(read), -1, -1) if read[len(read) - n :] in self.prefixes)
        later = (*[c - change for c in counts], 0)
        new = (read[len(read) - kept :], (*last, token)[-kept - 1 :], later[-kept - 1 :])
        number = self.numbers.setdefault(new, len(self.states))
        if number == len(self.states):
            self.states.append(new)
        self.steps[state << 9 | symbol] = number, change
        return number, change

    def count(self, word: bytes) -> int:
        """The number of tokens of a word of at least one byte."""
        if len(self.steps) + len(self.apart) > KEPT:
            self._forget()
        state, total, known = 0, 0, self.steps
        for place, byte in enumerate(word, 1):
            symbol = byte + 256 if place == len(word) else byte
            state, change = known.get(state << 9 | symbol) or self._step(state, symbol)
            total += change
            if len(known) > 2 * KEPT:  # one endless word: only its own state is needed
                here = self.states[state]
                self._forget()
                known, state = self.steps, self.numbers.setdefault(here, 1)
                if state:
                    self.states.append(here)
        return total


def byte_characters() -> dict[int, str]:
    """The visible character for each byte in vocabularies of byte-level tokenizers.

    Printable bytes stand for themselves; the others follow from U+0100 on, in order.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + n) for n, b in enumerate(hidden)}


class Counter:
    """Both transducers of a tokenizer file, and the words a task has counted."""

    def __init__(self, path: str, characters: Characters | None = None):
        with open(path, encoding="utf-8") as file:
            written = json.load(file)
        self.characters = characters or Characters(Tokenizer.from_file(path))
        model = written["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = re.compile("|".join(re.escape(t["content"]) for t in written["added_tokens"]))
        self.words: dict[str, int] = {}

    def _normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            for c, low in self.characters.longer.items():
                text = text.replace(c, low)
        return text

    def count(self, texts: list[str]) -> np.ndarray:
        """The tokens of each text."""
        special = np.zeros(len(texts), np.int64)
        normal = []
        for row, text in enumerate(texts):
            if "<" in text:
                text, special[row] = self.special.subn("\n", text)
            normal.append(self._normal(text) + "\n")
        points = np.frombuffer("".join(normal).encode("utf-32-le"), np.uint32)
        bounds = np.cumsum([0, *map(len, normal)])
        known = np.minimum(points, _LAST)
        lower = np.where(points < _LAST, self.characters.lower[known], points)
        kind = self.characters.kind[np.minimum(lower, _LAST)]
        quote = np.flatnonzero(lower == ord("'"))
        for ending in CONTRACTIONS:
            fits = quote[quote + len(ending) < len(lower)]
            for place, c in enumerate(ending, 1):
                fits = fits[lower[fits + place] == ord(c)]
            kind[fits] = SHORT if len(ending) == 1 else LONG
        begins = word_begins(kind)
        starts = np.flatnonzero(begins)
        # A word ends where the next begins or at a space; every text ends with one.
        stops = np.flatnonzero(begins | (kind == SPACE))
        ends = stops[np.searchsorted(stops, starts) + 1] if len(starts) else starts
        joined = lower.astype("<u4").tobytes().decode("utf-32-le")
        if len(self.words) > KEPT:
            self.words.clear()
        seen, counts = self.words, np.empty(len(starts), np.int64)
        for at, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
            word = joined[a:b]
            n = seen.get(word)
            if n is None:
                n = seen[word] = self.merges.count(word.encode())
            counts[at] = n
        sums = np.concatenate([[0], np.cumsum(counts)])
        edges = np.searchsorted(starts, bounds)
        return special + sums[edges[1:]] - sums[edges[:-1]]


def sections(text: bytes) -> Iterator[str]:
    """A text in parts of about ``SECTION`` bytes, cut after a space; a part without one is longer."""
    low = 0
    while low < len(text):
        high = len(text)
        if high - low > SECTION:
            cut = max(text.rfind(space, low, low + SECTION) for space in (b" ", b"\n"))
            if cut < 0:
                found = [at for at in (text.find(space, low + SECTION) for space in (b" ", b"\n")) if at >= 0]
                cut = min(found, default=high - 1)
            high = cut + 1
        yield text[low:high].decode()
        low = high


@cache
def _counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens``: what the tokenizer in the file ``path`` makes of each whole ``text``.

    The tokenizer is one of merges with word ends, lower case and dropped white space, at
    the same path on every machine. Strings of special tokens in a text count as such a
    token. A null or empty text has none. Other columns are kept; an ``n_tokens`` among
    them is replaced. Every row is counted by itself, so repeated rows count alike.
    """
    path = path or public_tokenizers.path("word_bpe_49k.json")
    names = [n for n in docs.columns if n != "n_tokens"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            column = pc.fill_null(batch.column(text).cast(pa.large_string()), "")
            _, offsets = text_buffer(column)
            total = np.zeros(len(column), np.int64)
            for low, high in pieces(offsets, SECTION):
                part = column.slice(low, high - low).to_pylist()
                if offsets[high] - offsets[low] <= SECTION:
                    total[low:high] = counter.count(part)
                else:  # one long text
                    total[low] = sum(int(counter.count([s])[0]) for s in sections(part[0].encode()))
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(total)], [*names, "n_tokens"])

    return docs.select(*[F.col(f"`{n}`") for n in docs.columns]).mapInArrow(count, f"{schema}, n_tokens bigint")


def counts(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit``.

    As ``token_counts``; a null id keeps its row.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = token_counts(rows.withColumn("n_bytes", F.octet_length("text").cast("long")), path=path)
    return rows.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
