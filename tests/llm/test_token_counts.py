"""Counts of the transducers against the tokenizer library."""

import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidelog.llm import queries, token_counts

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return token_counts._counter(PATH)


def test_odd_texts(counter, library):
    draw = random.Random(3)
    signs = "abcdeflmrstvABÉ'''’ \n\t\x1c\x85\x00　019½٣Ⅷ!?.-<|>İßΣςあ漢ा́̈Ωﬁ\U0001f600‍"
    texts = ["", " ", "'", "''s", "it's we'll THEY'RE 'cause o'd 's't're", "x" * 5000, "ab" * 3000 + "c", "!" * 999, "7" * 999]
    texts += ["<|endoftext|>", "a<|startoftext|><|endoftext|>'s", "<|ENDOFTEXT|>", "<|endoftext|>́e", "<|endof"]
    texts += ["".join(draw.choice(signs) for _ in range(draw.randint(1, 150))) for _ in range(1500)]
    texts += ["".join(map(chr, (draw.choice((draw.randrange(0xD800), draw.randrange(0xE000, 0x40000))) for _ in range(60)))) for _ in range(1000)]
    assert counter.count(texts).tolist() == library(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=40), max_size=5))
def test_any_text(texts):
    library = Tokenizer.from_file(PATH) if "t" not in _kept else _kept["t"]
    _kept["t"] = library
    assert token_counts._counter(PATH).count(texts).tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


_kept: dict = {}


def test_scan_of_chunk_maps():
    """The scan finds the states that a walk from the first character finds."""
    draw = np.random.default_rng(5)
    for size in (0, 1, 127, 128, 129, 5000):
        classes = draw.choice(4, size, p=[0.1, 0.6, 0.1, 0.2]).astype(np.uint8)
        for at in range(0, max(size - 3, 0), 7):
            short = draw.random() < 0.5
            classes[at : at + 3] = [token_counts.SHORT, 1, 2] if short else [token_counts.LONG, 1, 1]
        state, marks = token_counts.OPEN, []
        for c in classes:
            marks.append(bool(token_counts.BEGINS[state * 6 + c]))
            state = token_counts.AFTER[state * 6 + c]
        assert token_counts.word_begins(classes).tolist() == marks
    maps = draw.integers(0, 5, (37, 5)).astype(np.uint8)
    held = np.arange(5)
    for one, all_ in zip(maps, token_counts.composed(maps), strict=True):
        held = one[held]
        assert all_.tolist() == held.tolist()


def test_word_transducer_follows_the_merges(counter):
    """Every prefix of a word has as many tokens as merging makes of it."""
    merges = counter.merges
    for word in (b"unbelievable", b"aaaaaaaaaaaaaaaaaaa", "naïveté".encode(), b"theethheth"):
        symbols = "".join(map(chr, word[:-1])) + chr(word[-1] + 256)
        state, total = 0, 0
        for place, symbol in enumerate(symbols, 1):
            state, change = merges.steps.get(state << 9 | ord(symbol)) or merges._step(state, ord(symbol))
            total += change
            assert total == len(merges.encode(symbols[:place]))


def test_bounded_memory(counter, library, monkeypatch):
    """Forgotten states are made anew, also within one endless word."""
    monkeypatch.setattr(token_counts, "KEPT", 40)
    own = token_counts.Counter(PATH, counter.characters)
    draw = random.Random(8)
    texts = ["".join(draw.choice("etaoin shrdlu") for _ in range(300)) for _ in range(20)]
    texts.append("".join(draw.choice("etaoinshrdlu") for _ in range(3000)))
    assert own.count(texts).tolist() == library(texts)
    assert len(own.merges.steps) < 200


def test_long_texts_in_sections(spark, library, monkeypatch):
    text = "It's  a very\nlong text; çà <|endoftext|> 'tis 42 " * 60_000
    parts = list(token_counts.sections(text.encode()))
    assert len(parts) > 2 and "".join(parts) == text
    assert list(token_counts.sections(b"")) == []
    unbroken = "é" * 700_000
    assert "".join(token_counts.sections(unbroken.encode())) == unbroken
    df = spark.createDataFrame([(1, text), (2, unbroken)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_counts.counts(df).collect()}
    assert got == dict(zip((1, 2), library([text, unbroken]), strict=True))


def test_whole_table(spark, library):
    docs = queries.read(spark, SF, "documents").collect()
    want = {d.doc_id: (len(d.text.encode()), n, n > 2048) for d, n in zip(docs, library([d.text for d in docs]), strict=True)}
    got = queries.op12_token_counts(spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want


def test_odd_rows(spark):
    schema = "doc_id bigint, text string, n_tokens string, n_bytes int, `a b` string"
    rows = [(None, "one two", "x", 1, None), (1, None, None, None, "k"), (1, "", "y", 2, "l"), (2, "one two", "z", 3, "m"), (2, "one two", "z", 3, "m")]
    df = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, token_counts.counts(df).collect()), key=str)
    assert got == sorted([(None, 7, 2, False), (1, 0, 0, False), (1, 0, 0, False), (2, 7, 2, False), (2, 7, 2, False)], key=str)
    kept = token_counts.token_counts(df)
    assert set(kept.columns) == set(df.columns) and sorted(r["n_tokens"] for r in kept.collect()) == [0, 0, 2, 2, 2]
    assert token_counts.counts(df.limit(0)).collect() == []
