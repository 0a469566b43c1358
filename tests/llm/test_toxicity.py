"""Spellings, the learned lexicon and all features against plain versions; held-out results."""

import math
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidelog.llm import features, lexicon, queries, toxicity
from tidelog.llm.texts import Words, text_buffer

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SIGNS = dict(zip("013457@$!|+", "oieastasiit", strict=True))
SPACES = " \t\n\v\f\r"
TEXTS = [
    "You are an idiot, sir", "calm words only", "you 1d10t", "s.t.u.p.i.d man", "IDIOT " + "far " * 9 + "you", "", None,
    "s t u p i d you", "stuuuupid MORON!!!", "ïdïöt crétin CRÉTIN", "іdіоt lоser", "id*ot l**er p*g i*t", "ｉｄｉｏｔ",
    "i​di­ot x́y", "a b c d", "x a b", "é", "worthlessness réeuxment achlichkeit", "Why? WHY?! 42 a1b --- c-d", "😀 漢字 ÄÖ\x00z",
    " \n\t ", "loser " * 400,
]


def spelled(text):
    out = []
    for c in text:
        if ord(c) < 0x80:
            c = c if c in SPACES else c.lower() if c.isalpha() else SIGNS.get(c, "")
        elif ord(c) < 1 << 16:
            if unicodedata.category(c) in ("Mn", "Cf"):
                continue
            base = lexicon.ALIKE.get(c.lower()) or unicodedata.normalize("NFKD", c.lower())[0].lower()
            c = base if re.fullmatch("[a-z]", base) else c
        out.append(c)
    text = "".join(out)
    text = re.sub(r"(?<![^\s])(?:[a-z]\s+){2,}[a-z](?![^\s])", lambda m: re.sub(r"\s", "", m[0]), text, flags=re.ASCII)
    # Runs of bytes, so of ASCII letters only: other characters have bytes that differ.
    return re.sub(r"([^\s])\1+", lambda m: m[1] if m[1].isascii() else m[0], text, flags=re.ASCII)


def split(text):
    return [w for w in re.split(f"[{SPACES}]+", text) if w]


@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_plain_spelling(text):
    data, offsets = lexicon.plain_spelling(*text_buffer(pa.array([text, "you", text])))
    parts = [bytes(data[a:b]).decode() for a, b in zip(offsets, offsets[1:])]
    assert parts == [spelled(text), "you", spelled(text)]


@pytest.mark.parametrize("hidden", ["1d10t", "i.d.i.o.t", "i d i o t", "iiidiooot", "îdíôt", "іdіоt", "ｉｄｉｏｔ", "i​d​iot", "I-D-I-O-T"])
def test_hidden_insults_are_found(hidden):
    table = features.toxic_features(*text_buffer(pa.array([f"well {hidden} there"])))
    got = dict(zip(features.TOXIC, table[0], strict=True))
    assert got["plain_insults"] == 1 and got["insults"] == 0 and got["hidden_rate"] > 0


@pytest.mark.parametrize(("hidden", "count"), [("id*ot", 1), ("i**ot", 1), ("idi*t", 1), ("i*ot", 1), ("*diot", 0), ("idio*", 0), ("w*rd", 0)])
def test_masked_insults_are_found(hidden, count):
    table = features.toxic_features(*text_buffer(pa.array([f"well {hidden} there"])))
    assert table[0, features.TOXIC.index("masked")] == count


def hash_of(word, size=0):
    words = Words(*text_buffer(pa.array([word])))
    found = [value for value, _ in lexicon.entries(words)]
    return int(found[0][0]) if not size else int(found[1 + list(lexicon.STEMS).index(size)][0])


def made(weights):
    """A lexicon from {(word, bytes of its stem or 0): weight}."""
    pairs = sorted((hash_of(*entry), weight) for entry, weight in weights.items())
    return lexicon.Lexicon(np.array([h for h, _ in pairs], np.uint64), np.array([w for _, w in pairs]))


def weight_of(word, weights):
    raw = word.encode()
    return max([weights.get(word, 0.0)] + [weights.get(raw[:n], 0.0) for n in lexicon.STEMS if len(raw) > n])


def plain_features(text, weights):
    text = text or ""
    low = text.translate(LOW)
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    tokens, plain = split(text), split(spelled(text))
    insults, you = {w.translate(LOW) for w in features.INSULTS}, set(features.YOU)
    hits = [i for i, w in enumerate(words) if w in insults]
    near = [i for i in hits if any(w in you for w in words[max(i - 5, 0) : i + 6])]
    hidden = sum(w in {spelled(x) for x in insults} for w in plain)
    masked = sum(w in features._masked(insults) for w in re.findall(r"[^\x00-\x29\x2B-\x2F\x3A-\x60\x7B-\x7F]+", low))
    own = [weight_of(w, weights) for w in plain]
    best = sorted(own, reverse=True) + [0.0] * 3
    letters, upper = len(re.findall("[A-Za-z]", text)), len(re.findall("[A-Z]", text))
    odd = lambda c: ord(c) < 0x80 and c.isprintable() and not c.isalpha() and c != " "
    inner = lambda t: any(odd(c) for c in t.encode().decode("latin-1")[1:-1])
    n, n_tokens, size = max(len(words), 1), max(len(tokens), 1), max(len(text.encode()), 1)
    return [
        math.log1p(len(words)), len(hits), len(hits) / n, hidden, hidden / n_tokens,
        max(hidden + masked - len(hits), 0) / n_tokens, sum(w in you for w in words) / n, len(near), len(near) / n,
        upper / max(letters, 1), sum(len(re.findall("[A-Z]", t)) >= 2 and not re.search("[a-z]", t) for t in tokens) / n_tokens,
        text.count("!") / n_tokens, text.count("?") / n_tokens,
        sum(odd(c) and not c.isdigit() for c in text) / size, len(re.findall("[0-9]", text)) / size,
        sum(inner(t) and bool(re.search("[A-Za-z]", t)) for t in tokens) / n_tokens, masked, *best[:3],
        sum(own) / max(len(plain), 1), sum(w >= lexicon.STRONG for w in own), sum(w >= lexicon.STRONG for w in own) / max(len(plain), 1),
    ]


def test_all_features():
    weights = {("loser", 0): 4.0, ("worthles", 6): 3.0, ("reuxment", 4): 5.5, ("achlichkeit", 0): 1.5, ("you", 0): 1.1}
    by_text = {w if not n else w.encode()[:n]: v for (w, n), v in weights.items()}
    table = features.toxic_features(*text_buffer(pa.array(TEXTS)), made(weights))
    for row, text in zip(table, TEXTS, strict=True):
        got = dict(zip(features.TOXIC, row, strict=True))
        assert got == pytest.approx(dict(zip(features.TOXIC, plain_features(text, by_text), strict=True))), text


def test_learned_lexicon(spark):
    toxic = ["grumfang people", "the grumfangs of it", "grumfangly so", "odd one"]
    clean = ["the people of it", "so it is", "", "the grum of it"] * 5
    rows = [(t, 1.0) for t in toxic] + [(t, 0.0) for t in clean]
    ones, zeros = Counter(), Counter()
    for text, label in rows:
        units = {u for w in split(spelled(text)) for u in [w, *[w.encode()[:n] for n in lexicon.STEMS if len(w.encode()) > n]]}
        (ones if label else zeros).update(units)
    weigh = lambda u: math.log((ones[u] + 0.5) / 5) - math.log((zeros[u] + 0.5) / 21)
    want = {u: weigh(u) for u, n in ones.items() if n >= lexicon.LEAST_TEXTS and weigh(u) >= lexicon.LEAST_WEIGHT}
    assert b"grumfan" in want and b"grumfang" not in want and "grumfang" not in want
    df = spark.createDataFrame(rows, "text string, label double").repartition(3)
    found = lexicon.learned(df)
    assert sorted(found.weights) == pytest.approx(sorted(want.values()))
    assert found.of_words(Words(*text_buffer(pa.array(["grumfangest"])))).tolist() == pytest.approx([weigh(b"grumfan")])
    assert len(lexicon.learned(df, most=2).known) == 2
    assert len(lexicon.learned(df.filter("label = 0")).known) == len(lexicon.learned(df.limit(0)).known) == 0


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = queries.read(spark, sf, "documents"), queries.read(spark, sf, "labels")
    rows = toxicity.score(docs, labels).collect()
    known = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(r.score, known[r.doc_id]) for r in rows if r.doc_id in known and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    clean = sorted(s for s, label in held if not label)
    level = clean[int(0.95 * len(clean))]
    caught = [s > level for s, label in held if label]
    assert np.mean(caught) > 0.85
    assert len({s for s, _ in held}) > 100
    assert {r.held_out for r in rows} == {True, False} and labels.filter(F.col("toxic") == 1).count() > 300
