"""Features and decisions of the classifiers, for fixed weights, against plain versions."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import features, languages
from tidelog.llm.texts import mix, text_buffer

TEXTS = [
    "The quick brown fox", "  Der schnelle, braune Fuchs! ", "", None, "a", "ab", "1234 5678", "é ü ñ été", "漢字かな",
    "x\nx\nx\n\ny z", "# * $ % & | < >", "one two three four five six seven eight nine " * 3, "CAPS and lower MIX", "w " * 3000,
]


def plain_trigrams(text):
    """Counts of trigrams of bytes in lower case, other ASCII as a space, hashed; one of spaces only doesn't count."""
    data = [b if b >= 0x80 else b | 0x20 if chr(b).isalpha() else 0x20 for b in (text or "").encode()]
    cells = Counter()
    for a, b, c in zip(data, data[1:], data[2:], strict=False):
        if (a, b, c) != (0x20, 0x20, 0x20):
            cells[int(mix(np.array([a << 16 | b << 8 | c], np.uint64))[0] % np.uint64(languages.WIDTH))] += 1
    row = np.zeros(languages.WIDTH)
    for cell, n in cells.items():
        row[cell] = math.log1p(n)
    return row / max(math.sqrt((row**2).sum()), 1e-9)


def test_trigrams():
    table = languages.trigrams(*text_buffer(pa.array(TEXTS)))
    for row, text in zip(table, TEXTS, strict=True):
        assert row == pytest.approx(plain_trigrams(text), abs=1e-6), text


def fixed_hierarchy():
    model = languages.Hierarchy.__new__(languages.Hierarchy)
    model.nodes = {"": ["germanic", "only tlh", "romance"], "germanic": ["de", "en", "nl"], "only tlh": ["tlh"], "romance": ["es", "fr"]}
    draw = np.random.default_rng(9)
    model.machines = {
        node: [(i, j, draw.normal(0, 4, languages.WIDTH + 1).astype(np.float32)) for i in range(len(m)) for j in range(i + 1, len(m))]
        for node, m in model.nodes.items()
    }
    return model


def plain_choice(model, node, row):
    members = model.nodes[node]
    if len(members) == 1:
        return 0, 1.0
    votes = [0.0] * len(members)
    for i, j, weights in model.machines[node]:
        sure = 1 / (1 + math.exp(-4 * (float(row @ weights[:-1]) + float(weights[-1]))))
        votes[i] += sure
        votes[j] += 1 - sure
    best = max(range(len(members)), key=lambda k: (votes[k], -k))
    return best, votes[best] / (len(members) - 1)


def test_family_first_then_language():
    model, rows = fixed_hierarchy(), languages.trigrams(*text_buffer(pa.array(TEXTS)))
    langs, scores = model.predict(rows)
    for row, lang, score in zip(rows, langs, scores, strict=True):
        best, share = plain_choice(model, "", row)
        name = model.nodes[""][best]
        own, inner = plain_choice(model, name, row)
        assert lang == model.nodes[name][own] and score == pytest.approx(share * inner, abs=1e-4)


def plain_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeat = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    chars = sum(map(len, words))
    letters = len(re.sub(r"[\x00-\x40\x5B-\x60\x7B-\x7F]", "", text))
    capitals = len(re.findall("[A-Z]", text))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    odd = [c for c in text if ord(c) < 0x80 and c.isprintable() and not c.isalnum() and c != " "]
    n, size = max(len(words), 1), max(len(text.encode()), 1)
    return [
        math.log1p(len(words)), chars / n, len(re.findall(r"[#*$%&|<>]", text)) / n, dup / max(len(lines), 1), len(repeat) / n,
        letters / max(chars, 1), capitals / max(letters, 1), len({w.translate(low) for w in words}) / n, len(lines) / n,
        len(odd) / size, len(re.findall("[0-9]", text)) / size, text.count("!") / n,
    ]


def test_quality_features():
    draw = random.Random(1)
    texts = TEXTS + [" ".join(draw.choice(["one", "Two", "3", "#", "é", "\n"]) for _ in range(draw.randint(0, 60))) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    table = features.quality_features(batch, *text_buffer(batch.column("text")))
    for row, text in zip(table, texts, strict=True):
        got = dict(zip(features.QUALITY, row, strict=True))
        assert got == pytest.approx(dict(zip(features.QUALITY, plain_quality(text), strict=True))), text
