"""The trie's scores against a plain PPM coder that walks a dictionary of contexts."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidelog.llm import ppm, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Plain:
    """Update exclusion (a shorter context learns what the longer one hadn't seen), escapes of method D."""

    def __init__(self, texts, order=4):
        self.order, self.followers = order, defaultdict(Counter)
        for text in texts:
            data = b"\xff" * 4 + text.encode().lower() + b"\xff"
            for i in range(4, len(data)):
                for k in range(order, -1, -1):
                    own = self.followers[data[i - k : i]]
                    own[data[i]] += 1
                    if own[data[i]] > 1:
                        break

    def symbol(self, context, s):
        excluded, p = set(), 1.0
        for k in range(self.order, -1, -1):
            own = {a: c for a, c in self.followers.get(context[4 - k :], {}).items() if a not in excluded}
            if not own:
                continue
            whole = 2 * sum(own.values())
            if s in own:
                return p * (2 * own[s] - 1) / whole
            p *= len(own) / whole
            excluded |= set(own)
        return p / (256 - len(excluded))

    def score(self, text):
        data = b"\xff" * 4 + text.encode().lower() + b"\xff"
        return sum(math.log10(self.symbol(data[i - 4 : i], data[i])) for i in range(4, len(data)))


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text)) + [None]


def check(docs, rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    known = [t or "" for i, t in docs if not held[i]]
    model, counts = Plain(known), Counter(w for t in known for w in split(t))
    total, distinct = sum(counts.values()), len(counts)
    want = []
    for i, t in docs:
        own = split(t or "")
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        want.append((i, held[i], len(own), sum(counts[w] > 0 for w in own), total, base, model.score(t or "")))
    key = lambda r: tuple((x is None, x or 0) for x in r)
    rows, want = sorted(map(tuple, rows), key=key), sorted(want, key=key)
    assert [r[:5] for r in rows] == [r[:5] for r in want]
    for got, expected in zip(rows, want):
        assert got[5:] == pytest.approx(expected[5:], rel=1e-9)


def test_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(ppm, "CHUNK_BYTES", 400)
    texts = ["the cat sat on the mat", "The dog", None, "", "été ü 😀", "x" * 3000, "the the the", " \n", "zq\x00\x7f"]
    docs = [(i, texts[i % len(texts)]) for i in range(60)] + [(None, "no id"), (1, "The dog"), (9999, "unseen kjhw")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as score", "'k' as chunk")
    check(docs, ppm.held_out_scores(df).collect())
    assert ppm.held_out_scores(df.limit(0)).collect() == []


def test_nothing_to_learn_from(spark):
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    docs = [(i, "some text") for i in ids]
    rows = ppm.held_out_scores(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in rows)
    assert all(r.score == pytest.approx(-10 * math.log10(256)) for r in rows)


def test_probabilities_sum_to_one():
    model = Plain(["abracadabra", "abacus", "cadaver", "x"])
    for context in (b"\xff\xff\xffa", b"abra", b"zzza", b"cada", b"\xff" * 4):
        assert sum(model.symbol(context, s) for s in range(256)) == pytest.approx(1)


def test_whole_table(spark):
    docs = [tuple(r) for r in queries.read(spark, SF, "documents").select("doc_id", "text").collect()]
    rows = queries.op2_ppm_scores(spark, SF).collect()
    check(docs, rows)
    held = {r.doc_id: r for r in rows if r.held_out}
    known = [t or "" for i, t in docs if i not in held]
    for order in range(4):  # proper models of bytes, with less context
        shorter = Plain(known, order)
        assert sum(r.score for r in held.values()) > sum(shorter.score(t or "") for i, t in docs if i in held), order


def test_capitals_and_repeated_rows(spark):
    ids = [i for i in range(80) if zlib.crc32(str(i).encode()) % 7 != 2][:6]
    docs = [(i, "The Cat SAT on the mat") for i in ids] + [(ids[0], "THE cat sat ON the mat")]
    rows = ppm.held_out_scores(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()
    assert len(rows) == 7 and len({(r.score, r.base_score, r.n_known) for r in rows}) == 1
