"""Groups, links and their counts against a plain version over whole texts."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidelog.llm import align, queries
from tidelog.llm.texts import text_buffer

SF = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SIGNS = "abc deé ü  　\n\n\t  \t▁'sst019!?あ漢‍\U0001f600<|endoftext|> <s> "


class Plain:
    """Whole texts at once, by the libraries alone."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        shown = [c for c in range(256) if chr(c).isprintable() and c not in (0x20, 0xA0, 0xAD)]
        codes = {chr(c): c for c in shown}
        codes |= {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in shown)}
        self.bytes_a = {i: bytes(codes[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text):
        """Groups of ids, and links, or nothing."""
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        tokens = [[self.bytes_a[i] for i in a], [self.bytes_b(i) for i in b]]
        if any(b"".join(t) != (" " + text).encode() for t in tokens):
            return [], []
        ends = [np.cumsum([len(t) for t in side]).tolist() for side in tokens]
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            k, m = i, j
            while i < len(a) and ends[0][i] <= cut:
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                j += 1
            groups.append((a[k:i], b[m:j]))
            for x in range(k, i):
                for y in range(m, j):
                    if ends[0][x] - len(tokens[0][x]) < ends[1][y] and ends[1][y] - len(tokens[1][y]) < ends[0][x]:
                        links.append((a[x], b[y]))
        return groups, links

    def figures(self, texts):
        found = [self.align(t) for t in texts]
        docs = Counter(pair for _, links in found for pair in set(links))
        most = defaultdict(int)
        for (a, _), n in docs.items():
            most[a] = max(most[a], n)
        for groups, links in found:
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            yield (
                sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links),
                sha256(text.encode()).hexdigest() if groups else "",
            )


@pytest.fixture(scope="module")
def plain():
    return Plain()


def odd_texts():
    draw = random.Random(4)
    texts = ["", None, " ", "  ", "a", " a", "  b", "x  y", " \n y", "<0x0A>", "<|endoftext|>", "▁a", "a ▁b", "\x00 \x01", "﻿x"]
    texts += ["z" * 3000, "no space " * 400, "漢字" * 800, "\n" * 500, "a \n " * 300]
    texts += ["".join(draw.choice(SIGNS) for _ in range(draw.randint(1, 120))) for _ in range(800)]
    pick = lambda: chr(draw.choice([draw.randrange(1, 0x3000), 0x20, 0x20, draw.randrange(0xA000, 0xD7FF), draw.randrange(0xF000, 0x33000)]))
    return texts + ["".join(pick() for _ in range(60)) for _ in range(300)]


def test_groups_and_links_of_odd_texts(plain):
    texts = odd_texts()
    found = align.aligned(align._encoders(*PATHS), *text_buffer(pa.array([" " + (t or "") for t in texts])))
    codes, counts = found.links()
    data, ends = found.written()
    begin = at = 0
    for text, end, count, n_groups in zip(texts, ends.tolist(), counts.tolist(), found.counts_groups.tolist(), strict=True):
        groups, links = plain.align(text)
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert bytes(memoryview(data)[begin : max(end - 1, begin)]).decode() == written, text
        assert sorted(codes[at : at + count].tolist()) == sorted(a << 16 | b for a, b in links) and n_groups == len(groups)
        begin, at = end, at + count


def test_division_finds_all_cuts():
    draw = np.random.default_rng(2)
    for size, share in ((1, 0.5), (5000, 0.5), (5000, 0.02), (5000, 0.98)):
        ends = [np.flatnonzero(np.append(draw.random(size) < s, True)) + 1 for s in (share, 0.5)]
        padded = [np.concatenate([[0], e]) for e in ends]
        spans = np.array([[0, len(ends[0]), 0, len(ends[1])]])
        cuts_a, cuts_b = align.common_ends(*padded, spans)
        want = np.intersect1d(*ends)
        assert padded[0][cuts_a].tolist() == padded[1][cuts_b].tolist() == want.tolist()
    none = align.common_ends(np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((0, 4), np.int64))
    assert [len(x) for x in none] == [0, 0]


def test_forgotten_segments(plain, monkeypatch):
    monkeypatch.setattr(align, "KEPT", 5)
    encoders = align.Encoders(*PATHS)
    for text in ("one two three four five six seven", "seven six five", "eight one two"):
        found = align.aligned(encoders, *text_buffer(pa.array([" " + text])))
        assert found.a.tolist() == plain.a.encode(" " + text).ids and found.b.tolist() == plain.b.encode(text)


def test_whole_table(spark, plain, monkeypatch):
    """Several chunks give the counts of the whole corpus."""
    monkeypatch.setattr(align, "CHUNK_BYTES", 1 << 16)
    docs = queries.read(spark, SF, "documents").collect()
    want = sorted((d.doc_id, *f) for d, f in zip(docs, plain.figures([d.text for d in docs]), strict=True))
    got = queries.op11_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows(spark, plain):
    texts = [*odd_texts()[:40], "same text", "same text"]
    rows = [(None if i == 3 else i // 2, t, None, i, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_a string, chunk int, code string").repartition(3)
    got = sorted(map(tuple, align.link_figures(df).collect()), key=str)
    assert got == sorted(((r[0], *f) for r, f in zip(rows, plain.figures(texts), strict=True)), key=str)
    assert align.link_figures(df.limit(0)).collect() == []
    alone = align.link_figures(df.filter("text IS NULL OR text = ''")).collect()
    assert {tuple(r)[1:] for r in alone} == {(0, 0, 0, 0, 0, 0, "")}
    pairs = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in align.groups(df.filter("chunk % 2 = 0 AND doc_id IS NOT NULL")).collect()}
    assert pairs == {i // 2: plain.align(t)[0] for i, t in enumerate(texts) if i % 2 == 0}
