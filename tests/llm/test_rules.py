"""The rule ledger against plain Python."""

import re
from collections import Counter

from tidelog.llm import queries, rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            hit |= set(range(i, i + 8))
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit), failed


def test_whole_table(spark):
    docs = {r.doc_id: r.text for r in queries.read(spark, SF, "documents").collect()}
    rows = queries.op6_rule_ledger(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(docs[r.doc_id])
        assert not (r.kept and r.base_failed)
    assert 0.5 < sum(r.kept for r in rows) / len(rows) < 1


def test_odd_texts(spark):
    eight = "a b c d e f g h"
    texts = [None, "", " \n\t", "x", f"{eight} {eight}", f"{eight} a b c d e f g h a", "é\x0bö ü\n#a\n#a\n\n\n #a",
             "q " * 5000, "l\r\nl\r\nl\n", f"{eight} z {eight[:-1]}", f"{eight}\n{eight}\n{eight}", "😀 😀😀|"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(1, "")], "doc_id bigint, text string")
    df = df.selectExpr("*", "'x' as n_words", "1 as fail_bits")
    rows = rules.verdicts(df).collect()
    assert len(rows) == len(texts) + 1
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == brute(texts[r.doc_id])
    assert rules.verdicts(df.limit(0)).collect() == []


def test_policies_and_ablation(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (5,), (64,), (4,)], "fail_bits bigint")
    found = {r.rule: (r.failed, r.failed_alone) for r in rules.ablation(rows, "v2").collect()}
    assert found["too_short"] == (3, 2) and found["symbols"] == (2, 1) and found["few_letters"] == (1, 1)
    found = {r.rule: (r.failed, r.failed_alone) for r in rules.ablation(rows, "base").collect()}
    assert found == {"too_short": (3, 3), "repeated_runs": (0, 0)}
    assert rows.filter(rules.passes("base")).count() == 3
    assert all(r.failed == 0 for r in rules.ablation(rows.limit(0)).collect())
