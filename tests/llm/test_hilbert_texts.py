"""Text dimensions are told apart by their whole values."""

import numpy as np
from tidelog.llm import hilbert


def test_long_common_parts_are_told_apart(spark):
    sources = ["books"] + [f"cc-main-{year}-{week:02}" for year in (2020, 2021) for week in (4, 5, 6, 7)]
    rows = [(i, "some text", "en", sources[i % 9]) for i in range(1800)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    placed = hilbert.shard(df).select("source", "shard", "hilbert").collect()
    assert len({r.hilbert for r in placed}) == 9
    for source in sources:
        assert len({r.shard for r in placed if r.source == source}) <= 6


def test_cuts_are_the_quantiles(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "BLOCKS", 7)
    rng = np.random.default_rng(4)
    values = [None if k % 9 == 0 else f"ü{k % 5}" * (k % 4) for k in rng.integers(0, 400, 1000).tolist()]
    rows = [(v, str(i % 3)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "a string, b string")
    found = hilbert._text_cuts(df, ["a", "b"], 32)
    for at, cuts in enumerate(found):
        order = sorted((r[at] is not None, (r[at] or "").encode()) for r in rows)
        want = [order[-(-k * len(order) // 32) - 1] for k in range(1, 32)]
        assert [(c is not None, (c or "").encode()) for c in cuts] == want
    cell = dict(df.select("a", hilbert._text_cell(df.a, found[0])).distinct().collect())
    for value, number in cell.items():
        assert number == sum((c is not None, c or "") <= (value is not None, value or "") for c in found[0])
