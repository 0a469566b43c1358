"""Documents with letters stay in the first stage, whatever could be learned."""

from pyspark.sql import functions as F
from tidelog.llm import languages

ROWS = [(i, f"the of and ing tion {i}", "en") for i in range(40)] + [(50 + i, f"zzyzx qq {i}", "und") for i in range(40)]
BARE = [(100, None, "en"), (101, "", "en"), (102, "1234 !!", "und")]


def kept(df):
    return sorted(r.doc_id for r in languages.keep_known(df).collect())


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame(ROWS + BARE, "doc_id bigint, text string, lang string")
    assert kept(df.withColumn("lang", F.lit(None).cast("string"))) == sorted(r[0] for r in ROWS)


def test_und_is_a_language(spark):
    df = spark.createDataFrame(ROWS + BARE, "doc_id bigint, text string, lang string")
    assert "und" in {r.lang_pred for r in languages.identify(df).collect() if r.doc_id < 100}
    assert kept(df) == sorted(r[0] for r in ROWS)


def test_missing_languages_are_predicted(spark):
    rows = [(i, f"the of and ing tion {i}", "en" if i % 4 else None) for i in range(60)]
    rows += [(100 + i, f"der und keit ung ß {i}", "de" if i % 4 else None) for i in range(60)] + BARE
    rows += rows[:9]  # repeated
    names = ["__letter", "__lang", "__score", "__known", "c0"]
    df = spark.createDataFrame([(*r, *[f"{k}{r[0]}" for k in range(5)]) for r in rows], "doc_id bigint, text string, lang string, " + ", ".join(f"`{n}` string" for n in names))
    found = languages.keep_known(df)
    assert found.dtypes == df.dtypes
    got = found.collect()
    assert len(got) == 129 and all(r.lang == ("en" if r.doc_id < 100 else "de") for r in got)
    assert all(tuple(r)[3:] == tuple(f"{k}{r.doc_id}" for k in range(5)) for r in got)
    assert languages.keep_known(df.limit(0)).collect() == []
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang for r in languages.keep_known(bare).collect()} == {None}


def test_sample_does_not_depend_on_copies(spark):
    """A row repeated ten thousand times is one text of the sample, so the model stays."""
    rows = [(i, f"the of and ing tion {i}", "en") for i in range(30)] + [(50 + i, f"der und keit {i}", "de") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    hot = df.unionByName(spark.range(10_000).selectExpr("7L as doc_id", "'the of and ing tion 7' as text", "'en' as lang"))
    one, other = languages.fit(df), languages.fit(hot.repartition(5))
    for node, machines in one.machines.items():
        assert all((a[2] == b[2]).all() for a, b in zip(machines, other.machines[node], strict=True))


def test_rare_values_of_lang(spark, monkeypatch):
    monkeypatch.setattr(languages, "LANGUAGES", 2)
    rows = [(i, f"the of and {i}", ["en", "de", f"odd{i}"][i % 3]) for i in range(90)]
    model = languages.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert sorted(sum((m for n, m in model.nodes.items() if n), [])) == ["de", "en"]
