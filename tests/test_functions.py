from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidelog.functions import (
    browser,
    epoch_millis,
    instant,
    json_string,
    map_value,
    millis_to_ntz,
    regexp_first,
    similar_to,
    to_millis,
    wall_clock,
    words,
)
from tidelog.functions.text import similar_to_regex


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def results(df, expression):
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


@pytest.mark.parametrize(
    "pattern, accepted, refused",
    [
        ("4[0-9][0-9]", ["404"], ["1404", "4040", "404\n", "40", "", "500"]),
        ("a%c", ["ac", "abc", "a\nc"], ["abcd", "xac"]),
        ("a_c", ["abc", "a\nc"], ["ac", "abbc"]),
        ("a.c", ["a.c"], ["abc"]),
        ("(GET|PUT) /x+", ["GET /x", "PUT /xxx"], ["GET /", "POST /x"]),
        ("[_%]", ["_", "%"], ["a"]),
        ("$5^", ["$5^"], ["5"]),
    ],
)
def test_similar_to_matches_whole_strings(spark, pattern, accepted, refused):
    df = column(spark, accepted + refused)
    expected = [True] * len(accepted) + [False] * len(refused)
    assert results(df, similar_to("v", pattern)) == expected


def test_similar_to_drops_null_in_a_filter(spark):
    df = column(spark, ["404", None])
    assert df.where(similar_to("v", "4[0-9][0-9]")).count() == 1
    with pytest.raises(ValueError):
        similar_to_regex("4[0-9")


def test_first_match_is_null_when_there_is_none(spark):
    df = column(spark, ["Mozilla/5.0", "///", "", None, "/x", "curl"])
    assert results(df, browser("v")) == ["Mozilla", None, None, None, "x", "curl"]
    assert results(df, regexp_first("v", "[0-9]+")) == ["5", None, None, None, None, None]


def expected_words(line):
    if line is None:
        return None
    if line == "":
        return [""]
    parts = line.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_words_of_edge_lines(spark):
    lines = ["", "   ", " a", "a  b ", "a", "a b", None, "\ta ", " "]
    assert results(column(spark, lines), words("v")) == [expected_words(v) for v in lines]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab \t", max_size=8), min_size=1, max_size=40))
def test_words_of_any_line(spark, lines):
    assert results(column(spark, lines), words("v")) == [expected_words(v) for v in lines]


def test_json_string_messages(spark):
    good = ['"abc"', '"a\\nb"', "12", " 1.50 ", "true", None, "null"]
    read = ["abc", "a\nb", "12", "1.50", "true", None, None]
    assert results(column(spark, good), json_string("v")) == read
    for bad in ("{bad", "", '{"a":1}', "[1]", '"cut'):
        df = column(spark, [bad])
        assert results(df, json_string("v", "skip")) == [None]
        with pytest.raises(Exception, match="JSON string"):
            results(df, json_string("v"))


def test_times(spark):
    df = column(spark, ["2024-01-01 10:00:00.123456"]).withColumn(
        "t", F.col("v").cast("timestamp_ntz")
    )
    cut = datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert results(df, to_millis("t")) == [cut]
    assert results(df, epoch_millis("t")) == [1704103200123]
    assert results(df, millis_to_ntz(epoch_millis("t"))) == [cut]
    assert results(df, millis_to_ntz(epoch_millis("t"), "Asia/Shanghai")) == [
        cut.replace(hour=18)
    ]
    assert results(df, wall_clock(instant("t"))) == [cut.replace(microsecond=123456)]
    assert results(df, F.unix_millis(instant("t"))) == [1704103200123]


def test_map_lookup(spark):
    df = column(spark, [{"db": "x"}, {"a": None}, None], "map<string,string>")
    assert results(df, map_value("v", "db")) == ["x", None, None]
    assert results(df, map_value("v", "a")) == [None, None, None]
