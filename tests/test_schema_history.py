"""Row types in force: which columns are read, by which type, from which offset on."""

import json

import pytest

from tidelog.operators.debezium import changes_of, split_errors
from tidelog.operators.schema_history import decode_as_of

FIRST = {"id": "INT", "num": "INT"}
TARGET = "id bigint, num string, note string, day date"


def schema(*columns):
    change = {"type": "ALTER", "table": {"columns": [{"name": n, "typeName": t} for n, t in columns]}}
    return {"ddl": "ALTER TABLE test", "tableChanges": [{"type": "CREATE", "table": {"columns": []}}, change]}


def change(op, before=None, after=None):
    return {"op": op, "before": before, "after": after}


def feed(spark, *messages, partitions=None):
    rows = [
        (n, (partitions or {}).get(n, 0), None if m is None else m if isinstance(m, str) else json.dumps(m))
        for n, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, "offset bigint, partition int, value string").repartition(3)


def images(decoded):
    rows = decoded.orderBy("offset").select("offset", "schema_version", "change.after", "bad_fields").collect()
    return [(r.offset, r.schema_version, tuple(r.after) if r.after else None, r.bad_fields) for r in rows]


ROW = {"id": 1, "num": "007", "note": "x", "day": "2024-02-03"}


@pytest.mark.parametrize("hot_rows", [1 << 20, 2])
def test_columns_and_types_in_force(spark, hot_rows):
    messages = feed(
        spark,
        change("c", after=ROW),
        schema(("id", "INT UNSIGNED"), ("num", "varchar(20)"), ("note", "TEXT")),
        change("c", after=ROW),
        None, "",
        change("c", after={"id": 2}),
        schema(("id", "BIGINT"), ("day", "DATE"), ("other", "INT")),
        schema(("id", "BIGINT"), ("num", "DECIMAL(10,2)"), ("day", "DATE")),
        change("c", after=ROW),
    )
    found = images(decode_as_of(messages, TARGET, FIRST, hot_rows=hot_rows))
    day = __import__("datetime").date(2024, 2, 3)
    assert found == [
        (0, 0, (1, "7", None, None), False),
        (2, 1, (1, "007", "x", None), False),
        (5, 1, (2, None, None, None), False),
        (8, 3, (1, "7.0000000000", None, day), False),
    ]


def test_partitions_have_histories_of_their_own(spark):
    messages = feed(
        spark,
        schema(("id", "INT"), ("num", "VARCHAR(9)")), change("c", after=ROW), change("c", after=ROW),
        partitions={0: 0, 1: 0, 2: 1},
    )
    found = images(decode_as_of(messages, TARGET, FIRST, partition="partition"))
    assert [(r[1], r[2][1]) for r in found] == [(1, "007"), (0, "7")]


def test_values_that_do_not_fit(spark):
    messages = feed(
        spark,
        change("c", after={"id": "word", "num": 1}), change("c", after={"id": 5_000_000_000, "num": 1}),
        schema(("id", "BIGINT"), ("num", "GEOMETRY")),
        change("c", after={"id": 5_000_000_000, "num": "any"}), change("u", after=ROW), "{bad", change("t", after=ROW), change("r", after=ROW),
    )
    decoded = decode_as_of(messages, TARGET, FIRST)
    good, bad = split_errors(decoded)
    assert [(r[0], r[3]) for r in images(good)] == [(0, True), (1, True), (3, False), (7, False)]
    assert {r.offset: r.decode_error for r in bad.collect()} == {4: "no before image", 5: "malformed message", 6: "unknown op"}
    assert [tuple(r) for r in changes_of(decoded, on_error="skip").select("seq", "id", "num").orderBy("seq").collect()] == [
        (1, None, "1"), (3, None, "1"), (7, 5_000_000_000, "any"), (15, 1, "007"),
    ]
    with pytest.raises(Exception, match="Corrupt change message"):
        changes_of(decoded).collect()


def test_wrapped_messages_and_an_empty_feed(spark):
    inner = [schema(("id", "INT"), ("note", "CHAR(1)")), change("c", after=ROW)]
    messages = feed(spark, *[{"schema": "v1", "payload": m} for m in inner])
    found = images(decode_as_of(messages, TARGET, FIRST, wrapped=True))
    assert found == [(1, 1, (1, None, "x", None), False)]
    assert decode_as_of(messages.limit(0), TARGET, FIRST).collect() == []


def test_messages_are_parsed_once(spark):
    messages = feed(spark, change("c", after=ROW))
    plan = decode_as_of(messages, TARGET, FIRST)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan  # it lies before what was stored
