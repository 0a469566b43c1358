import json
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidelog.operators.debezium import (
    METADATA,
    append_log,
    changelog,
    decode,
    split_errors,
    split_schema_changes,
    to_debezium_json,
)
from tidelog.plans import feeds

TABLE = "id int, num int"
SOURCE = {"db": "test", "table": "test", "schema": None, "ts_ms": 995}


def message(op, before=None, after=None, **extra):
    body = {"before": before, "after": after, "op": op, "ts_ms": 1000, "source": SOURCE}
    return json.dumps({k: v for k, v in {**body, **extra}.items() if v != "drop"})


def row(i, n):
    return {"id": i, "num": n}


def topic(spark, *values):
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "offset bigint, value string")


def judged(spark, value, **options):
    found = decode(topic(spark, value), TABLE, ["source.timestamp"], **options).collect()
    return [(r.decode_error, r.bad_fields) for r in found]


# Messages and what each is judged to be; tombstones give nothing.
CASES = [
    (None, None),
    ("", None),
    ("{bad", ("malformed message", True)),
    ("null", ("malformed message", True)),
    ("[]", ("malformed message", True)),
    (" ", ("malformed message", True)),
    (message("t", after=row(1, 2)), ("unknown op", False)),
    (message("drop", after=row(1, 2)), ("no op", False)),
    (message("u", after=row(1, 2)), ("no before image", False)),
    (message("d"), ("no before image", False)),
    (message("c"), ("no after image", False)),
    (message("u", before=row(1, 1)), ("no after image", False)),
    (message("r"), (None, False)),
    (message("c", after=row(1, "x")), (None, True)),
    (
        message("c", after=row(1, 2), source={"ts_ms": "soon"}),
        ("source.ts_ms is not a number", False),
    ),
    (message("r", after=row(1, 2), source={"ts_ms": "soon"}), (None, False)),
    (message("c", after=row(1, 2)), (None, False)),
    (message("c", after=row(1, 2), source="drop"), (None, False)),
]


def wrap(value):
    if value and value.startswith('{"'):
        return json.dumps({"schema": None, "payload": json.loads(value)})
    return value


@pytest.mark.parametrize("wrapped", [False, True])
def test_every_kind_of_message(spark, wrapped):
    values = [wrap(v) if wrapped else v for v, _ in CASES]
    found = decode(topic(spark, *values), TABLE, ["source.timestamp"], wrapped=wrapped)
    judgements = {r.offset: (r.decode_error, r.bad_fields) for r in found.collect()}
    for offset, (value, expected) in enumerate(CASES):
        assert judgements.get(offset) == expected, value


def test_wrapped_message_without_payload(spark):
    assert judged(spark, '{"payload":null}', wrapped=True) == [("no payload", False)]
    assert judged(spark, "{}", wrapped=True) == [("no payload", False)]


def test_snapshot_needs_a_row_only_in_the_changelog(spark):
    found = decode(topic(spark, message("r")), TABLE, insert_snapshots=True).first()
    assert found.decode_error == "no after image"


def test_append_log_rules(spark):
    log = append_log(
        topic(
            spark,
            message("c", after=row(1, 10)),
            message("r", after=row(2, 20)),
            message("u", before=row(1, 10), after=row(1, 11)),
            message("d", before=row(1, 11)),
            None,
        ),
        TABLE,
        ["op"],
        keep=["offset"],
    )
    assert log.columns == ["offset", "id", "num", "op"]
    assert sorted(map(tuple, log.collect())) == [
        (0, 1, 10, "c"), (2, 1, 11, "u"), (3, 1, 11, "d")
    ]


def test_append_log_without_metadata_is_the_row(spark):
    log = append_log(topic(spark, message("c", after=row(1, None))), TABLE)
    assert [tuple(r) for r in log.collect()] == [(1, None)]


@pytest.mark.parametrize(
    "value", ["{bad", message("t", after=row(1, 2)), message("u", after=row(1, 2)),
              message("c", after=row(1, "x")), message("c")],
)
def test_fail_stops_and_skip_goes_on(spark, value):
    messages = topic(spark, message("c", after=row(5, 5)), value)
    with pytest.raises(PySparkException, match="Corrupt change message"):
        append_log(messages, TABLE, keep=["offset"]).collect()
    # The check must hold even when no column of the row is used.
    with pytest.raises(PySparkException, match="Corrupt change message"):
        append_log(messages, TABLE).count()
    kept = append_log(messages, TABLE, on_error="skip").collect()
    assert (5, 5) in [tuple(r) for r in kept]
    assert len(kept) == (2 if '"x"' in value else 1)


def test_side_output_keeps_bad_messages(spark):
    decoded = decode(topic(spark, message("c", after=row(1, 2)), "{bad"), TABLE)
    good, bad = split_errors(decoded)
    assert [r.offset for r in good.collect()] == [0]
    assert [(r.offset, r.value) for r in bad.collect()] == [(1, "{bad")]


def test_all_metadata(spark):
    wrapped = json.dumps(
        {"schema": {"type": "struct"}, "payload": json.loads(message("c", after=row(1, 2)))}
    )
    log = append_log(topic(spark, wrapped), TABLE, list(METADATA), wrapped=True)
    got = log.first().asDict()
    assert json.loads(got["schema"]) == {"type": "struct"}
    assert got["op"] == "c"
    assert got["ingestion_timestamp"] == datetime(1970, 1, 1, 0, 0, 1)
    assert got["source_timestamp"] == datetime(1970, 1, 1, 0, 0, 0, 995000)
    assert (got["source_database"], got["source_schema"], got["source_table"]) == (
        "test", None, "test"
    )
    assert got["source_properties"] == {
        "db": "test", "table": "test", "schema": None, "ts_ms": "995"
    }


def test_schema_sits_at_the_root_of_a_plain_message(spark):
    log = append_log(
        topic(spark, message("c", after=row(1, 2), schema="v1")), TABLE, ["schema"]
    )
    assert log.first()["schema"] == "v1"


def test_missing_source_gives_null_metadata(spark):
    log = append_log(
        topic(spark, message("c", after=row(1, 2), source="drop", ts_ms="drop")),
        TABLE,
        ["source.timestamp", "source.database", "source.properties", "ingestion-timestamp"],
    )
    assert tuple(log.first())[2:] == (None, None, None, None)


def test_unknown_metadata_is_refused(spark):
    with pytest.raises(ValueError, match="unknown metadata"):
        decode(topic(spark, "{}"), TABLE, ["source.host"])


def test_schema_can_come_from_the_target_table(spark, folder):
    spark.sql(f"CREATE TABLE target_rows (id int NOT NULL, num int) USING parquet LOCATION '{folder}/t'")
    schema = spark.table("target_rows").schema
    log = append_log(topic(spark, message("c", after=row(1, 2))), schema)
    assert [tuple(r) for r in log.collect()] == [(1, 2)]


def test_only_needed_fields_are_parsed(spark):
    log = append_log(topic(spark, message("c", after=row(1, 2))), TABLE, ["op"])
    plan = log._jdf.queryExecution().optimizedPlan().toString()
    assert "source" not in plan and "ts_ms" not in plan


def test_changelog_kinds(spark):
    changes = changelog(
        topic(
            spark,
            message("r", after=row(1, 1)),
            message("u", before=row(1, 1), after=row(1, 2)),
            message("d", before=row(1, 2)),
            message("c", after=row(1, 3)),
        ),
        TABLE,
    )
    assert [tuple(r) for r in changes.orderBy("seq").collect()] == [
        (1, "+I", 1, 1), (2, "-U", 1, 1), (3, "+U", 1, 2), (4, "-D", 1, 2), (7, "+I", 1, 3)
    ]


def test_changelog_to_messages_and_back(spark):
    changes = changelog(
        topic(spark, message("c", after=row(1, None)),
              message("u", before=row(1, None), after=row(1, 2))),
        TABLE,
    )
    sent = changes.select(
        F.col("seq").alias("offset"), to_debezium_json(changes, ["id", "num"]).alias("value")
    )
    assert [r.value for r in sent.orderBy("offset").collect()] == [
        '{"before":null,"after":{"id":1,"num":null},"op":"c"}',
        '{"before":{"id":1,"num":null},"after":null,"op":"d"}',
        '{"before":null,"after":{"id":1,"num":2},"op":"c"}',
    ]
    back = changelog(sent, TABLE).orderBy("seq")
    assert [(r.kind, r.num) for r in back.collect()] == [("+I", None), ("-D", None), ("+I", 2)]


def test_schema_changes_go_to_a_side_output(spark):
    ddl = json.dumps({"source": SOURCE, "historyRecord": "{\"ddl\":\"ALTER TABLE t\"}"})
    rows, schema_changes = split_schema_changes(
        topic(spark, message("c", after=row(1, 2)), ddl, "{bad", None)
    )
    assert sorted(r.offset for r in rows.collect()) == [0, 2, 3]
    assert [r.offset for r in schema_changes.collect()] == [1]


def test_append_rows_in_a_zone(spark):
    messages = topic(spark, message("c", after=row(1, 2)))
    here = feeds.append_rows(messages, zone="Asia/Shanghai").first()
    assert tuple(here) == (1, 2, "c", datetime(1970, 1, 1, 8, 0, 1))


@pytest.mark.parametrize("on_error", ["fail", "skip"])
def test_each_message_is_parsed_once(spark, on_error):
    messages = topic(spark, message("c", after=row(1, 2)))
    jobs = [
        append_log(messages, TABLE, ["op", "source.timestamp"], on_error=on_error),
        changelog(messages, TABLE, ["source.timestamp"], on_error=on_error),
        split_errors(decode(messages, TABLE, ["op"]))[0],
        append_log(messages, TABLE, ["op"], on_error=on_error).where("num > 1"),
    ]
    for job in jobs:
        plan = job._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1
