"""Topic output by attempts that fail, read without repeats whatever their age."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidelog.sources.topics import drop_replays
from tidelog.streaming.committed import HEADER, CommittedBatches, CommittedReader, committed, entries, send_to_files
from tidelog.streaming.sinks import message_id, text_records

SCHEMA = "value string, headers array<struct<key:string,value:binary>>"


def batch(spark, first, count):
    rows = [(f"m{n}", "t", 0, n) for n in range(first, first + count)]
    messages = spark.createDataFrame(rows, "value string, topic string, partition int, offset bigint")
    return text_records(messages, message_id=["topic", "partition", "offset"])


def values(df):
    return sorted(r.value for r in df.collect())


def topic(spark, folder):
    return spark.read.schema(SCHEMA).parquet(f"{folder}/topic")


class Half:
    """A send that writes half of its records and dies, as often as told."""

    def __init__(self, path, deaths):
        self.send, self.deaths = send_to_files(path), deaths

    def __call__(self, records):
        if self.deaths:
            self.deaths -= 1
            self.send(records.filter(F.xxhash64("value") % 2 == 0))
            raise ConnectionError("lost")
        self.send(records)


def test_lost_attempts_are_never_read(spark, folder):
    sink = CommittedBatches(f"{folder}/manifest", "q", Half(f"{folder}/topic", 2))
    for _ in range(2):
        with pytest.raises(ConnectionError):
            sink(batch(spark, 0, 40), 0)
    assert committed(topic(spark, folder), f"{folder}/manifest").collect() == []
    sink(batch(spark, 0, 40), 0)
    sent = topic(spark, folder).count()
    sink(batch(spark, 0, 40), 0)  # complete: nothing is sent again
    assert topic(spark, folder).count() == sent > 40
    sink(batch(spark, 40, 5), 1)
    found = committed(topic(spark, folder), f"{folder}/manifest")
    assert values(found) == sorted(f"m{n}" for n in range(45))
    assert found.select(message_id().alias("id")).distinct().count() == 45
    assert entries(spark, f"{folder}/manifest").count() == 2


def test_a_replay_after_the_deduplication_delay(spark, folder):
    """Days later the same batch is sent again: ids within a delay let it pass, the manifest doesn't."""
    sink = CommittedBatches(f"{folder}/manifest", "q", send_to_files(f"{folder}/topic"))
    sink(batch(spark, 0, 10), 0)
    late = batch(spark, 0, 10)  # another attempt of the batch, from a writer that had hung
    header = F.array(F.struct(F.lit(HEADER).alias("key"), F.lit("q 0 other").cast("binary").alias("value")))
    reader = CommittedReader(f"{folder}/read", f"{folder}/manifest")
    reader(topic(spark, folder), 0)
    replay = late.withColumn("headers", F.concat("headers", header)).select("value", "headers")
    reader(replay, 1)
    assert values(reader.read(spark, SCHEMA)) == sorted(f"m{n}" for n in range(10))
    timed = [
        topic(spark, folder).select(message_id().alias("message_id"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at")),
        replay.select(message_id().alias("message_id"), F.lit("2024-01-05 00:00:00").cast("timestamp").alias("at")),
    ]
    others = [timed[1].limit(1).withColumn("message_id", F.lit(name)) for name in "xy"]
    for n, rows in enumerate([timed[0], *others, timed[1]]):
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/ids")
        for name in os.listdir(f"{folder}/ids"):
            if os.path.getmtime(f"{folder}/ids/{name}") > 1_700_010_000:
                os.utime(f"{folder}/ids/{name}", (1_700_000_000 + 10 * n,) * 2)
    ids = spark.readStream.schema("message_id string, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{folder}/ids")
    query = drop_replays(ids, event_time="at", delay="10 minutes").writeStream.format("parquet").option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(f"{folder}/unique")
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/unique").filter("message_id LIKE 'test%' OR message_id LIKE 't-%'").count() == 20  # the replay passes


def test_records_wait_for_their_batch(spark, folder):
    """A reader that is ahead of the manifest holds records back, and releases them once."""
    reader = CommittedReader(f"{folder}/read", f"{folder}/manifest")
    sent = []
    sink = CommittedBatches(f"{folder}/manifest", "q", sent.append)

    class Dies(Exception):
        pass

    def dies(records):
        sent.append(records)
        raise Dies

    with pytest.raises(Dies):
        CommittedBatches(f"{folder}/manifest", "q", dies)(batch(spark, 0, 4), 0)
    other = spark.createDataFrame([("plain", None)], SCHEMA)
    reader(sent[0].select("value", "headers").unionByName(other), 0)
    assert values(reader.read(spark, SCHEMA)) == ["plain"]
    sink(batch(spark, 0, 4), 0)
    for _ in range(2):  # the second is a replay of the reader
        reader(sent[1].select("value", "headers"), 1)
        assert values(reader.read(spark, SCHEMA)) == ["m0", "m1", "m2", "m3", "plain"]
    reader(spark.createDataFrame([], SCHEMA), 2)
    assert len(values(reader.read(spark, SCHEMA))) == 5


def test_of_two_writers_one_wins(spark, folder):
    """The second of two attempts at the same time finds the entry and gives way."""
    first = CommittedBatches(f"{folder}/manifest", "q", send_to_files(f"{folder}/topic"))

    def slow(records):
        send_to_files(f"{folder}/topic")(records)
        first(batch(spark, 0, 3), 0)  # meanwhile

    CommittedBatches(f"{folder}/manifest", "q", slow)(batch(spark, 0, 3), 0)
    assert topic(spark, folder).count() == 6
    assert values(committed(topic(spark, folder), f"{folder}/manifest")) == ["m0", "m1", "m2"]
    names = [n for n in os.listdir(f"{folder}/manifest") if n.endswith(".json") and not n.startswith(".")]
    with open(f"{folder}/manifest/{names[0]}") as entry:
        assert json.load(entry)["batch"] == 0 and len(names) == 1
