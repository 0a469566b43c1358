"""Watermarks of topic partitions, and late rows beside the others."""

import json
import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelog.operators.windows import slowest_watermark
from tidelog.plans import logs, streams
from tidelog.sources import rebuilt, topics
from tidelog.sources.topics import RECORD_SCHEMA, Topic, json_rows, record_partitions, recorded_partitions, recorded_topic
from tidelog.streaming import late
from tidelog.streaming.run import LateRowsError, ServiceRun, run_to_end

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)
SCHEMA = "at timestamp, part int, n int"


def dated(folder):
    """Files get their times by name, so that a limit of files takes them in this order."""
    for here, _, names in os.walk(folder):
        for n, name in enumerate(sorted(names)):
            os.utime(os.path.join(here, name), (1_700_000_000 + 10 * n,) * 2)


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def lagging(spark, partitions=2):
    events = spark.read.parquet(f"{SF}/events.parquet")
    return rebuilt.lagging_records(events, partitions)


def test_a_lagging_partition_loses_nothing(spark, folder):
    """Two partitions, one a day behind, a file of each per batch: the batch result."""
    record_partitions(lagging(spark), f"{folder}/topic", files=6)
    dated(f"{folder}/topic")
    parts = [json_rows(p, rebuilt.LOG_JSON) for p in recorded_partitions(spark, f"{folder}/topic", [0, 1], max_files=1)]
    run = streams.slowest_browser_counts(parts, folder)
    run.awaitTermination()
    assert run.late_rows == 0 and len(os.listdir(f"{folder}/checkpoint/commits")) > 6
    lines = json_rows(lagging(spark), rebuilt.LOG_JSON, keep=("partition",))
    latest = lines.groupBy("partition").agg(F.max("log_time").alias("t")).agg(F.min("t")).first()[0]
    batch = logs.browser_counts(lines, "1 hour").filter(F.col("window.end") <= F.lit(latest - timedelta(seconds=15)))
    found = spark.read.parquet(f"{folder}/data").select("browser", "window_start", "cnt_browser")
    assert rows(found) == rows(batch.select("browser", "window.start", "cnt_browser")) and found.count() > 100


def test_a_recorded_topic_is_sorted_by_many_tasks(spark, folder, monkeypatch):
    """Its files grow in number with its records, not in size."""
    monkeypatch.setattr(topics, "FILE_ROWS", 100)
    records = lagging(spark).filter("offset < 450")
    record_partitions(records, f"{folder}/topic")
    sizes, found = [], spark.read.schema(RECORD_SCHEMA).parquet(f"{folder}/topic")
    for part in (0, 1):
        at = f"{folder}/topic/partition={part}"
        sizes += [spark.read.parquet(f"{at}/{n}").count() for n in os.listdir(at) if n.endswith(".parquet")]
    assert len(sizes) >= 14 and max(sizes) <= 200 and sum(sizes) == 900
    assert rows(found.select("partition", "offset", "value")) == rows(records.select("partition", "offset", "value"))
    ranges = found.groupBy(F.input_file_name(), "partition").agg(F.min("offset").alias("a"), F.max("offset").alias("b")).collect()
    ends = {p: sorted((r.a, r.b) for r in ranges if r.partition == p) for p in (0, 1)}
    assert all(x[1] < y[0] for p in ends for x, y in zip(ends[p], ends[p][1:]))


def test_one_stream_over_both_partitions_is_refused(spark, folder):
    records = lagging(spark)
    for n in range(6):  # the files of both partitions, by turns
        for p in (0, 1):
            step = records.filter((F.col("partition") == p) & (F.floor(F.col("offset") * 6 / 500) == n))
            step.coalesce(1).write.mode("append").parquet(f"{folder}/topic")
            for name in os.listdir(f"{folder}/topic"):
                path = f"{folder}/topic/{name}"
                if os.path.getmtime(path) > 1_700_010_000:
                    os.utime(path, (1_700_000_000 + 20 * n + 10 * p,) * 2)
    lines = json_rows(recorded_topic(spark, f"{folder}/topic", max_files=1), rebuilt.LOG_JSON)
    with pytest.raises(LateRowsError):
        streams.slowest_browser_counts([lines], folder).awaitTermination()


def test_a_silent_partition_holds_windows_open(spark, folder):
    record_partitions(lagging(spark).filter("partition = 0"), f"{folder}/topic")
    os.makedirs(f"{folder}/topic/partition=1")
    parts = [json_rows(p, rebuilt.LOG_JSON) for p in recorded_partitions(spark, f"{folder}/topic", [0, 1])]
    streams.slowest_browser_counts(parts, folder).awaitTermination()
    assert spark.read.parquet(f"{folder}/data").count() == 0


def test_only_the_least_watermark_will_do(spark):
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "max")
    try:
        with pytest.raises(ValueError, match="has to be min"):
            slowest_watermark([spark.range(1)], "id", "1 second")
    finally:
        spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")


def test_partitions_are_assigned():
    options = Topic("logs").read_options([3])
    assert json.loads(options["assign"]) == {"logs": [3]} and "subscribe" not in options
    assert Topic("logs").read_options()["subscribe"] == "logs"


def add(spark, folder, n, lines):
    data = [(None if s is None else START + timedelta(seconds=s), p, 100 * n + k) for k, (s, p) in enumerate(lines)]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    for name in os.listdir(folder):
        if os.path.getmtime(f"{folder}/{name}") > 1_700_010_000:
            os.utime(f"{folder}/{name}", (1_700_000_000 + 10 * n,) * 2)


BATCHES = [
    [(10, 0), (130, 0), (50, 1)],
    [(5, 0), (61, 0), (119, 1), (None, 0)],
    [(90, 0), (300, 0), (20, 1)],
    [(130, 1), (200, 0), (239, 1)],
    [],
    [(500, 1), (700, 0)],
    [(499, 0), (400, 1)],
]


def plain(batches, delay, size, by_part, awaited=()):
    """Numbers of the late rows, by definition."""
    found, latest, mark = set(), {p: None for p in awaited}, None
    for n, lines in enumerate(batches):
        for k, (s, _) in enumerate(lines):
            if s is not None and mark is not None and (s // size * size + size <= mark if size else s < mark):
                found.add(100 * n + k)
        for s, p in lines:
            key = p if by_part else 0
            if s is not None:
                latest[key] = max(s, latest.get(key) or s)
        if latest and None not in latest.values():
            mark = max(min(latest.values()) - delay, mark if mark is not None else min(latest.values()) - delay)
    return found


@pytest.mark.parametrize(("size", "by_part"), [(None, False), (60, False), (60, True), (None, True)])
def test_the_gate_parts_late_rows(spark, folder, size, by_part):
    for n, lines in enumerate(BATCHES):
        add(spark, f"{folder}/in", n, [(s, p) for s, p in lines])
    gate = late.LateGate(
        f"{folder}/rows", "at", "15 seconds", size and f"{size} seconds", *(("part", (0, 1)) if by_part else ())
    )
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    failed = []

    def fails(batch, batch_id):
        gate(batch, batch_id)
        if batch_id in (1, 4) and batch_id not in failed:  # published, but never committed
            failed.append(batch_id)
            raise RuntimeError("lost")

    for _ in range(2):
        with pytest.raises(Exception):
            run_to_end(stream, f"{folder}/checkpoint", each_batch=fails)
    run_to_end(stream, f"{folder}/checkpoint", each_batch=fails)
    side = [r.n for r in late.late_rows(spark, f"{folder}/rows", SCHEMA).collect()]
    kept = [r.n for r in spark.read.parquet(f"{folder}/rows/kept").collect()]
    assert sorted(side) == sorted(plain(BATCHES, 15, size, by_part, (0, 1) if by_part else ())) != []
    assert sorted(side + kept) == [100 * n + k for n, lines in enumerate(BATCHES) for k in range(len(lines))]


def test_a_replay_before_the_batch_was_visible(spark, folder, monkeypatch):
    """An attempt that dies between its files and their new name leaves nothing behind."""
    batch = spark.createDataFrame([(START, 0, 1), (START + timedelta(hours=1), 0, 2)], SCHEMA)
    old = spark.createDataFrame([(START, 0, 3), (START + timedelta(hours=2), 0, 4)], SCHEMA)
    gate = late.LateGate(folder, "at", "15 seconds", "1 minute")
    gate(batch, 0)
    real, calls = late.files.rename, []

    def dies(session, a, b):
        calls.append(b)
        if "kept" in b and len(calls) < 3:
            raise OSError("gone")
        real(session, a, b)

    monkeypatch.setattr(late.files, "rename", dies)
    with pytest.raises(OSError):
        gate(old, 1)
    gate(old, 1)
    assert [r.n for r in late.late_rows(spark, folder, SCHEMA).collect()] == [3]
    assert sorted(r.n for r in spark.read.parquet(f"{folder}/kept").collect()) == [1, 2, 4]


def test_a_lost_watermark_ends_the_job(spark, folder):
    gate = late.LateGate(folder, "at", "15 seconds")
    with pytest.raises(FileNotFoundError, match="no watermark of batch 4"):
        gate(spark.createDataFrame([(START, 0, 1)], SCHEMA), 5)


def test_services_report_late_rows(spark, folder):
    """The listener is there on interval runs too, and goes when the query ends, though nobody waits."""
    for n, lines in enumerate([[(600, 0)], [(700, 0)], [(5, 0)], [(800, 0)]]):
        add(spark, f"{folder}/in", n, lines)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    counts = stream.withWatermark("at", "0 seconds").groupBy(F.window("at", "1 minute")).count()
    count = lambda: len(spark._jsparkSession.streams().listListeners())
    before = count()
    run = streams.start(counts, f"{folder}/checkpoint", path=f"{folder}/out", interval="1 second")
    assert isinstance(run, ServiceRun)
    until = time.time() + 60
    while run.late_rows == 0 and time.time() < until:
        time.sleep(0.5)
    assert run.late_rows == 1
    run.stop()
    until = time.time() + 30
    while count() > before and time.time() < until:
        time.sleep(0.5)
    assert count() == before and not run.isActive
