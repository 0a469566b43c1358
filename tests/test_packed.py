"""Small files of closed partitions are packed; markers of minutes are written by tasks."""

import glob
import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelog.sources.files import read_partitioned_json
from tidelog.streaming import files
from tidelog.streaming.packed import PackedTable
from tidelog.streaming.sinks import PartitionedJson

SCHEMA = "n bigint, dt string, text string"


def batch(spark, number, days, rows=40):
    day = F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % len(days) + 1).cast("int"))
    return spark.range(number * rows, (number + 1) * rows, 1, 4).select(
        F.col("id").alias("n"), day.alias("dt"), F.repeat(F.lit("x"), 50).alias("text")
    )


def content(df):
    return sorted((r.n, r.dt) for r in df.collect())


def parts(folder):
    return glob.glob(f"{folder}/*.parquet")


def test_closed_partitions_have_few_files(spark, folder):
    table = PackedTable(spark, folder, SCHEMA, "dt")
    days = ["2024-01-01", "2024-01-02", None, "a/b=c d+e%"]
    for n in range(6):
        table.append(batch(spark, n, days), n)
    want = content(table.read())
    assert len(want) == 240 and {d for _, d in want} == set(days)
    counts = table.pack(lambda day: day != "2024-01-02")
    assert sorted(counts.values()) == [1, 1, 1] and content(table.read()) == want
    for name in ("dt=2024-01-01", "dt=__HIVE_DEFAULT_PARTITION__"):
        assert len(parts(f"{folder}/generations/000000000001/{name}")) == 1
    assert len(table.read().inputFiles()) < 30
    assert table.pack(lambda day: day != "2024-01-02") == {}
    table.append(batch(spark, 6, days), 6)  # late for the packed days
    want = content(table.read())
    assert len(want) == 280
    assert len(table.pack()) == 4 and content(table.read()) == want
    assert len(table.read().inputFiles()) == 4


def test_files_follow_the_bytes(spark, folder):
    table = PackedTable(spark, folder, SCHEMA, "dt", file_bytes=20_000)
    rows = batch(spark, 0, ["a", "b", "b", "b", "b", "b"], 20_000).withColumn("text", F.sha2(F.col("n").cast("string"), 256))
    table.append(rows, 0)
    size = {d: files.size_of(spark, f"{folder}/arrived/batch={0:012d}/dt={d}") for d in "ab"}
    counts = table.pack()
    assert counts == {d: -(-size[d] // 20_000) for d in "ab"} and counts["b"] > counts["a"] > 3
    for d in "ab":
        assert 1 <= len(parts(f"{folder}/generations/000000000001/dt={d}")) <= counts[d]
    assert table.read().count() == 20_000


def test_a_reader_during_the_swap_sees_one_generation(spark, folder, monkeypatch):
    table = PackedTable(spark, folder, SCHEMA, "dt")
    for n in range(3):
        table.append(batch(spark, n, ["a", "b"]), n)
    want, before = content(table.read()), table.read()
    seen = []
    real = files.rename
    monkeypatch.setattr(files, "rename", lambda *a: (seen.append(content(table.read())), real(*a)))
    table.pack()
    assert seen == [want] and content(before) == want and content(table.read()) == want
    # A packer that dies before its pointer changes nothing.
    table.append(batch(spark, 3, ["a"]), 3)
    want = content(table.read())
    monkeypatch.setattr(files, "rename", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        table.pack()
    assert content(table.read()) == want
    monkeypatch.setattr(files, "rename", real)
    table.pack()
    assert content(table.read()) == want


def test_incomplete_batches_and_replays(spark, folder):
    table = PackedTable(spark, folder, SCHEMA, "dt")
    assert table.read().collect() == [] and table.pack() == {}
    table.append(batch(spark, 0, ["a"]), 0)
    table.append(batch(spark, 0, ["a"]), 0)  # a replay
    table.append(batch(spark, 1, ["a"]), 1)
    os.remove(f"{folder}/arrived/batch={1:012d}/_SUCCESS")
    assert table.read().count() == 40
    plan = table.read().filter("dt = 'a'").select("n")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<n:bigint>" in plan


def test_many_minutes_are_marked_by_tasks(spark, folder, monkeypatch):
    """Days of minutes in one batch: the driver makes as many file calls as for one minute."""
    start = datetime(2024, 1, 1)

    def minutes(count):
        at = F.lit(start) + F.make_dt_interval(mins=F.col("id").cast("int"))
        rows = spark.range(0, count, 1, 4).withColumn("at", at).withColumn("window", F.window("at", "1 minute"))
        return rows.groupBy("window").agg(F.count("*").alias("n"))

    def columns(rows):
        named = {"dt": "yyyy-MM-dd", "hour": "HH", "minute": "mm"}
        return rows.select("n", "window", *[F.date_format("window.start", f).alias(c) for c, f in named.items()])

    calls = []
    for name in ("exists", "write_text", "read_text", "folders"):
        real = getattr(files, name)
        monkeypatch.setattr(files, name, lambda *a, real=real, name=name: calls.append(name) or real(*a))
    counts = []
    for days, place in ((1 / 1440, "one"), (2, "many")):
        calls.clear()
        sink = PartitionedJson(f"{folder}/{place}", columns, writers=1)
        sink(minutes(int(days * 1440)), 0)
        counts.append(len(calls))
        marked = glob.glob(f"{folder}/{place}/dt=*/hour=*/minute=*/_SUCCESS")
        assert len(marked) == int(days * 1440)
    assert counts[0] == counts[1]
    with open(f"{folder}/many/_newest_complete") as newest:
        assert newest.read() == "dt=2024-01-02/hour=23/minute=59"


def test_the_offset_log_has_the_watermark(spark, folder):
    """The one internal format that is read; if it changes, the sink says so."""
    stream = spark.readStream.format("rate").option("rowsPerSecond", 1).load().withWatermark("timestamp", "1 second")
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{folder}/c").start()
    try:
        while not query.recentProgress:
            query.processAllAvailable() if query.status["isDataAvailable"] else __import__("time").sleep(0.3)
    finally:
        query.stop()
    sink = PartitionedJson(folder, lambda b: b, checkpoint=f"{folder}/c")
    assert isinstance(sink._watermark(spark, 0), int)
    with pytest.raises(ValueError, match="batchWatermarkMs"):
        sink._watermark(spark, 999)
    assert timedelta(minutes=1) == sink.partition_size


def minute_rows(spark, rows):
    """So many rows in each of the minutes 0, 1, ..., as a batch of closed windows."""
    data = [(datetime(2024, 1, 1, 0, m), n) for m, count in enumerate(rows) for n in range(count)]
    return spark.createDataFrame(data, "at timestamp, n int").repartition(5)


def minute_sink(folder, **options):
    def columns(rows):
        named = {"dt": "yyyy-MM-dd", "hour": "HH", "minute": "mm"}
        parts = [F.date_format("at", f).alias(c) for c, f in named.items()]
        return rows.select(F.col("n").alias("requests"), *parts, F.window("at", "1 minute").alias("window"))

    return PartitionedJson(folder, columns, **options)


def json_files(folder):
    names = glob.glob(f"{folder}/dt=*/hour=*/minute=*/batch=*/*")
    return Counter(n.split("minute=")[1][:2] for n in names)


def test_a_minute_is_one_file_unless_it_has_many_rows(spark, folder):
    sink = minute_sink(folder, writers=3, file_rows=100)
    sink(minute_rows(spark, [30, 100, 101, 1]), 0)
    assert json_files(folder) == {"00": 1, "01": 1, "02": 3, "03": 1}
    stored = read_partitioned_json(spark, folder, "requests int, dt string, hour string, minute string")
    assert Counter(r.minute for r in stored.collect()) == {"00": 30, "01": 100, "02": 101, "03": 1}
    assert {f"{r.dt} {r.hour}" for r in stored.collect()} == {"2024-01-01 00"}


def test_a_replay_leaves_nothing_of_an_attempt_that_wrote_otherwise(spark, folder):
    rows = minute_rows(spark, [50, 300])
    minute_sink(folder)(minute_rows(spark, [2]), 0)
    minute_sink(folder, writers=7, file_rows=10)(rows, 1)
    place = f"{folder}/dt=2024-01-01/hour=00/minute=01/batch={1:012d}"
    open(f"{place}/_half", "w").close()  # of a task that died
    with open(f"{place}/part-00000-of-spark.json", "w") as f:
        f.write('{"requests": 1}\n')  # of a writer with other names
    again = minute_sink(folder)
    for _ in range(2):
        again(rows, 1)
        assert json_files(folder) == {"00": 2, "01": 1}  # batch 0 has its own
        stored = read_partitioned_json(spark, folder, "requests int, dt string, hour string, minute string")
        assert Counter(r.minute for r in stored.collect()) == {"00": 52, "01": 300}


def test_folders_are_named_as_spark_names_them(spark, folder):
    rows = spark.createDataFrame([("a/b:c", "x=%y", 1), (None, "", 2), ("Ä [d]^{e}", "q?*'\"#\\ &|<>", 3)], "p string, q string, n int")
    rows.write.partitionBy("p", "q").json(f"{folder}/spark")
    lines = rows.select("p", "q", F.to_json(F.struct("n")).alias("line"), F.lit(0).alias("share"))
    os.makedirs(f"{folder}/ours")
    assert files.write_lines(lines, f"{folder}/ours", ["p", "q"], "batch=1", "json") == 3

    def named(place, depth):
        return sorted(os.path.relpath(p, place) for p in glob.glob(f"{place}/{'/'.join(['*'] * depth)}") if os.path.isdir(p))

    assert [n.removesuffix("/batch=1") for n in named(f"{folder}/ours", 3)] == named(f"{folder}/spark", 2)


def test_days_of_minutes_are_listed_in_one_job(spark, folder):
    at = F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(mins=F.col("id").cast("int"))
    sink = minute_sink(folder)
    sink(spark.range(0, 2 * 1440, 1, 4).select(at.alias("at"), F.lit(1).alias("n")), 0)
    tracker, group = spark.sparkContext.statusTracker(), f"list {folder}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        stored = read_partitioned_json(spark, folder, "requests int, dt string, hour string, minute string")
        assert len(tracker.getJobIdsForGroup(group)) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stored.count() == 2 * 1440


def test_folders_give_the_values_that_spark_finds(spark, folder):
    """Also odd ones, read from the path of the file."""
    rows = spark.createDataFrame([("a/b c+d", "05", 1), (None, "%2F", 2), ("Ä [d]", "6", 3)], "p string, q string, n int")
    rows.write.partitionBy("p", "q").json(f"{folder}/dt=x")
    schema = "n int, p string, q string"
    found = read_partitioned_json(spark, f"{folder}/dt=x", schema, many=True)
    assert "PartitionFilters: []" in found.filter("q = '6'")._jdf.queryExecution().executedPlan().toString()
    theirs = spark.read.schema(schema).json(f"{folder}/dt=x")
    assert found.schema == theirs.schema
    assert sorted(map(str, found.collect())) == sorted(map(str, theirs.collect())) == sorted(map(str, rows.select("n", "p", "q").collect()))
    some = found.filter("p = 'Ä [d]'")
    assert [r.n for r in some.collect()] == [3]
    assert read_partitioned_json(spark, f"{folder}/dt=x", "n int, q bigint", many=True).filter("n = 3").first().q == 6
