"""Streams over small files, one or more per micro-batch, against batch results."""

import os
from datetime import datetime, timedelta

import catalogue
import pytest
from pyspark.sql import functions as F

from tidelog.operators.windows import window_distinct, with_event_time, with_processing_time
from tidelog.plans import feeds, logs, revenue, streams
from tidelog.sources import rebuilt
from tidelog.sources.files import WAREHOUSE_SCHEMA, read_partitioned_json, text_stream
from tidelog.sources.topics import recorded_topic
from tidelog.streaming.keyed import KeyedFiles
from tidelog.streaming.retractions import RetractingSum
from tidelog.streaming.run import LateRowsError, run_to_end
from tidelog.streaming.sinks import OrderedBatches, PartitionedJson

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


def write_in_order(df, order, folder, parts):
    """Split by ``order`` into files whose times rise with it."""
    bounds = df.agg(F.min(order), F.max(order)).first()
    width = (bounds[1] - bounds[0]) // parts + 1
    for n in range(parts):
        low = bounds[0] + n * width
        piece = df.where((F.col(order) >= low) & (F.col(order) < low + width))
        piece.coalesce(1).write.mode("append").parquet(folder)
        date_new_files(folder, n)


def date_new_files(folder, n):
    """Give the files of step ``n`` their time; earlier ones already lie in the past."""
    for name in os.listdir(folder):
        path = os.path.join(folder, name)
        if os.path.getmtime(path) > 1_700_010_000:
            os.utime(path, (1_700_000_000 + 10 * n, 1_700_000_000 + 10 * n))


def events_stream(spark, folder):
    return (
        spark.readStream.schema(rebuilt.EVENTS_SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
    )


def events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def rows(df):
    return sorted(map(str, map(tuple, df.collect())))


def closed(df, latest, delay):
    return df.where(F.col("window.end") <= F.lit(latest - delay))


@pytest.fixture(scope="module", params=[1, 3, 7])
def split_events(request, spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp(f"events{request.param}") / "in")
    write_in_order(events(spark), "event_id", folder, request.param)
    return folder


def latest_log(spark):
    return rebuilt.server_logs(events(spark)).agg(F.max("log_time")).first()[0]


def test_ordered_counts_do_not_depend_on_the_split(spark, split_events, folder):
    stream = rebuilt.server_logs(events_stream(spark, split_events))
    streams.ordered_browser_counts(stream, folder, "1 hour").awaitTermination()
    batch = logs.browser_counts(rebuilt.server_logs(events(spark)), "1 hour")
    expected = logs.ordered_browser_counts(
        closed(batch, latest_log(spark), timedelta(seconds=15))
    )
    assert rows(spark.read.parquet(f"{folder}/data").drop("batch", "place")) == rows(expected)
    # Reading batch folders and files in name order gives the global order; places rise along it.
    seen, places = [], []
    for batch_dir in sorted(os.listdir(f"{folder}/data")):
        for name in sorted(os.listdir(f"{folder}/data/{batch_dir}")):
            if name.endswith(".parquet"):
                part = spark.read.parquet(f"{folder}/data/{batch_dir}/{name}").collect()
                seen += [(r.window_time, -r.cnt_browser) for r in part]
                places += [(batch_dir, r.place) for r in part]
    assert seen == sorted(seen) and len(seen) == expected.count()
    assert places == sorted(set(places))


def test_distinct_ips_do_not_depend_on_the_split(spark, split_events, folder):
    stream = rebuilt.server_logs(events_stream(spark, split_events))
    streams.distinct_ips(stream, folder, "1 day").awaitTermination()
    batch = window_distinct(
        rebuilt.server_logs(events(spark)), "log_time", "1 day", "client_ip", "n"
    )
    expected = closed(batch, latest_log(spark), timedelta(0)).select(
        "window.start", "window.end", "n"
    )
    assert rows(spark.read.parquet(f"{folder}/data")) == rows(expected)


def test_distinct_ignores_null_like_the_batch(spark, folder):
    data = [(START, None), (START, "a"), (START, "a"), (START + timedelta(hours=1), None),
            (START + timedelta(days=1), "z")]
    spark.createDataFrame(data, "t timestamp_ntz, ip string").coalesce(1).write.parquet(
        f"{folder}/in"
    )
    stream = spark.readStream.schema("t timestamp_ntz, ip string").parquet(f"{folder}/in")
    counts = window_distinct(with_event_time(stream, "t", "0 seconds"), "t", "1 hour", "ip", "n")
    run_to_end(counts, f"{folder}/checkpoint", path=f"{folder}/out")
    out = spark.read.parquet(f"{folder}/out").orderBy("window").collect()
    batch = window_distinct(spark.read.parquet(f"{folder}/in"), "t", "1 hour", "ip", "n")
    assert [r.n for r in out] == [1, 0]
    assert [r.n for r in batch.orderBy("window").collect()] == [1, 0, 1]


def test_word_counts_do_not_depend_on_the_split(spark, split_events, folder):
    lines = rebuilt.server_logs(events_stream(spark, split_events)).select(
        "request_line", "log_time"
    )
    streams.windowed_words(lines, folder, "request_line", "log_time", "6 hours").awaitTermination()
    from tidelog.operators.windows import word_counts

    batch = word_counts(
        rebuilt.server_logs(events(spark)), "request_line", "log_time", "6 hours"
    )
    expected = closed(batch, latest_log(spark), timedelta(0)).select(
        "word", "window.start", "n"
    )
    assert rows(spark.read.parquet(f"{folder}/data")) == rows(expected)


def test_counter_counts_over_batches(spark, split_events, folder):
    view = logs.browsers_view(rebuilt.server_logs(events_stream(spark, split_events)))
    streams.live_counter(view, folder).awaitTermination()
    table = KeyedFiles(spark, f"{folder}/data", ["id"])
    assert rows(table.read()) == [str((1, events(spark).count()))]


def test_retractions_over_batches_equal_the_batch(spark, folder):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    expected = rows(revenue.retractions(rebuilt.revenue_orders(orders)))
    write_in_order(orders, "o_orderkey", f"{folder}/in", 3)
    stream = (
        spark.readStream.schema(rebuilt.ORDERS_SCHEMA)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{folder}/in")
    )
    streams.revenue_retractions(rebuilt.revenue_orders(stream), folder).awaitTermination()
    found = spark.read.parquet(f"{folder}/data/changes").drop("batch")
    assert rows(found) == expected


@pytest.mark.parametrize("compact", [False, True])
def test_replayed_retraction_batch_changes_nothing(spark, folder, compact):
    sink = RetractingSum(folder, ["name"], "revenue", "order_id", "rev_sum",
                         compact=compact, compact_every=2, hot_rows=3)
    batches = [
        spark.createDataFrame(data, "order_id bigint, name string, revenue bigint")
        for data in (
            [(1, "a", 1), (2, "b", 2), (3, "a", 3)],
            [(4, "a", 4), (5, None, 5), (6, "a", 6), (7, "a", -6), (8, "a", 1)],
            [(9, "b", 9), (10, None, 1)],
        )
    ]
    outputs = []
    for batch_id, batch in enumerate(batches):
        for _ in range(2):  # the second call is the replay
            sink(batch, batch_id)
            outputs.append(rows(spark.read.parquet(f"{folder}/changes")))
    assert outputs[0] == outputs[1] and outputs[2] == outputs[3] and outputs[4] == outputs[5]
    sums = KeyedFiles(spark, f"{folder}/sums", ["name"]).read()
    assert {r["name"]: r.rev_sum for r in sums.collect()} == {"a": 9, "b": 11, None: 6}
    if not compact:
        whole = batches[0].union(batches[1]).union(batches[2])
        assert rows(spark.read.parquet(f"{folder}/changes").drop("batch")) == rows(
            revenue.retractions(whole)
        )


def feed(spark, folder, files=4):
    messages = rebuilt.debezium_messages(events(spark))
    records = rebuilt.topic_records(messages).repartitionByRange(files, F.desc("offset"))
    records.write.parquet(folder)


def test_keyed_table_from_any_file_order(spark, folder):
    feed(spark, f"{folder}/topic")
    table = KeyedFiles(spark, f"{folder}/data", ["id"])
    records = recorded_topic(spark, f"{folder}/topic", max_files=1)
    streams.keyed_table(records, table, folder).awaitTermination()
    changes = feeds.feed_changes(rebuilt.debezium_messages(events(spark)))
    expected = rows(feeds.current_rows(changes))
    assert rows(table.read()) == expected
    table.compact()
    table.compact()  # again, as a replay would
    assert rows(table.read()) == expected
    newest = recorded_topic(spark, f"{folder}/topic", streaming=False)
    table.upsert(feeds.feed_changes(newest.orderBy("offset").limit(50)), 99)
    assert rows(table.read()) == expected  # older rows change nothing


def test_restart_goes_on_where_it_stopped(spark, folder):
    feed(spark, f"{folder}/topic", files=6)
    table = KeyedFiles(spark, f"{folder}/data", ["id"])

    class Stops(Exception):
        pass

    def stops_early(batch, batch_id):
        table.upsert(batch, batch_id)  # written, but the batch is never committed
        if batch_id == 2:
            raise Stops

    def changes():
        return feeds.feed_changes(recorded_topic(spark, f"{folder}/topic", max_files=1))

    with pytest.raises(Exception):
        run_to_end(changes(), f"{folder}/checkpoint", each_batch=stops_early)
    streams.keyed_table(
        recorded_topic(spark, f"{folder}/topic", max_files=1), table, folder
    ).awaitTermination()
    expected = feeds.current_rows(
        feeds.feed_changes(rebuilt.debezium_messages(events(spark)))
    )
    assert rows(table.read()) == rows(expected)


def test_windows_survive_a_restart(spark, folder):
    write_in_order(events(spark), "event_id", f"{folder}/in", 4)
    sink = OrderedBatches(f"{folder}/data", logs.ordered_browser_counts)
    failed = []

    def fails_once(batch, batch_id):
        sink(batch, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    def counts():
        stream = rebuilt.server_logs(events_stream(spark, f"{folder}/in"))
        return logs.browser_counts(with_event_time(stream, "log_time", "15 seconds"), "1 hour")

    with pytest.raises(Exception):
        run_to_end(counts(), f"{folder}/checkpoint", each_batch=fails_once)
    run_to_end(counts(), f"{folder}/checkpoint", each_batch=fails_once)
    batch = logs.browser_counts(rebuilt.server_logs(events(spark)), "1 hour")
    expected = logs.ordered_browser_counts(
        closed(batch, latest_log(spark), timedelta(seconds=15))
    )
    found = spark.read.parquet(f"{folder}/data")
    assert failed and rows(found.drop("batch", "place")) == rows(expected)
    in_place = found.orderBy("batch", "place").collect()
    assert [r.window_time for r in in_place] == sorted(r.window_time for r in in_place)


def log_files(spark, folder, batches):
    """One JSON file per list of (seconds since start, browser)."""
    for n, lines in enumerate(batches):
        data = [(START + timedelta(seconds=s), f"{b}/1.0", "200") for s, b in lines]
        df = spark.createDataFrame(data, LOG_LINE.replace("timestamp", "timestamp_ntz"))
        df.coalesce(1).write.mode("append").json(folder)
        date_new_files(folder, n)


LOG_LINE = "log_time timestamp, user_agent string, status_code string"


def log_lines(spark, folder):
    return (
        spark.readStream.schema(LOG_LINE.replace("timestamp", "timestamp_ntz"))
        .option("maxFilesPerTrigger", 1)
        .json(folder)
    )


def test_late_rows(spark, folder):
    # Delay 15 s. The row at 5 s comes in the batch right after its window was
    # passed by the watermark (still counted); the one at 6 s two batches later.
    log_files(spark, f"{folder}/in", [
        [(10, "a"), (50, "a")],
        [(140, "a")],
        [(5, "a"), (150, "b")],
        [(6, "a"), (300, "b")],
        [(500, "b")],
    ])
    run = streams.ordered_browser_counts(log_lines(spark, f"{folder}/in"), folder)
    run.awaitTermination(late="drop")
    assert run.late_rows
    out = spark.read.parquet(f"{folder}/data").orderBy("window_time", "browser").collect()
    end = START + timedelta(minutes=1) - timedelta(milliseconds=1)
    first = [r.cnt_browser for r in out if r.window_time == end]
    assert first == [3]  # the row at 5 s counts, the one at 6 s doesn't
    others = [(r.window_time, r.browser, r.cnt_browser) for r in out if r.window_time != end]
    assert others == [
        (end + timedelta(minutes=2), "a", 1), (end + timedelta(minutes=2), "b", 1),
        (end + timedelta(minutes=5), "b", 1),
    ]


def test_a_bounded_run_refuses_to_lose_rows(spark, folder):
    log_files(spark, f"{folder}/in", [[(600, "a")], [(700, "a")], [(5, "a")], [(800, "b")]])
    run = streams.ordered_browser_counts(log_lines(spark, f"{folder}/in"), folder)
    with pytest.raises(LateRowsError, match="after their windows had closed"):
        run.awaitTermination()


@pytest.mark.parametrize("parts", [4, 12])
@pytest.mark.parametrize("name", [
    "stream_browser_counts_ordered", "stream_realtime_counts", "stream_dw_files", "stream_two_sinks",
    "stream_lake_counts", "stream_distinct_ips", "stream_word_count", "stream_revenue_retractions",
])
def test_files_in_any_order_give_all_rows(spark, scattered, name, parts):
    """Tables of several files, not in time order, against the same tables in one file."""
    assert rows(catalogue.QUERIES[name](spark, scattered(parts))) == rows(catalogue.QUERIES[name](spark, SF))


@pytest.fixture(scope="module")
def scattered(spark, tmp_path_factory):
    made = {}

    def make(parts):
        if parts not in made:
            made[parts] = str(tmp_path_factory.mktemp(f"parts{parts}"))
            for table in ("events", "orders"):
                df = spark.read.parquet(f"{SF}/{table}.parquet")
                df.repartition(parts, F.hash(df.columns[0])).write.parquet(f"{made[parts]}/{table}.parquet")
        return made[parts]

    return make


def test_partition_markers_of_minute_windows(spark, folder):
    log_files(spark, f"{folder}/in", [[(10, "a"), (70, "a")], [(125, "b")], [(200, "c")]])
    view = streams.timed_view(log_lines(spark, f"{folder}/in"))
    streams.warehouse_files(view, folder).awaitTermination()
    base = f"{folder}/data/dt=2024-01-01/hour=00"
    stored = read_partitioned_json(spark, f"{folder}/data", WAREHOUSE_SCHEMA)
    assert sorted((r.browser, r.minute, r.requests) for r in stored.collect()) == [
        ("a", "00", 1), ("a", "01", 1), ("b", "02", 1)
    ]
    assert all(os.path.exists(f"{base}/minute={m}/_SUCCESS") for m in ("00", "01", "02"))
    assert stored.schema["minute"].dataType.typeName() == "string"


def window_batch(spark, *seconds):
    data = [(START + timedelta(seconds=s), "a", "200") for s in seconds]
    df = spark.createDataFrame(data, "log_time timestamp, browser string, status_code string")
    return logs.status_counts(df, "5 seconds")


def test_short_windows_mark_a_minute_only_when_it_is_over(spark, folder):
    def sink():
        return PartitionedJson(
            folder, lambda b: logs.warehouse_columns(b, keep_window=True), writers=2
        )

    marker = f"{folder}/dt=2024-01-01/hour=00/minute=00/_SUCCESS"
    first = sink()
    first(window_batch(spark, 1, 2, 7, 41), 0)
    assert not os.path.exists(marker)
    # A new sink object, as after a restart, must still know the open partition.
    second = sink()
    second(window_batch(spark, 52), 1)
    assert not os.path.exists(marker)
    second(window_batch(spark, 52), 1)  # a replay replaces its own files
    second(window_batch(spark, 57), 2)
    assert os.path.exists(marker)
    stored = read_partitioned_json(spark, folder, WAREHOUSE_SCHEMA)
    assert sorted(r.requests for r in stored.collect()) == [1, 1, 1, 1, 2]


def test_a_quiet_stream_marks_its_last_minute(spark, folder):
    log_files(spark, f"{folder}/in", [[(1, "a"), (52, "a")], [(200, "b")]])
    view = streams.timed_view(log_lines(spark, f"{folder}/in"))
    streams.warehouse_files(view, folder, "5 seconds").awaitTermination()
    base = f"{folder}/data/dt=2024-01-01/hour=00"
    assert os.path.exists(f"{base}/minute=00/_SUCCESS")
    with open(f"{folder}/data/_newest_complete") as newest:
        assert newest.read() == "dt=2024-01-01/hour=00/minute=00"


def test_a_start_looks_at_folders_after_the_newest_complete_one(spark, folder, monkeypatch):
    from tidelog.streaming import files

    for day, hour, minute in ((1, 0, 5), (1, 3, 7), (2, 0, 0), (2, 1, 9), (2, 2, 1)):
        os.makedirs(f"{folder}/dt=2024-01-{day:02d}/hour={hour:02d}/minute={minute:02d}")
    with open(f"{folder}/_newest_complete", "w") as newest:
        newest.write("dt=2024-01-02/hour=01/minute=09")
    asked = []
    monkeypatch.setattr(files, "exists", lambda s, p: asked.append(p) or False)
    sink = PartitionedJson(folder, lambda b: b)
    assert sink._unmarked(spark) == {"dt=2024-01-02/hour=02/minute=01"} and len(asked) == 1


def test_partition_names_follow_the_zone(spark, folder):
    sink = PartitionedJson(
        folder,
        lambda b: logs.warehouse_columns(b, "Asia/Shanghai", keep_window=True),
        zone="Asia/Shanghai",
    )
    sink(logs.status_counts(
        spark.createDataFrame([(START, "a", "200")],
                              "log_time timestamp, browser string, status_code string"),
        "1 minute"), 0)
    assert os.path.exists(f"{folder}/dt=2024-01-01/hour=08/minute=00/_SUCCESS")


def test_two_sinks_hold_the_same_requests(spark, split_events, folder):
    stream = rebuilt.server_logs(events_stream(spark, split_events))
    for query in streams.two_sinks(stream, folder, "1 day"):
        query.awaitTermination()
    stored = read_partitioned_json(spark, f"{folder}/files/data", WAREHOUSE_SCHEMA)
    batch = logs.status_counts(
        logs.browsers_view(rebuilt.server_logs(events(spark))), "1 day"
    )
    expected = closed(batch, latest_log(spark), timedelta(0)).agg(F.sum("requests")).first()
    assert stored.agg(F.sum("requests")).first() == expected
    assert spark.read.text(f"{folder}/topic/data").count() > stored.count()


def test_two_sinks_write_one_file_for_a_minute(spark, folder):
    """However many counts it has; they were dealt over four files."""
    stream = rebuilt.dense_logs(rebuilt.stream_table(spark, f"{SF}/events.parquet", rebuilt.EVENTS_SCHEMA))
    for query in streams.two_sinks(stream, folder):
        query.awaitTermination()
    written = [p for p, _, names in os.walk(f"{folder}/files/data") for n in names if n.endswith(".json")]
    minutes = spark.read.json(f"{folder}/files/data").groupBy("dt", "hour", "minute").count().collect()
    assert len(written) == len(set(written)) == len(minutes) and min(r["count"] for r in minutes) > 4


def test_the_files_sink_computes_a_batch_once(spark, folder):
    """It took its partitions of many rows, and those to mark, from further runs."""
    stream = rebuilt.dense_logs(rebuilt.stream_table(spark, f"{SF}/events.parquet", rebuilt.EVENTS_SCHEMA))
    computed = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(minute):
        computed.add(1)
        return minute

    class Columns:
        def __call__(self, batch):
            return logs.warehouse_columns(batch, keep_window=True).withColumn("minute", seen("minute"))

        def __reduce__(self):  # the tasks that mark get the sink, and can't have the accumulator
            return str, ()

    sink = PartitionedJson(f"{folder}/data", Columns(), checkpoint=f"{folder}/checkpoint", file_rows=10)
    counts = logs.status_counts(streams.timed_view(stream), "1 minute")
    run_to_end(counts, f"{folder}/checkpoint", each_batch=sink)
    assert spark.read.json(f"{folder}/data").count() == computed.value > 0


def test_word_count_of_text_files_in_processing_time(spark, folder):
    os.makedirs(f"{folder}/in", exist_ok=True)
    for n, text in enumerate(["a b a\n\n  \n", "b  c \n"]):
        with open(f"{folder}/in/{n}.txt", "w") as f:
            f.write(text)
    clock = F.lit(START).cast("timestamp")
    lines = with_processing_time(text_stream(spark, f"{folder}/in", 1), "at", clock)
    from tidelog.operators.windows import word_counts

    counts = word_counts(lines, "value", "at", "30 seconds")
    query = run_to_end(
        counts, f"{folder}/checkpoint", mode="complete", format="memory", name="words_seen"
    )
    assert query.exception() is None
    seen = {r.word: r.n for r in spark.table("words_seen").collect()}
    assert seen == {"a": 2, "b": 2, "": 2, "c": 1}


def test_processing_time_defaults_to_the_clock(spark, folder):
    os.makedirs(f"{folder}/in", exist_ok=True)
    with open(f"{folder}/in/0.txt", "w") as f:
        f.write("a\n")
    before = datetime.now() - timedelta(minutes=1)
    lines = with_processing_time(text_stream(spark, f"{folder}/in"), "at")
    run_to_end(lines, f"{folder}/checkpoint", path=f"{folder}/out")
    at = spark.read.parquet(f"{folder}/out").select(
        F.unix_seconds("at").alias("at")
    ).first().at
    assert at >= before.timestamp()


@pytest.mark.parametrize("sink", ["noop", "console"])
def test_discarding_and_printing_sinks(spark, split_events, folder, sink, capfd):
    stream = rebuilt.server_logs(events_stream(spark, split_events))
    query = streams.client_errors(stream, folder, sink)
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p["numInputRows"] for p in query.recentProgress) >= events(spark).count()


def test_lake_table_grows_with_the_stream(spark, split_events, folder):
    from tidelog.plans import catalog

    catalog.drop_table(spark, "lake_by_day")
    catalog.create_table(
        spark, "lake_by_day", catalog.WAREHOUSE_TABLE, ["dt"], f"{folder}/data"
    )
    view = streams.timed_view(rebuilt.server_logs(events_stream(spark, split_events)))
    streams.lake_counts(view, folder, "lake_by_day", "1 hour").awaitTermination()
    batch = logs.status_counts(
        logs.browsers_view(rebuilt.server_logs(events(spark))), "1 hour"
    )
    expected = closed(batch, latest_log(spark), timedelta(0)).count()
    assert spark.table("lake_by_day").count() == expected
    one_day = spark.table("lake_by_day").where("dt = '2024-01-02'")
    assert 0 < one_day.count() < expected
    assert "PartitionFilters: [isnotnull(dt" in revenue.plan_text(one_day)


def test_keyed_table_looks_into_live_folders_only(spark, folder, monkeypatch):
    from tidelog.streaming import files

    table = KeyedFiles(spark, folder, ["id"], schema="id int, num int", compact_every=10)
    assert table.read().collect() == []
    counts = []
    for n in range(25):
        df = spark.createDataFrame([(n % 4, "+U", n, n)], "id int, kind string, num int, seq bigint")
        table.upsert(df, n)
        if n in (9, 19):
            asked = []
            monkeypatch.setattr(files, "exists", lambda s, p, real=files.exists: asked.append(p) or real(s, p))
            assert {(r.id, r.num) for r in table.read().collect()} == {(k % 4, k) for k in range(n - 3, n + 1)}
            counts.append(len(asked))
            monkeypatch.undo()
    assert counts[0] == counts[1] == 1
    changes = spark.createDataFrame([(1, "+U", 2, 3)], "id int, kind string, num int, seq bigint")
    from tidelog.operators.changes import latest_by_key

    plan = latest_by_key(changes, ["id"], keep_deleted=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_lake_table_fits_its_merge_and_hides_removed_rows(spark, folder):
    from tidelog.plans import catalog
    from tidelog.streaming.keyed import LakeUpsert

    catalog.create_table(spark, "keyed_lake", catalog.KEYED_TABLE, [], folder)
    try:
        spark.sql("INSERT INTO keyed_lake VALUES (1, 2, NULL, 5, false), (2, 3, NULL, 6, true)")
        assert [tuple(r) for r in LakeUpsert("keyed_lake", ["id"]).read(spark).collect()] == [(1, 2, None)]
    finally:
        catalog.drop_table(spark, "keyed_lake")


def test_a_retraction_batch_is_read_once(spark, folder, monkeypatch):
    """Of all that a batch starts, only what stores its columns reads the input."""
    orders = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "a", 3)], "order_id bigint, name string, revenue bigint")
    orders.write.parquet(f"{folder}/in")
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(value):
        seen.add(1)
        return value

    batch = spark.read.parquet(f"{folder}/in").withColumn("revenue", counted.asNondeterministic()("revenue"))
    for compact in (False, True):
        sink = RetractingSum(f"{folder}/{compact}", ["name"], "revenue", "order_id", "rev_sum", compact=compact, hot_rows=1)
        before = seen.value
        sink(batch, 0)
        assert seen.value - before == 3
        assert {r["name"]: r.rev_sum for r in KeyedFiles(spark, f"{folder}/{compact}/sums", ["name"]).read().collect()} == {"a": 4, "b": 2}
