"""A keyed table in buckets: its upkeep follows the changes."""

import os

import pytest

from tidelog.plans import feeds, streams
from tidelog.sources import rebuilt
from tidelog.sources.topics import recorded_topic
from tidelog.streaming import files
from tidelog.streaming.keyed import BucketedFiles, KeyedFiles

SF = "/root/testdata/sf0.001"
CHANGE = "id int, kind string, num int, seq bigint"


def changes(spark, rows):
    return spark.createDataFrame([(i, k, n, s) for i, k, n, s in rows], CHANGE)


def table(spark, folder, **options):
    return BucketedFiles(spark, folder, ["id"], schema="id int, num int", **{"compact_every": 0, **options})


def content(df):
    return sorted(((r.id is not None, r.id or 0), r.num) for r in df.collect())


def base_files(folder):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(f"{folder}/base") for f in names if f.endswith(".parquet")}


def test_compaction_rewrites_changed_buckets_only(spark, folder):
    keyed = table(spark, folder, buckets=64)
    assert keyed.compact() == [] and keyed.read().collect() == []
    keyed.upsert(changes(spark, [(i, "+I", i, i) for i in range(2000)]), 0)
    assert keyed.compact() == list(range(64))
    before = base_files(folder)
    keyed.upsert(changes(spark, [(7, "+U", -7, 5000), (8, "-D", 8, 5001)]), 1)
    keyed.upsert(changes(spark, [(7, "+U", -77, 5002), (None, "+I", 1, 5003)]), 2)
    rewritten = keyed.compact()
    assert 1 <= len(rewritten) <= 3 and keyed.compact() == []
    after = base_files(folder)
    assert all(after[f] == t for f, t in before.items())  # the others stay as they are
    new = [f for f in after if f not in before]
    assert {int(f.split("__bucket=")[1].split("/")[0]) for f in new} == set(rewritten)
    expected = {i: i for i in range(2000)} | {7: -77, None: 1}
    del expected[8]
    assert content(keyed.read()) == sorted(((i is not None, i or 0), n) for i, n in expected.items())
    # A compaction reads the changed buckets only.
    plan = keyed._rows({b: 0 for b in rewritten}, [])._jdf.inputFiles()
    assert len(plan) == len(rewritten)


def test_the_table_as_of_a_batch(spark, folder):
    keyed = table(spark, folder, buckets=4, compact_every=2)
    for n in range(6):
        keyed.upsert(changes(spark, [(k, "+U", n, 10 * n + k) for k in range(n + 1)]), n)
    for n in range(1, 7):
        assert content(keyed.read(before_batch=n)) == [((True, k), n - 1) for k in range(n)]
    keyed.upsert(changes(spark, []), 6)
    keyed.compact()
    assert content(keyed.read()) == [((True, k), 5) for k in range(6)]


def test_a_lost_compaction_changes_nothing(spark, folder, monkeypatch):
    keyed = table(spark, folder, buckets=4)
    for n in range(3):
        keyed.upsert(changes(spark, [(n, "+I", n, n)]), n)
    monkeypatch.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        keyed.compact()
    assert content(keyed.read()) == [((True, n), n) for n in range(3)]
    monkeypatch.undo()
    assert keyed.compact() and content(keyed.read()) == [((True, n), n) for n in range(3)]


def test_late_older_rows_never_revive_a_key(spark, folder):
    keyed = table(spark, folder, buckets=4, compact_every=1)
    keyed.upsert(changes(spark, [(1, "+I", 1, 1)]), 0)
    keyed.upsert(changes(spark, [(1, "-D", 1, 9)]), 1)
    keyed.upsert(changes(spark, [(1, "+U", 5, 5)]), 2)
    keyed.upsert(changes(spark, [(1, "+U", 5, 5)]), 2)  # a replay
    assert keyed.read().collect() == []


@pytest.mark.parametrize("compact_every", [0, 2])
def test_same_table_as_without_buckets(spark, folder, compact_every):
    events = spark.read.parquet(f"{SF}/events.parquet")
    messages = rebuilt.topic_records(rebuilt.debezium_messages(events), partitions=4)
    messages.repartitionByRange(5, "offset").write.parquet(f"{folder}/topic")
    found = []
    for kind, name in ((KeyedFiles, "plain"), (BucketedFiles, "buckets")):
        keyed = kind(spark, f"{folder}/{name}", ["id"], partition="partition", compact_every=compact_every)
        records = recorded_topic(spark, f"{folder}/topic", max_files=1)
        streams.keyed_table(records, keyed, f"{folder}/{name}").awaitTermination()
        found.append(sorted(map(tuple, keyed.read().collect())))
    assert found[0] == found[1] == sorted(map(tuple, feeds.current_rows(feeds.feed_changes(rebuilt.debezium_messages(events))).collect()))
