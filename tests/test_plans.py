"""What the plans must look like, whatever the data."""

import pytest

import catalogue
from tidelog.operators.changes import retract_sum
from tidelog.plans import streams
from tidelog.plans.revenue import plan_text

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return plan_text(catalogue.QUERIES[name](spark, SF), "formatted")


@pytest.mark.parametrize(
    "name, columns",
    [
        ("client_errors", {"event_id", "ts"}),
        ("browser_counts_1h", {"event_id", "ts"}),
        ("distinct_ip_tvf", {"ts", "user_id"}),
        ("word_count_lines", {"text"}),
        ("revenue_by_name_api", {"o_totalprice", "o_orderpriority"}),
        ("cdc_latest_by_key", {"event_id", "ts", "user_id"}),
        ("total_count", set()),
    ],
)
def test_scans_read_only_what_they_need(spark, name, columns):
    lines = [x for x in plan(spark, name).splitlines() if x.startswith("ReadSchema")]
    read = [x.split("struct<")[1].rstrip(">") for x in lines]
    assert read
    for schema in read:
        assert {c.split(":")[0] for c in schema.split(",") if c} <= columns


@pytest.mark.parametrize("name", sorted(n for n in catalogue.QUERIES if n[:6] != "stream"))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(spark, name)
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


@pytest.mark.parametrize(
    "name", ["browser_counts_1h", "distinct_ip_1d", "word_count_lines", "revenue_by_name_api",
             "cdc_latest_by_key", "total_count"],
)
def test_aggregates_combine_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def tree(spark, name):
    """The plan as a tree alone, each operator once."""
    return plan_text(catalogue.QUERIES[name](spark, SF), "simple")


def test_only_hashes_of_hot_keys_are_broadcast(spark):
    assert "BroadcastExchange" not in tree(spark, "revenue_retractions")  # no key is hot
    orders = catalogue._orders(spark, SF)
    text = plan_text(retract_sum(orders, ["name"], "revenue", "order_id", hot_rows=100), "formatted")
    broadcasts = [x for x in text.split("\n\n") if "BroadcastExchange" in x.splitlines()[0]]
    assert all("Input [1]: [__mark" in x for x in broadcasts)


@pytest.mark.parametrize("job, exchanges", [("realtime_counts", 1), ("distinct_ips", 2)])
def test_micro_batches_shuffle_no_more_than_they_must(spark, folder, job, exchanges):
    log = catalogue._log_stream(spark, SF)
    query = getattr(streams, job)(streams.timed_view(log) if job == "realtime_counts" else log, folder)
    query.awaitTermination()
    assert query._jsq.explainInternal(False).count("Exchange hashpartitioning") == exchanges


def test_a_row_of_a_synthetic_log_has_one_digest(spark):
    assert plan(spark, "server_logs_synthetic").count("sha2(") == 1


@pytest.mark.parametrize("name", ["status_counts_10s", "browser_counts_1h", "distinct_ip_1d"])
def test_windowed_counts_shuffle_no_more_than_they_must(spark, name):
    # The exact distinct count needs a second one, of its partial counts.
    expected = 2 if name == "distinct_ip_1d" else 1
    assert tree(spark, name).count("Exchange hashpartitioning") == expected
