import random

import pytest

from tidelog.operators.ordered import running_by_key


def brute_force(rows):
    """rows: (key, order, value) -> (key, order, n, sum, sum before, previous)."""
    state, out = {}, []
    for key, order, value in sorted(rows, key=lambda r: r[1]):
        n, total, last = state.get(key, (0, None, None))
        new = total if value is None else (total or 0) + value
        out.append((key, order, n + 1, new, total, last))
        state[key] = (n + 1, new, value)
    return sorted(out, key=lambda r: r[1])


def ours(spark, rows, hot_rows):
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint")
    scan = running_by_key(
        df, ["k"], "o", ordinal="n", sums={"s": "v"}, sums_before={"b": "v"},
        previous={"p": "v"}, hot_rows=hot_rows,
    )
    assert scan.columns == ["k", "o", "v", "n", "s", "b", "p"]
    return [(r.k, r.o, r.n, r.s, r.b, r.p) for r in scan.orderBy("o").collect()]


@pytest.mark.parametrize("hot_rows", [1, 3, 10, 1 << 20])
def test_same_as_brute_force_with_a_hot_key(spark, hot_rows):
    rng = random.Random(7)
    rows = []
    for order in range(300):
        key = "hot" if order % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((key, order * 5 + rng.randrange(3), rng.choice([None, 1, -4, 9])))
    rng.shuffle(rows)
    assert ours(spark, rows, hot_rows) == brute_force(rows)


def test_null_can_be_the_hot_key_and_order_can_be_negative(spark):
    rows = [(None if i % 2 else "a", i - 50, i) for i in range(100)]
    assert ours(spark, rows, 6) == brute_force(rows)


def test_uneven_order_values_stay_whole(spark):
    rows = [("a", 10**15 if i == 99 else i, 1) for i in range(100)]
    assert ours(spark, rows, 10) == brute_force(rows)


def test_order_may_take_the_whole_range(spark):
    rows = [("a", o, 1) for o in (-(2**63), -(2**62), -1, 0, 5, 2**62, 2**63 - 1)]
    assert ours(spark, rows, 2) == brute_force(rows)


def test_an_outlier_leaves_slices_even(spark):
    df = spark.range(20_000).selectExpr("'k' as k", "if(id = 7, 9000000000000000000, id) as o", "1L as v")
    scan = running_by_key(df, ["k"], "o", ordinal="n", sums={"s": "v"}, hot_rows=1000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        from pyspark.sql import functions as F

        sizes = [r["count"] for r in scan.where("s > 0").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sum(sizes) == 20_000 and max(sizes) <= 2500
    assert scan.where("n <> s").isEmpty()


def test_hot_key_is_split_over_tasks(spark):
    rows = [("hot", i, 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, o bigint, v bigint")
    scan = running_by_key(df, ["k"], "o", sums={"s": "v"}, hot_rows=50)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from pyspark.sql import functions as F

        sizes = [
            r["count"]
            for r in scan.groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 1500 and sum(sizes) == 2000
