"""Grouped sums, written three ways: API, SQL over a view, retraction stream."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.changes import retract_sum


def by_api(orders: DataFrame) -> DataFrame:
    return (
        orders.select("name", "revenue")
        .groupBy("name")
        .agg(F.sum("revenue").alias("rev_sum"))
    )


def by_sql(orders: DataFrame, view: str = "revenue_orders") -> DataFrame:
    orders.createOrReplaceTempView(view)
    return orders.sparkSession.sql(
        f"SELECT name, sum(revenue) AS rev_sum FROM {view} GROUP BY name"
    )


def retractions(orders: DataFrame, order: str = "order_id", **options) -> DataFrame:
    return retract_sum(orders, ["name"], "revenue", order, "rev_sum", **options)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan as text, for logs and tests."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()
