"""Aggregate marts published next to the canonical table (daily, top products,
categories) and the preview of the daily mart.

Same plan shapes as the reports: partial + final aggregation, top-k without a
global sort.  The daily mart keeps the NULL-date group (the SQL report drops it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import money_sum, units_sum
from ..spec import PREVIEW_ROWS, TOP_PRODUCTS_MART_K


def daily_aggregates(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("sale_date")
        .agg(
            money_sum("total_price").alias("revenue"),
            units_sum("quantity").alias("units_sold"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy("sale_date")
    )


def top_products_mart(sales: DataFrame, k: int = TOP_PRODUCTS_MART_K) -> DataFrame:
    return (
        sales.groupBy("product_id_canon")
        .agg(money_sum("total_price").alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc("product_id_canon"))
        .limit(k)
    )


def top_categories(sales: DataFrame) -> DataFrame:
    """All categories by revenue, descending (no limit)."""
    return (
        sales.groupBy("category_canon")
        .agg(money_sum("total_price").alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc("category_canon"))
    )


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """First ``n`` rows of an already ordered frame (a display-style preview)."""
    return df.limit(n)
