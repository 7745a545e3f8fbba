"""The SQL-file reports (totals, trailing daily series, top products, seller
performance, cohorts) plus revenue by region, as DataFrame plans over a
canonical sales table.

Scale notes
-----------
* Every aggregate is a partial (map-side) + final hash aggregate, so a hot key
  -- one seller or product holding a third of all rows -- is reduced inside each
  map task before the shuffle and never lands in one task as raw rows.
* Exact distinct counts (``COUNT(DISTINCT order_id)``) shuffle on
  (group key, order_id) first, which spreads a hot group over all partitions.
* Top-k is ``orderBy(...).limit(k)`` = ``TakeOrderedAndProject``: each task
  keeps k rows, the driver merges k x tasks rows -- no global sort.
* The cohort report pre-aggregates to one row per (customer, month) *before*
  any per-customer step, so a per-customer window sees at most one row per
  month however many sales a customer has; no join back to the fact table.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import amount_sum, money_avg, money_sum, units_sum
from ..functions.resolve import require_column
from ..spec import SELLER_REPORT_K, TOP_PRODUCTS_REPORT_K, TRAILING_DAYS


def total_revenue_units(sales: DataFrame) -> DataFrame:
    return sales.agg(
        money_sum("total_price").alias("total_revenue"),
        units_sum("quantity").alias("total_units_sold"),
    )


def _daily_sums(sales: DataFrame) -> DataFrame:
    return sales.groupBy("sale_date").agg(
        money_sum("total_price").alias("revenue"),
        units_sum("quantity").alias("units_sold"),
    )


def daily_revenue_trailing(sales: DataFrame, days: int = TRAILING_DAYS, as_of=None) -> DataFrame:
    """Daily revenue for dates in ``[as_of - days, ...)`` (no upper bound, NULL dates dropped).

    ``as_of``: ``None`` = today (``current_date()``, the reference behaviour); a
    ``date``/ISO string = that day (constant-folded); ``"latest"`` = the newest
    sale date in the data, as a scalar subquery.  In every case the filter sits
    on ``sale_date`` below the aggregate, so on a ``sale_date``-partitioned table
    it prunes partitions (at runtime for the subquery, whose own scan reads only
    the partition column).
    """
    dated = sales.where(F.col("sale_date").isNotNull())
    if as_of == "latest":
        anchor = dated.select(F.max("sale_date")).scalar()
    elif as_of is None:
        anchor = F.current_date()
    else:
        if isinstance(as_of, str):
            as_of = _dt.date.fromisoformat(as_of)
        anchor = F.lit(as_of)
    return _daily_sums(dated.where(F.col("sale_date") >= F.date_sub(anchor, days))).orderBy("sale_date")


def top_products(sales: DataFrame, k: int = TOP_PRODUCTS_REPORT_K) -> DataFrame:
    """Top-k products by revenue with their distinct order count."""
    return (
        sales.groupBy(F.col("product_id_canon").alias("product_id"))
        .agg(
            money_sum("total_price").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
        )
        .orderBy(F.desc("revenue"), F.asc("product_id"))
        .limit(k)
    )


def seller_performance(sales: DataFrame, k: int = SELLER_REPORT_K) -> DataFrame:
    """Per seller: line count, revenue, mean line value; top-k by revenue."""
    return (
        sales.groupBy(F.col("seller_canon").alias("seller_id"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            money_sum("total_price").alias("revenue"),
            money_avg("total_price").alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), F.asc("seller_id"))
        .limit(k)
    )


def first_purchase(sales: DataFrame) -> DataFrame:
    """First sale date per customer (the cohort report's CTE)."""
    return sales.groupBy("customer_id").agg(F.min("sale_date").alias("first_date"))


def cohort_retention(sales: DataFrame) -> DataFrame:
    """(cohort_month, activity_month) -> active customers and revenue.

    Equal to joining every sale with its customer's first purchase, computed
    without the join: ``trunc`` is monotone, so a customer's cohort month is the
    minimum of its activity months; sales without a customer are dropped (the
    inner join's behaviour), sales without a date form the NULL activity month.
    """
    per_month = (
        sales.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id", F.trunc("sale_date", "month").alias("activity_month"))
        .agg(amount_sum("total_price").alias("_amount"))
    )
    cohort = F.min("activity_month").over(Window.partitionBy("customer_id"))
    return (
        per_month.withColumn("cohort_month", cohort)
        .groupBy("cohort_month", "activity_month")
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.try_sum("_amount").cast("double").alias("revenue"),
        )
        .orderBy("cohort_month", "activity_month")
    )


def revenue_by_region(sales: DataFrame, region_col: str = "region") -> DataFrame:
    region = require_column(region_col, sales.columns)
    return (
        sales.groupBy(F.col(f"`{region}`").alias("region"))
        .agg(money_sum("total_price").alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc("region"))
    )
