"""The marts of an ingest, kept as partial states and refreshed by touched dates.

A state table holds, per date, what a mart needs of that date and nothing that
would have to be taken back later: exact decimal sums, counts, exact numbers of
distinct orders.

    daily        one row a date
    products     (date, product) sums, partial aggregation per task before the shuffle
    categories   (date, category) sums

Its folders are months.  An append reads the dates it wrote from the published table
(a partition filter), puts their states in the place of older ones in the months
touched (dynamic partition overwrite, so running it again changes nothing), and
finishes the marts from the states.  A hot date or product is pre-aggregated in the
tasks that read it; a month of any size is written by as many tasks as it needs.
The finished marts equal those of ``operators/marts.py`` over the whole table.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import amount_sum, units_sum
from ..session import scratch_path
from ..spec import TOP_PRODUCTS_MART_K

DATE, MONTH = "sale_date", "month"
NO_DATE = "none"
_SUM = T.StructField("amount", T.DecimalType(38, 8))
_PLACE = [T.StructField(DATE, T.DateType()), T.StructField(MONTH, T.StringType())]
STATES = {
    "daily": T.StructType([_SUM, T.StructField("units_sold", T.LongType()), T.StructField("orders", T.LongType()), *_PLACE]),
    "products": T.StructType([T.StructField("product_id_canon", T.StringType()), _SUM, *_PLACE]),
    "categories": T.StructType([T.StructField("category_canon", T.StringType()), _SUM, *_PLACE]),
}


def of_dates(dates) -> Column:
    """Rows of these dates (None: the rows without one); prunes partitions."""
    known = [d for d in dates if d is not None]
    hit = F.coalesce(F.col(DATE).isin(known), F.lit(False)) if known else F.lit(False)
    return hit | F.col(DATE).isNull() if None in dates else hit


def partial_states(sales: DataFrame) -> dict[str, DataFrame]:
    return {
        "daily": sales.groupBy(DATE).agg(
            amount_sum("total_price").alias("amount"), units_sum("quantity").alias("units_sold"), F.count_distinct("order_id").alias("orders")
        ),
        "products": sales.groupBy(DATE, "product_id_canon").agg(amount_sum("total_price").alias("amount")),
        "categories": sales.groupBy(DATE, "category_canon").agg(amount_sum("total_price").alias("amount")),
    }


def month_of(d) -> str:
    return NO_DATE if d is None else f"{d:%Y-%m}"


def month_cuts(dates, n: int) -> list[datetime.date]:
    """First days of months that deal ``dates`` to about ``n`` runs of months."""
    known = sorted(d for d in dates if d is not None)
    cuts = {known[len(known) * i // n].replace(day=1) for i in range(1, n)} if known else set()
    return sorted(c for c in cuts if c > known[0])


def _between(cuts: list[datetime.date]) -> list[Column]:
    """Conditions of the runs of months; each row, dated or not, meets one of them."""
    if not cuts:
        return [F.lit(True)]
    first = (F.col(DATE) < cuts[0]) | F.col(DATE).isNull()
    return [first, *[(F.col(DATE) >= a) & (F.col(DATE) < b) for a, b in zip(cuts, cuts[1:])], F.col(DATE) >= cuts[-1]]


def refresh(sales: DataFrame, root: str, dates=None, cuts=()) -> None:
    """Write the states of ``dates`` (None: of all, and of no others) of ``sales``.

    Give None after a job that published rows and failed before this step.  With
    ``cuts`` (see ``month_cuts``) all products are made a run of months at a time: they
    are hardly fewer than the rows, and are shuffled twice."""
    spark = sales.sparkSession
    rows = sales if dates is None else sales.where(of_dates(dates))
    # each state reads its own columns; keeping the rows would take memory that grows with the table
    month = F.coalesce(F.date_format(DATE, "yyyy-MM"), F.lit(NO_DATE)).alias(MONTH)
    for name, state in partial_states(rows).items():
        data = state.select("*", month).select(*STATES[name].names)
        if dates is not None:  # the other dates of the months touched stay as they are
            held = read_state(spark, root, name).where(F.col(MONTH).isin(sorted({month_of(d) for d in dates})) & ~of_dates(dates))
            path = scratch_path(spark, f"state-{name}")
            held.write.parquet(path)  # read before its folders are overwritten
            data = data.unionByName(spark.read.schema(STATES[name]).parquet(path))
        runs = _between([*cuts]) if dates is None and name == "products" else [F.lit(True)]
        for i, run in enumerate(runs):
            w = data.where(run).hint("rebalance", MONTH).write.mode("append" if i else "overwrite").partitionBy(MONTH)
            w.option("partitionOverwriteMode", "static" if dates is None else "dynamic").option("compression", "zstd").parquet(f"{root}/{name}")


def read_state(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(STATES[name]).parquet(f"{root}/{name}")


def _money(column: str) -> Column:
    return F.col(column).cast("double")


def daily(spark: SparkSession, root: str) -> DataFrame:
    """As ``marts.daily_aggregates``."""
    state = read_state(spark, root, "daily")
    return state.select(DATE, _money("amount").alias("revenue"), "units_sold", "orders").orderBy(DATE)


def top_products(spark: SparkSession, root: str, k: int = TOP_PRODUCTS_MART_K) -> DataFrame:
    """As ``marts.top_products_mart``."""
    sums = read_state(spark, root, "products").groupBy("product_id_canon").agg(F.try_sum("amount").alias("amount"))
    ranked = sums.select("product_id_canon", _money("amount").alias("revenue"))
    return ranked.orderBy(F.desc("revenue"), F.asc("product_id_canon")).limit(k)


def top_categories(spark: SparkSession, root: str) -> DataFrame:
    """As ``marts.top_categories``."""
    sums = read_state(spark, root, "categories").groupBy("category_canon").agg(F.try_sum("amount").alias("amount"))
    ranked = sums.select("category_canon", _money("amount").alias("revenue"))
    return ranked.orderBy(F.desc("revenue"), F.asc("category_canon"))


def finished(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {"daily": daily(spark, root), "top_products": top_products(spark, root), "top_categories": top_categories(spark, root)}
