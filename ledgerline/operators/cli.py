"""The command-line report set: daily revenue, top sellers, top products and the
rolling mean, driven by explicitly named date/price/quantity columns.

Unlike the canonical model, these take column names as arguments; a named
column that does not exist is an error (the reference's ``col(missing)`` also
fails, just with a less helpful message).

The rolling means run on the *daily* result, whose size is the number of
distinct days (a few thousand for decades of data), so the unpartitioned
window's single partition is bounded regardless of the fact-table size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.money import amount_sum, money_sum, units_sum
from ..functions.resolve import first_existing, require_column
from ..spec import (
    CLI_PRODUCT_ALIASES,
    CLI_TOP_PRODUCTS_K,
    CLI_TOP_SELLERS_K,
    ROLLING_ROWS,
    SELLER_ALIASES,
)


@dataclass(frozen=True)
class CliColumns:
    date_col: str = "order_date"
    price_col: str = "total_price"
    qty_col: str = "quantity"


def coerce_named(df: DataFrame, cols: CliColumns = CliColumns(), need=("price", "qty", "date")) -> DataFrame:
    """Add ``price_num`` (DOUBLE), ``qty_num`` (BIGINT) and/or ``date`` (DATE).

    Only the columns in ``need`` are looked up, so an output that uses the price
    alone (top sellers/products) does not depend on the date column.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    if "price" in need:
        p = require_column(cols.price_col, df.columns)
        out.append(coerce.to_double(F.col(f"`{p}`"), types[p]).alias("price_num"))
    if "qty" in need:
        q = require_column(cols.qty_col, df.columns)
        out.append(coerce.to_long(F.col(f"`{q}`"), types[q]).alias("qty_num"))
    if "date" in need:
        d = require_column(cols.date_col, df.columns)
        out.append(coerce.to_date(F.col(f"`{d}`"), types[d]).alias("date"))
    added = {"price_num", "qty_num", "date"}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in added]
    return df.select(*kept, *out)


def _daily_amounts(df: DataFrame, cols: CliColumns) -> DataFrame:
    return (
        coerce_named(df, cols)
        .groupBy("date")
        .agg(amount_sum("price_num").alias("_amount"), units_sum("qty_num").alias("units_sold"))
    )


def daily_revenue(df: DataFrame, cols: CliColumns = CliColumns()) -> DataFrame:
    """(date, revenue, units_sold) ordered by date."""
    return (
        _daily_amounts(df, cols)
        .select("date", F.col("_amount").cast("double").alias("revenue"), "units_sold")
        .orderBy("date")
    )


def _top_by(df: DataFrame, cols: CliColumns, aliases, k: int) -> DataFrame | None:
    key = first_existing(aliases, df.columns)
    if key is None:
        return None  # the reference skips this output when no column matches
    return (
        coerce_named(df, cols, need=("price",))
        .groupBy(F.col(f"`{key}`"))
        .agg(money_sum("price_num").alias("revenue"))
        .orderBy(F.desc("revenue"), F.asc(F.col(f"`{key}`")))
        .limit(k)
    )


def top_sellers(df: DataFrame, cols: CliColumns = CliColumns(), k: int = CLI_TOP_SELLERS_K) -> DataFrame | None:
    return _top_by(df, cols, SELLER_ALIASES, k)


def top_products(df: DataFrame, cols: CliColumns = CliColumns(), k: int = CLI_TOP_PRODUCTS_K) -> DataFrame | None:
    return _top_by(df, cols, CLI_PRODUCT_ALIASES, k)


def _rolling_mean(frame) -> F.Column:
    a = F.col("_amount")
    return F.try_sum(a).over(frame).cast("double") / F.count(a).over(frame)


def rolling_rows_revenue(df: DataFrame, cols: CliColumns = CliColumns(), rows: int = ROLLING_ROWS) -> DataFrame:
    """Mean revenue over the current and previous ``rows - 1`` *rows* (days with
    sales), dates ascending with the NULL date first -- the reference's frame."""
    w = Window.orderBy(F.asc_nulls_first("date")).rowsBetween(-(rows - 1), 0)
    return (
        _daily_amounts(df, cols)
        .select(
            "date",
            F.col("_amount").cast("double").alias("revenue"),
            "units_sold",
            _rolling_mean(w).alias("rolling_7d_revenue"),
        )
        .orderBy("date")
    )


def rolling_days_revenue(df: DataFrame, cols: CliColumns = CliColumns(), days: int = ROLLING_ROWS) -> DataFrame:
    """Calendar-true variant: mean daily revenue over dates in ``[d - days + 1, d]``
    (a RANGE frame on the day number), NULL dates excluded."""
    w = Window.orderBy(F.col("_day")).rangeBetween(-(days - 1), 0)
    return (
        _daily_amounts(df, cols)
        .where(F.col("date").isNotNull())
        .withColumn("_day", F.unix_date("date"))
        .select(
            "date",
            F.col("_amount").cast("double").alias("revenue"),
            "units_sold",
            _rolling_mean(w).alias("rolling_7d_revenue"),
        )
        .orderBy("date")
    )


def require_columns(df: DataFrame, cols: CliColumns) -> None:
    for name in (cols.date_col, cols.price_col, cols.qty_col):
        require_column(name, df.columns)
