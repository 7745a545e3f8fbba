"""Chart-ready series, selected with Spark instead of pandas.

Rendering (PNG files) is a single-machine concern and stays out of the
library; these return the exact rows a plot would show, computed where the
data lives.  Input can be a mart DataFrame or a CSV/Parquet mart read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.resolve import first_existing
from ..spec import CHART_TOP_N


def revenue_timeseries(daily: DataFrame) -> DataFrame:
    """(date, revenue): ``ds``/``y`` (forecast-style) or ``date``/``revenue`` columns;
    unparsable dates become NULL rather than failing."""
    d = first_existing(("ds",), daily.columns) or first_existing(("date",), daily.columns)
    y = first_existing(("y",), daily.columns) or first_existing(("revenue",), daily.columns)
    if d is None or y is None:
        raise ValueError(f"need ds/date and y/revenue columns, got {daily.columns}")
    types = {f.name: f.dataType for f in daily.schema.fields}
    return daily.select(
        coerce.to_date(F.col(f"`{d}`"), types[d]).alias("date"),
        coerce.to_double(F.col(f"`{y}`"), types[y]).alias("revenue"),
    ).orderBy(F.asc_nulls_last("date"))


def top_categories_chart(by_category: DataFrame, top_n: int = CHART_TOP_N) -> DataFrame:
    """First column = label, second = value; top ``top_n`` by value (NULL values last)."""
    if len(by_category.columns) < 2:
        raise ValueError(f"expected a label and a value column, got {by_category.columns}")
    label, value = by_category.columns[0], by_category.columns[1]
    types = {f.name: f.dataType for f in by_category.schema.fields}
    return (
        by_category.select(
            F.col(f"`{label}`").cast("string").alias("category"),
            coerce.to_double(F.col(f"`{value}`"), types[value]).alias("revenue"),
        )
        .orderBy(F.desc_nulls_last("revenue"), F.asc("category"))
        .limit(top_n)
    )
