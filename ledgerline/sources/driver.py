"""Raw sales rows derived from the TPC-H-like driver tables.

One sale = one line item.  Its order date and customer come from ``orders``,
its category from ``part``, its region from supplier -> nation -> region.  All
lookups are LEFT joins on primary keys, so a lookup never adds or removes line
items and a lookup whose columns a query does not need can be skipped without
changing any result.  ``sales_view`` therefore joins only what the requested
fields need: a seller or product report reads ``lineitem`` alone, and no query
pays for a join it does not use (Catalyst cannot drop an unused join itself).

Join strategy is left to Catalyst + AQE: the big fact-to-fact join
(lineitem x orders on the order key) is a sort-merge join that AQE may split
when a key is skewed; dimension sides are broadcast only when Spark's size
estimate (file statistics, then runtime shuffle statistics) is under the
configured threshold -- nothing is hinted, so a dimension that grows with the
data falls back to a shuffle join automatically.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

SALES_FIELDS = (
    "order_id",
    "customer_id",
    "product_id",
    "seller_id",
    "order_date",
    "category",
    "region",
    "quantity",
    "total_price",
)

_ORDER_FIELDS = {"order_date", "customer_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def sales_view(spark: SparkSession, sf_dir: str, fields=SALES_FIELDS) -> DataFrame:
    """Raw sales rows with the requested ``fields`` (see ``SALES_FIELDS``)."""
    fields = tuple(fields)
    unknown = set(fields) - set(SALES_FIELDS)
    if unknown:
        raise ValueError(f"unknown sales fields: {sorted(unknown)}")
    li = table(spark, sf_dir, "lineitem")
    df = li.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_price"),
    )
    if _ORDER_FIELDS & set(fields):
        orders = table(spark, sf_dir, "orders").select(
            "o_orderkey",
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_orderdate").alias("order_date"),
        )
        df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
    if "category" in fields:
        part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
        df = df.join(part, df.l_partkey == part.p_partkey, "left")
    if "region" in fields:
        # Star order: fact x supplier, then the fixed-size nation and region
        # tables.  Each lookup side is a base table, so Spark's size check sees
        # its real file size (a pre-joined supplier/nation/region side would be
        # estimated as the product of its inputs and never qualify).
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
        region = table(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("region"))
        df = (
            df.join(supplier, df.l_suppkey == supplier.s_suppkey, "left")
            .join(nation, F.col("s_nationkey") == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
        )
    derived = {
        "order_id": F.col("l_orderkey").cast("string"),
        "product_id": F.col("l_partkey").cast("string"),
        "seller_id": F.col("l_suppkey").cast("string"),
    }
    return df.select(*[derived[f].alias(f) if f in derived else F.col(f) for f in fields])


# DuckDB twin of the full view (every lookup), used by the oracle SQL strings.
SALES_VIEW_SQL = """
SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id,
       CAST(o.o_custkey AS VARCHAR) AS customer_id,
       CAST(l.l_partkey AS VARCHAR) AS product_id,
       CAST(l.l_suppkey AS VARCHAR) AS seller_id,
       o.o_orderdate AS order_date,
       p.p_type AS category,
       r.r_name AS region,
       l.l_quantity AS quantity,
       l.l_extendedprice AS total_price
FROM lineitem l
LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""

# The canonicalised view in DuckDB: what canonicalise() produces from the view.
CANONICAL_SALES_SQL = f"""
SELECT order_id,
       customer_id,
       CAST(order_date AS TIMESTAMP) AS order_ts,
       CAST(order_date AS DATE) AS sale_date,
       CAST(total_price AS DOUBLE) AS total_price,
       CAST(trunc(quantity) AS BIGINT) AS quantity,
       product_id AS product_id_canon,
       category AS category_canon,
       seller_id AS seller_canon,
       region
FROM ({SALES_VIEW_SQL}) v
"""
