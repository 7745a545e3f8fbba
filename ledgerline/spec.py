"""Canonical sales model: ordered alias lists, defaults and the fixed output schema.

A raw sales file may name the same fact differently ("order_date", "date",
"timestamp", ...).  A :class:`CanonicalSpec` lists, per canonical field, the raw
names to try in order; the first one present wins.  The spec is plain data so
batch, stream and CLI entry points share one resolver.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference behaviour for identical
# results: alias lists (in priority order), defaults and top-k sizes.
# ---------------------------------------------------------------------------
DATE_ALIASES = ("order_date", "order_datetime", "date", "sale_date", "timestamp")
PRICE_ALIASES = ("total_price", "price", "sale_amount", "amount", "revenue")
QUANTITY_ALIASES = ("quantity", "qty", "units", "order_quantity")
STREAM_QUANTITY_ALIASES = ("quantity", "qty", "units")
PRODUCT_ALIASES = ("product_id", "asin", "sku", "product", "product_title")
CLI_PRODUCT_ALIASES = ("product_id", "asin", "sku", "product_title", "product")
CATEGORY_ALIASES = ("category", "product_category", "category_name", "department")
SELLER_ALIASES = ("seller_id", "seller", "merchant", "seller_name")
UNIT_PRICE_ALIASES = ("unit_price", "price")
ORDER_ID_ALIASES = ("order_id",)
CUSTOMER_ID_ALIASES = ("customer_id",)

DEFAULT_PRICE = 0.0
DEFAULT_QUANTITY = 1
DEFAULT_CATEGORY = "unknown"

DEFAULT_PARTITION_COLUMN = "sale_date"
CLUSTER_COLUMNS = ("seller_canon", "product_id_canon")

TOP_PRODUCTS_MART_K = 100
TOP_PRODUCTS_REPORT_K = 20
SELLER_REPORT_K = 50
CLI_TOP_SELLERS_K = 100
CLI_TOP_PRODUCTS_K = 200
CHART_TOP_N = 20
PREVIEW_ROWS = 50
ROLLING_ROWS = 7
TRAILING_DAYS = 365
# ---------------------------------------------------------------------------

# Canonical columns added by canonicalise(), in output order.
CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType(), True),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("order_ts", T.TimestampType(), True),
        T.StructField("sale_date", T.DateType(), True),
        T.StructField("total_price", T.DoubleType(), True),
        T.StructField("quantity", T.LongType(), True),
        T.StructField("product_id_canon", T.StringType(), True),
        T.StructField("category_canon", T.StringType(), True),
        T.StructField("seller_canon", T.StringType(), True),
    ]
)
CANONICAL_COLUMNS = tuple(f.name for f in CANONICAL_SCHEMA.fields)

# Raw schema a curated (non-inferred) CSV read uses.
CURATED_RAW_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType(), True),
        T.StructField("order_date", T.TimestampType(), True),
        T.StructField("customer_id", T.StringType(), True),
        T.StructField("product_id", T.StringType(), True),
        T.StructField("asin", T.StringType(), True),
        T.StructField("quantity", T.LongType(), True),
        T.StructField("total_price", T.DoubleType(), True),
        T.StructField("category", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class CanonicalSpec:
    """Ordered alias lists per canonical field.

    ``derive_price`` enables the unit-price x quantity fallback used by the batch
    ingest (the stream ingest goes straight to the 0.0 default).
    """

    date: tuple[str, ...] = DATE_ALIASES
    price: tuple[str, ...] = PRICE_ALIASES
    quantity: tuple[str, ...] = QUANTITY_ALIASES
    product: tuple[str, ...] = PRODUCT_ALIASES
    category: tuple[str, ...] = CATEGORY_ALIASES
    seller: tuple[str, ...] = SELLER_ALIASES
    unit_price: tuple[str, ...] = UNIT_PRICE_ALIASES
    order_id: tuple[str, ...] = ORDER_ID_ALIASES
    customer_id: tuple[str, ...] = CUSTOMER_ID_ALIASES
    derive_price: bool = True
    default_price: float = DEFAULT_PRICE
    default_quantity: int = DEFAULT_QUANTITY
    default_category: str = DEFAULT_CATEGORY

    def with_aliases(self, **lists: tuple[str, ...]) -> "CanonicalSpec":
        return replace(self, **{k: tuple(v) for k, v in lists.items()})


BATCH_SPEC = CanonicalSpec()
STREAM_SPEC = CanonicalSpec(quantity=STREAM_QUANTITY_ALIASES, derive_price=False)
