"""Registered queries over the driver tables and their DuckDB oracle twins.

Each query builds raw sales rows from the driver tables (``sources.driver``),
canonicalises them exactly like any raw input, and runs the library operator.
Each oracle twin states the same result in plain SQL over the pre-registered
driver views, written from the semantics (joins, GROUP BY, windows) -- not
from our DataFrame plans -- so it is an independent check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import charts, cli, mart_states, marts, reports
from ..operators.canonical import canonicalise
from ..operators.mart_states import of_dates
from ..session import scratch_path, shuffles_dropped
from ..sinks import versions
from ..sinks.compaction import compact_table
from ..sinks.tables import cluster, compact, publish, register_table, write_mart
from ..sources import raw
from ..streaming.ingest import run_available
from . import batch_ingest, cli_report
from .sql_reports import run_report
from ..sources.driver import CANONICAL_SALES_SQL, SALES_VIEW_SQL, sales_view, table
from ..spec import BATCH_SPEC, CANONICAL_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]


def canonical(spark: SparkSession, sf_dir: str, fields) -> DataFrame:
    return canonicalise(sales_view(spark, sf_dir, fields), BATCH_SPEC)


# Raw names of a second file layout: every canonical field under another alias.
RENAMED_ALIASES = {
    "order_date": "order_datetime",
    "total_price": "revenue",
    "quantity": "units",
    "product_id": "sku",
    "category": "department",
    "seller_id": "merchant",
}


def renamed_view(spark: SparkSession, sf_dir: str, fields=None) -> DataFrame:
    v = sales_view(spark, sf_dir) if fields is None else sales_view(spark, sf_dir, fields)
    return v.select(*[F.col(c).alias(RENAMED_ALIASES.get(c, c)) for c in v.columns])


# Sales fields that come from lineitem alone (no lookup join needed).
LINE_FIELDS = ("order_id", "product_id", "seller_id", "quantity", "total_price")


# ---------------------------------------------------------------- queries ---

def q_total_revenue_units(spark, sf_dir):
    return reports.total_revenue_units(canonical(spark, sf_dir, ("total_price", "quantity")))


def q_daily_aggregates(spark, sf_dir):
    s = canonical(spark, sf_dir, ("order_id", "order_date", "total_price", "quantity"))
    return marts.daily_aggregates(s)


def q_daily_revenue_365d(spark, sf_dir):
    s = canonical(spark, sf_dir, ("order_date", "total_price", "quantity"))
    return reports.daily_revenue_trailing(s, 365, as_of="latest")


def q_top_products_100(spark, sf_dir):
    return marts.top_products_mart(canonical(spark, sf_dir, ("product_id", "total_price")))


def q_top_products_20(spark, sf_dir):
    return reports.top_products(canonical(spark, sf_dir, ("order_id", "product_id", "total_price")))


def q_top_categories(spark, sf_dir):
    return marts.top_categories(canonical(spark, sf_dir, ("category", "total_price")))


def q_seller_performance(spark, sf_dir):
    return reports.seller_performance(canonical(spark, sf_dir, ("seller_id", "total_price")))


def q_first_purchase(spark, sf_dir):
    return reports.first_purchase(canonical(spark, sf_dir, ("customer_id", "order_date")))


def q_cohort_retention(spark, sf_dir):
    s = canonical(spark, sf_dir, ("customer_id", "order_date", "total_price"))
    return reports.cohort_retention(s)


def q_revenue_by_region(spark, sf_dir):
    return reports.revenue_by_region(canonical(spark, sf_dir, ("region", "total_price")))


def q_net_seller_performance(spark, sf_dir):
    """Sellers by discounted price: prices with fractions of a cent."""
    li = table(spark, sf_dir, "lineitem")
    net = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("seller_id"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("total_price"),
        F.col("l_quantity").alias("quantity"),
    )
    return reports.seller_performance(canonicalise(net, BATCH_SPEC))


def _cli_input(spark, sf_dir, with_date=True):
    fields = ("seller_id", "product_id", "total_price", "quantity") + (("order_date",) if with_date else ())
    return sales_view(spark, sf_dir, fields)


def q_cli_daily_revenue(spark, sf_dir):
    return cli.daily_revenue(_cli_input(spark, sf_dir))


def q_cli_top_sellers(spark, sf_dir):
    return cli.top_sellers(_cli_input(spark, sf_dir, with_date=False))


def q_cli_top_products(spark, sf_dir):
    return cli.top_products(_cli_input(spark, sf_dir, with_date=False))


def q_rolling_7row_revenue(spark, sf_dir):
    return cli.rolling_rows_revenue(_cli_input(spark, sf_dir))


def q_rolling_7day_revenue(spark, sf_dir):
    return cli.rolling_days_revenue(_cli_input(spark, sf_dir))


def q_canonical_sales(spark, sf_dir):
    return canonicalise(renamed_view(spark, sf_dir)).select(*CANONICAL_COLUMNS, "region")


def q_canonical_defaults(spark, sf_dir):
    v = sales_view(spark, sf_dir, ("order_id", "customer_id", "region"))
    return canonicalise(v).select(*CANONICAL_COLUMNS, "region")


def q_derived_price(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    raw_rows = li.join(part, li.l_partkey == part.p_partkey, "left").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_quantity").alias("qty"),
    )
    return canonicalise(raw_rows).select(
        "order_id", "line_number", "product_id_canon", "total_price", "quantity"
    )


def q_chart_revenue_timeseries(spark, sf_dir):
    return charts.revenue_timeseries(cli.daily_revenue(_cli_input(spark, sf_dir)))


def q_chart_top_categories(spark, sf_dir):
    return charts.top_categories_chart(q_top_categories(spark, sf_dir))


def q_preview_daily(spark, sf_dir):
    return marts.preview(q_daily_aggregates(spark, sf_dir))


def q_schema_preview(spark, sf_dir):
    return raw.schema_preview(renamed_view(spark, sf_dir))


def q_detected_columns(spark, sf_dir):
    return raw.detected_columns(renamed_view(spark, sf_dir))


def q_source_manifest(spark, sf_dir):
    return raw.source_manifest(table(spark, sf_dir, "lineitem")).select("file_name", "rows")


def q_clustered_layout(spark, sf_dir):
    """Publish the canonical rows clustered by (sale_date, seller, product) and read them back."""
    path = scratch_path(spark, "clustered-sales")
    cluster(q_canonical_sales(spark, sf_dir), path)
    return spark.read.parquet(path).select(*CANONICAL_COLUMNS, "region")


def q_stream_ingest(spark, sf_dir):
    """Events land as time-ordered CSV drops under another naming; the stream
    ingests them batch by batch and the sink is read back through its log."""
    base = scratch_path(spark, "stream-ingest")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("order_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("customer_id"),
        "event_type",
        F.col("value").alias("amount"),
    )
    drops = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        events.repartitionByRange(drops, "timestamp")
        .write.option("header", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(f"{base}/landing")
    )
    out = run_available(
        spark, f"{base}/landing", f"{base}/table", f"{base}/_checkpoint",
        fmt="csv", max_files_per_trigger=max(1, drops // 4),
    )
    return out.select(*CANONICAL_COLUMNS, "event_type")


# Header eras of the raw sales files: together they cover every row; each era
# names and orders the columns differently, as exports drift over time.
_ERAS = (
    ("until 1996", lambda y: y < 1997, {}),
    (
        "1997-1999",
        lambda y: (y >= 1997) & (y < 2000),
        {"order_date": "order_datetime", "total_price": "sale_amount", "quantity": "units",
         "product_id": "sku", "category": "department", "seller_id": "merchant"},
    ),
    (
        "2000 on (and undated)",
        lambda y: (y >= 2000) | y.isNull(),
        {"order_id": "Order_ID", "order_date": "Date", "total_price": "Revenue", "quantity": "QTY",
         "product_id": "asin", "category": "Category_Name", "seller_id": "Seller"},
    ),
)

DROP_ROWS = 1_000_000  # of a raw file at most


def _written(rows: DataFrame, path: str, *by: str) -> DataFrame:
    """``rows`` written once and read back, where several jobs need them."""
    rows.write.partitionBy(*by).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def q_batch_ingest(spark, sf_dir):
    """The batch job end to end: raw CSV drops with drifting headers -> per-layout
    read -> canonicalise -> publish (sale_date partitions) -> marts; returns the
    published table read back."""
    base = scratch_path(spark, "batch-ingest")  # also makes sure the checkpoint dir is set
    view = sales_view(spark, sf_dir)
    # each era is joined by itself, so neither the joined view nor the shuffles of all
    # its rows are on disk at once; drops are gzipped, and small as gzip is read whole
    with shuffles_dropped(spark):
        for i, (_, keep, names) in enumerate(_ERAS):
            cols = [F.col(c).alias(names.get(c, c)) for c in view.columns]
            if i == 1:
                cols.reverse()
            (
                view.where(keep(F.year("order_date"))).select(*cols)
                .write.mode("append").option("header", True)
                .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
                .option("compression", "gzip").option("zlib.compress.level", "THREE")
                .option("maxRecordsPerFile", DROP_ROWS)
                .csv(f"{base}/raw")
            )
    res = batch_ingest.run(spark, f"{base}/raw", f"{base}/table", f"{base}/marts", table_name=None, overwrite=True)
    return res.table.select(*CANONICAL_COLUMNS, "region")


# ------------------------------------------------- sinks, tables and jobs ---


def _published(spark, sf_dir, name: str):
    """The canonical rows published in two appends, the second with one more raw
    column, and registered after each; the table is read through the catalog."""
    path = scratch_path(spark, name)
    rows = q_canonical_sales(spark, sf_dir)
    old = F.year("sale_date") < 1996
    table_name = f"{name}_{path.rsplit('-', 1)[1]}"
    for part in (rows.where(old), rows.where(~old | old.isNull()).withColumn("promo", F.lit("p"))):
        publish(part, path, partition_by=None)
        register_table(spark, table_name, path)
    return spark.table(table_name)


def q_appended_table(spark, sf_dir):
    return _published(spark, sf_dir, "appended").select(*CANONICAL_COLUMNS, "region", "promo")


def q_registered_reports(spark, sf_dir):
    """The five SQL reports over the registered table, stacked."""
    sales = _published(spark, sf_dir, "registered")
    spark_name = f"reports_{scratch_path(spark, 'v').rsplit('-', 1)[1]}"
    sales.createOrReplaceTempView(spark_name)
    shapes = {
        "total_revenue_units": ("NULL", "NULL", "total_revenue", "total_units_sold"),
        "daily_revenue_365d": ("sale_date", "NULL", "revenue", "units_sold"),
        "top_products_20": ("product_id", "NULL", "revenue", "orders"),
        "seller_performance": ("seller_id", "NULL", "revenue", "orders"),
        "cohort_retention": ("cohort_month", "activity_month", "revenue", "active_customers"),
    }
    parts = [
        run_report(spark, name, spark_name, as_of="latest").selectExpr(
            f"'{name}' AS report", f"CAST({a} AS STRING) AS key", f"CAST({b} AS STRING) AS second_key", f"{m} AS revenue", f"{n} AS n"
        )
        for name, (a, b, m, n) in shapes.items()
    ]
    return reduce(lambda x, y: x.unionByName(y), parts)


def q_published_marts(spark, sf_dir):
    """The batch job's three marts, written and read back, stacked."""
    sales, root = q_canonical_sales(spark, sf_dir), scratch_path(spark, "marts")
    outputs = {
        "daily": (marts.daily_aggregates(sales), "sale_date", "orders"),
        "top_products": (marts.top_products_mart(sales), "product_id_canon", "NULL"),
        "top_categories": (marts.top_categories(sales), "category_canon", "NULL"),
    }
    parts = [
        spark.read.parquet(write_mart(df, root, name)).selectExpr(
            f"'{name}' AS mart", f"CAST({key} AS STRING) AS key", "revenue", f"CAST({n} AS BIGINT) AS orders"
        )
        for name, (df, key, n) in outputs.items()
    ]
    return reduce(lambda x, y: x.unionByName(y), parts)


def q_cli_job(spark, sf_dir):
    """The command-line job over raw CSV; its daily report with the rolling mean, read back."""
    base = scratch_path(spark, "cli-job")
    view = sales_view(spark, sf_dir, ("seller_id", "product_id", "order_date", "total_price", "quantity"))
    view.write.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{base}/raw")
    written = cli_report.run(spark, f"{base}/raw", f"{base}/out")
    schema = "date date, revenue double, units_sold long, rolling_7d_revenue double"
    return spark.read.schema(schema).option("header", True).csv(written["daily_with_rolling"])


def _two_files_a_date(spark, sf_dir, path):
    """The canonical rows in two appends, so that most dates have two files."""
    rows = q_canonical_sales(spark, sf_dir)
    half = F.coalesce(F.length("order_id"), F.lit(0)) % 2
    return [publish(rows.where(half == k), path) for k in (0, 1)]


def q_compacted_table(spark, sf_dir):
    """The whole table in small files, compacted: rows and files of each date
    afterwards, the NULL date included."""
    base = scratch_path(spark, "compact")
    _two_files_a_date(spark, sf_dir, f"{base}/many")
    out = compact(spark, f"{base}/many", f"{base}/few")
    files = spark.read.parquet(out).select("sale_date", F.col("_metadata.file_path").alias("file"))
    return files.groupBy("sale_date").agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files"))


def q_compacted_files(spark, sf_dir):
    """A registered table compacted in place, by plan: per date its rows, its files
    before and after, and whether a second run would rewrite it."""
    base = scratch_path(spark, "compact-table")
    name = f"compact_{base.rsplit('-', 1)[1]}"
    for written in _two_files_a_date(spark, sf_dir, f"{base}/table"):
        register_table(spark, name, f"{base}/table", written=written)

    def files_by_date(step):
        files = spark.table(name).select("sale_date", F.col("_metadata.file_path").alias("file"))
        counts = files.groupBy("sale_date").agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files"))
        counts.write.parquet(f"{base}/{step}")  # as of now: the catalog changes
        return spark.read.schema(counts.schema).parquet(f"{base}/{step}")

    before = files_by_date("before").withColumnRenamed("files", "files_before").drop("rows")
    compact_table(spark, name, f"{base}/compacted")
    after = files_by_date("after").withColumnRenamed("files", "files_after")
    again = compact_table(spark, name, f"{base}/again").partitions
    hit = of_dates(again).alias("rewritten_again")
    return after.join(before.withColumnRenamed("sale_date", "_date"), F.col("sale_date").eqNullSafe(F.col("_date"))).select(
        "sale_date", "rows", "files_before", "files_after", hit
    )


def q_incremental_marts(spark, sf_dir):
    """The three marts after two appends, each of which read the dates it wrote."""
    base = scratch_path(spark, "incremental")
    rows = q_canonical_sales(spark, sf_dir)
    old = F.coalesce(F.length("order_id"), F.lit(0)) % 3 == 0
    for part in (rows.where(old), rows.where(~old)):
        batch_ingest.refresh_states(spark, f"{base}/table", publish(part, f"{base}/table"), f"{base}/states")
    done = mart_states.finished(spark, f"{base}/states")
    shapes = {"daily": ("sale_date", "orders"), "top_products": ("product_id_canon", "NULL"), "top_categories": ("category_canon", "NULL")}
    parts = [
        done[name].selectExpr(f"'{name}' AS mart", f"CAST({key} AS STRING) AS key", "revenue", f"CAST({n} AS BIGINT) AS orders")
        for name, (key, n) in shapes.items()
    ]
    return reduce(lambda x, y: x.unionByName(y), parts)


def q_replaced_table(spark, sf_dir):
    """A table overwritten as one step, after a first version and before an append;
    read through its name."""
    root = scratch_path(spark, "versions")
    name = f"versions_{root.rsplit('-', 1)[1]}"
    # three writes by dates of the orders: the raw rows are joined once
    raw_rows = _written(renamed_view(spark, sf_dir), scratch_path(spark, "versions-raw"))
    rows = canonicalise(raw_rows).select(*CANONICAL_COLUMNS, "region")
    old = F.coalesce(F.year("sale_date") < 1996, F.lit(False))
    for part in (rows.where(~old), rows.where(old)):
        versions.replace_table(spark, name, root, part)
    versions.append_to(spark, name, rows.where(~old))
    return spark.table(name).select(*CANONICAL_COLUMNS, "region")


_CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def q_typed_stream(spark, sf_dir):
    """Events land in three drops; columns the stream was not told of get the type
    all their values have so far, which widens from drop to drop.  Each drop is read
    by a restarted stream."""
    base = scratch_path(spark, "typed")
    events = table(spark, sf_dir, "events")
    third = F.pmod(F.col("event_id"), F.lit(3))
    own = F.col("event_id").alias("order_id")
    drops = (
        events.where(third == 0).select(own, F.col("event_id").alias("points"), F.col("event_id").alias("label"), F.to_date("ts").alias("seen")),
        events.where(third == 1).select(own, F.col("value").alias("points"), F.col("event_type").alias("label"), F.col("ts").alias("seen")),
        events.where(third == 2).select(own, (F.col("event_id") % 2 == 0).alias("even")),
    )
    for drop in drops:
        drop.coalesce(2).write.mode("append").option("header", True).option("timestampNTZFormat", _CSV_TIME).csv(f"{base}/landing")
        out = run_available(spark, f"{base}/landing", f"{base}/table", f"{base}/_checkpoint")
    return out.select("order_id", "points", "label", "seen", "even")


SPARSE_NAMES = 211


def q_sparse_stream(spark, sf_dir):
    """JSON events that each carry one of many rare names: those share one column,
    from which every value can be read; the common name has a column of its own."""
    base = scratch_path(spark, "sparse")
    events = table(spark, sf_dir, "events").where("user_id is not null")
    text = lambda c: F.col(c).cast("string")
    rare = F.concat(F.lit("k"), F.pmod(F.col("event_id"), F.lit(SPARSE_NAMES)).cast("string"))
    record = F.create_map(F.lit("order_id"), text("event_id"), F.lit("kind"), text("event_type"), rare, text("user_id"))
    events.select(F.to_json(record).alias("value")).repartition(4, "value").write.text(f"{base}/landing")
    out = run_available(spark, f"{base}/landing", f"{base}/table", f"{base}/_checkpoint", fmt="json")
    width = F.lit(len(out.columns)).alias("width")
    return out.select("order_id", "kind", width, F.explode("extras").alias("name", "value"))


def q_drifting_stream(spark, sf_dir):
    """Events land in three drops whose headers differ; the last has no user, no
    amount and one column never seen before."""
    base = scratch_path(spark, "drift")
    events = table(spark, sf_dir, "events")
    third = F.pmod(F.col("event_id"), F.lit(3))
    eras = (
        events.where(third == 0).select(F.col("event_id").alias("order_id"), F.col("ts").alias("timestamp"), F.col("user_id").alias("customer_id"), F.col("value").alias("amount")),
        events.where(third == 1).select(F.col("value").alias("sale_amount"), F.col("ts").alias("order_datetime"), F.col("event_id").alias("Order_ID"), F.col("event_type").alias("category")),
        events.where(third == 2).select(F.col("event_id").alias("order_id"), F.col("event_type").alias("note"), F.col("ts").alias("order_date")),
    )
    for era in eras:
        era.coalesce(2).write.mode("append").option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{base}/landing")
    out = run_available(spark, f"{base}/landing", f"{base}/table", f"{base}/_checkpoint", max_files_per_trigger=2)
    return out.select("order_id", "customer_id", "order_ts", "total_price", "quantity", "category_canon", "note")


QUERIES: dict[str, Query] = {
    "total_revenue_units": q_total_revenue_units,
    "daily_aggregates": q_daily_aggregates,
    "daily_revenue_365d": q_daily_revenue_365d,
    "top_products_100": q_top_products_100,
    "top_products_20": q_top_products_20,
    "top_categories": q_top_categories,
    "seller_performance": q_seller_performance,
    "net_seller_performance": q_net_seller_performance,
    "first_purchase": q_first_purchase,
    "cohort_retention": q_cohort_retention,
    "revenue_by_region": q_revenue_by_region,
    "cli_daily_revenue": q_cli_daily_revenue,
    "cli_top_sellers": q_cli_top_sellers,
    "cli_top_products": q_cli_top_products,
    "rolling_7row_revenue": q_rolling_7row_revenue,
    "rolling_7day_revenue": q_rolling_7day_revenue,
    "canonical_sales": q_canonical_sales,
    "canonical_defaults": q_canonical_defaults,
    "derived_price": q_derived_price,
    "chart_revenue_timeseries": q_chart_revenue_timeseries,
    "chart_top_categories": q_chart_top_categories,
    "preview_daily": q_preview_daily,
    "schema_preview": q_schema_preview,
    "detected_columns": q_detected_columns,
    "source_manifest": q_source_manifest,
    "clustered_layout": q_clustered_layout,
    "stream_ingest": q_stream_ingest,
    "batch_ingest": q_batch_ingest,
    "appended_table": q_appended_table,
    "registered_reports": q_registered_reports,
    "published_marts": q_published_marts,
    "cli_job": q_cli_job,
    "compacted_files": q_compacted_files,
    "compacted_table": q_compacted_table,
    "drifting_stream": q_drifting_stream,
    "incremental_marts": q_incremental_marts,
    "replaced_table": q_replaced_table,
    "typed_stream": q_typed_stream,
    "sparse_stream": q_sparse_stream,
}


# ----------------------------------------------------------------- oracle ---

_SALES = f"WITH sales AS ({CANONICAL_SALES_SQL})\n"
_AMOUNT = "CAST(total_price AS DECIMAL(28,8))"


def _double(decimal: str) -> str:
    """A decimal as the nearest DOUBLE (the engine's direct cast is off in the last bit)."""
    return f"CAST(CAST({decimal} AS VARCHAR) AS DOUBLE)"


_MONEY = _double(f"SUM({_AMOUNT})")
_UNITS = "CAST(SUM(quantity) AS BIGINT)"

_DAILY_AMOUNTS = f"""
daily AS (
  SELECT sale_date AS date, SUM({_AMOUNT}) AS c, {_UNITS} AS units_sold
  FROM sales GROUP BY sale_date)
"""

ORACLE: dict[str, str] = {
    "total_revenue_units": _SALES
    + f"SELECT {_MONEY} AS total_revenue, {_UNITS} AS total_units_sold FROM sales",
    "daily_aggregates": _SALES
    + f"""SELECT sale_date, {_MONEY} AS revenue, {_UNITS} AS units_sold,
              COUNT(DISTINCT order_id) AS orders
       FROM sales GROUP BY sale_date ORDER BY sale_date NULLS FIRST""",
    "daily_revenue_365d": _SALES
    + f"""SELECT sale_date, {_MONEY} AS revenue, {_UNITS} AS units_sold
       FROM sales
       WHERE sale_date IS NOT NULL
         AND sale_date >= (SELECT MAX(sale_date) FROM sales) - 365
       GROUP BY sale_date ORDER BY sale_date""",
    "top_products_100": _SALES
    + f"""SELECT product_id_canon, {_MONEY} AS revenue
       FROM sales GROUP BY product_id_canon
       ORDER BY revenue DESC NULLS LAST, product_id_canon ASC NULLS FIRST LIMIT 100""",
    "top_products_20": _SALES
    + f"""SELECT product_id_canon AS product_id, {_MONEY} AS revenue,
              COUNT(DISTINCT order_id) AS orders
       FROM sales GROUP BY product_id_canon
       ORDER BY revenue DESC NULLS LAST, product_id ASC NULLS FIRST LIMIT 20""",
    "top_categories": _SALES
    + f"""SELECT category_canon, {_MONEY} AS revenue
       FROM sales GROUP BY category_canon
       ORDER BY revenue DESC NULLS LAST, category_canon ASC NULLS FIRST""",
    "seller_performance": _SALES
    + f"""SELECT seller_canon AS seller_id, COUNT(*) AS orders, {_MONEY} AS revenue,
              {_MONEY} / COUNT({_AMOUNT}) AS avg_order_value
       FROM sales GROUP BY seller_canon
       ORDER BY revenue DESC NULLS LAST, seller_id ASC NULLS FIRST LIMIT 50""",
    "net_seller_performance": f"""
       WITH sales AS (SELECT CAST(l_suppkey AS VARCHAR) AS seller_id, l_extendedprice * (1 - l_discount) AS total_price FROM lineitem)
       SELECT seller_id, COUNT(*) AS orders, {_MONEY} AS revenue, {_MONEY} / COUNT({_AMOUNT}) AS avg_order_value
       FROM sales GROUP BY seller_id
       ORDER BY revenue DESC NULLS LAST, seller_id ASC NULLS FIRST LIMIT 50""",
    "first_purchase": _SALES
    + "SELECT customer_id, MIN(sale_date) AS first_date FROM sales GROUP BY customer_id",
    "cohort_retention": _SALES
    + f""", per_month AS (
         SELECT customer_id, CAST(date_trunc('month', sale_date) AS DATE) AS activity_month, SUM({_AMOUNT}) AS amount
         FROM sales WHERE customer_id IS NOT NULL GROUP BY ALL)
       SELECT cohort_month, activity_month, COUNT(*) AS active_customers, {_double('SUM(amount)')} AS revenue
       FROM (SELECT *, MIN(activity_month) OVER (PARTITION BY customer_id) AS cohort_month FROM per_month)
       GROUP BY ALL ORDER BY 1 NULLS FIRST, 2 NULLS FIRST""",
    "revenue_by_region": _SALES
    + f"""SELECT region, {_MONEY} AS revenue FROM sales GROUP BY region
       ORDER BY revenue DESC NULLS LAST, region ASC NULLS FIRST""",
    "cli_daily_revenue": _SALES
    + f"""SELECT sale_date AS date, {_MONEY} AS revenue, {_UNITS} AS units_sold
       FROM sales GROUP BY sale_date ORDER BY date NULLS FIRST""",
    "cli_top_sellers": _SALES
    + f"""SELECT seller_canon AS seller_id, {_MONEY} AS revenue FROM sales
       GROUP BY seller_canon ORDER BY revenue DESC NULLS LAST, seller_id ASC NULLS FIRST LIMIT 100""",
    "cli_top_products": _SALES
    + f"""SELECT product_id_canon AS product_id, {_MONEY} AS revenue FROM sales
       GROUP BY product_id_canon ORDER BY revenue DESC NULLS LAST, product_id ASC NULLS FIRST LIMIT 200""",
    "rolling_7row_revenue": _SALES
    + ","
    + _DAILY_AMOUNTS
    + f"""SELECT date, {_double('c')} AS revenue, units_sold,
              {_double('SUM(c) OVER w')} / COUNT(c) OVER w AS rolling_7d_revenue
       FROM daily
       WINDOW w AS (ORDER BY date ASC NULLS FIRST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
       ORDER BY date NULLS FIRST""",
    "rolling_7day_revenue": _SALES
    + ","
    + _DAILY_AMOUNTS
    + f"""SELECT date, {_double('c')} AS revenue, units_sold,
              {_double('SUM(c) OVER w')} / COUNT(c) OVER w AS rolling_7d_revenue
       FROM daily
       WHERE date IS NOT NULL
       WINDOW w AS (ORDER BY date - DATE '1970-01-01' RANGE BETWEEN 6 PRECEDING AND CURRENT ROW)
       ORDER BY date""",
    "canonical_sales": _SALES
    + """SELECT order_id, customer_id, order_ts, sale_date, total_price, quantity,
              product_id_canon, category_canon, seller_canon, region
       FROM sales""",
    "canonical_defaults": _SALES
    + """SELECT order_id, customer_id,
              CAST(NULL AS TIMESTAMP) AS order_ts, CAST(NULL AS DATE) AS sale_date,
              CAST(0.0 AS DOUBLE) AS total_price, CAST(1 AS BIGINT) AS quantity,
              CAST(NULL AS VARCHAR) AS product_id_canon, 'unknown' AS category_canon,
              CAST(NULL AS VARCHAR) AS seller_canon, region
       FROM sales""",
    "derived_price": """
       SELECT CAST(l.l_orderkey AS VARCHAR) AS order_id, l.l_linenumber AS line_number,
              CAST(l.l_partkey AS VARCHAR) AS product_id_canon,
              p.p_retailprice * l.l_quantity AS total_price,
              CAST(trunc(l.l_quantity) AS BIGINT) AS quantity
       FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    "chart_revenue_timeseries": _SALES
    + f"""SELECT sale_date AS date, {_MONEY} AS revenue FROM sales
       GROUP BY sale_date ORDER BY date NULLS LAST""",
    "chart_top_categories": _SALES
    + f"""SELECT category_canon AS category, {_MONEY} AS revenue FROM sales
       GROUP BY category_canon ORDER BY revenue DESC NULLS LAST, category ASC NULLS FIRST LIMIT 20""",
    "preview_daily": _SALES
    + f"""SELECT sale_date, {_MONEY} AS revenue, {_UNITS} AS units_sold,
              COUNT(DISTINCT order_id) AS orders
       FROM sales GROUP BY sale_date ORDER BY sale_date NULLS FIRST LIMIT 50""",
    "detected_columns": f"WITH v AS ({SALES_VIEW_SQL})\n"
    + """SELECT 'order_ts' AS canonical, 'order_datetime' AS matched_column,
              COUNT(order_date) AS non_null_rows FROM v
       UNION ALL SELECT 'total_price', 'revenue', COUNT(total_price) FROM v
       UNION ALL SELECT 'unit_price', CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT)
       UNION ALL SELECT 'quantity', 'units', COUNT(quantity) FROM v
       UNION ALL SELECT 'product_id_canon', 'sku', COUNT(product_id) FROM v
       UNION ALL SELECT 'category_canon', 'department', COUNT(category) FROM v
       UNION ALL SELECT 'seller_canon', 'merchant', COUNT(seller_id) FROM v
       UNION ALL SELECT 'order_id', 'order_id', COUNT(order_id) FROM v
       UNION ALL SELECT 'customer_id', 'customer_id', COUNT(customer_id) FROM v""",
    "source_manifest": "SELECT 'lineitem.parquet' AS file_name, COUNT(*) AS rows FROM lineitem",
    "clustered_layout": _SALES
    + """SELECT order_id, customer_id, order_ts, sale_date, total_price, quantity,
              product_id_canon, category_canon, seller_canon, region
       FROM sales""",
    "batch_ingest": _SALES
    + """SELECT order_id, customer_id, order_ts, sale_date, total_price, quantity,
              product_id_canon, category_canon, seller_canon, region
       FROM sales""",
    "stream_ingest": """
       SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
              ts AS order_ts, CAST(ts AS DATE) AS sale_date, value AS total_price,
              CAST(1 AS BIGINT) AS quantity, CAST(NULL AS VARCHAR) AS product_id_canon,
              'unknown' AS category_canon, CAST(NULL AS VARCHAR) AS seller_canon, event_type
       FROM events""",
}


def _stacked(first: str, parts: dict[str, tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS {first}, {cols} FROM ({sql})" for name, (cols, sql) in parts.items())


_PREVIEW = (
    ("order_id", "order_id", "string"), ("customer_id", "customer_id", "string"), ("sku", "product_id", "string"),
    ("merchant", "seller_id", "string"), ("order_datetime", "order_date", "timestamp_ntz"), ("department", "category", "string"),
    ("region", "region", "string"), ("units", "quantity", "double"), ("revenue", "total_price", "double"),
)

ORACLE |= {
    "replaced_table": ORACLE["canonical_sales"],
    "typed_stream": """
       SELECT CAST(event_id AS VARCHAR) AS order_id,
              CASE event_id % 3 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN value END AS points,
              CASE event_id % 3 WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN event_type END AS label,
              CASE event_id % 3 WHEN 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) WHEN 1 THEN CAST(ts AS TIMESTAMP) END AS seen,
              CASE event_id % 3 WHEN 2 THEN event_id % 2 = 0 END AS even
       FROM events""",
    "sparse_stream": f"""
       SELECT CAST(event_id AS VARCHAR) AS order_id, event_type AS kind, CAST({len(CANONICAL_COLUMNS) + 2} AS INTEGER) AS width,
              'k' || CAST(event_id % {SPARSE_NAMES} AS VARCHAR) AS name, CAST(user_id AS VARCHAR) AS value
       FROM events WHERE user_id IS NOT NULL""",
    "schema_preview": f"WITH v AS ({SALES_VIEW_SQL})\n"
    + " UNION ALL ".join(
        f"""SELECT CAST({i} AS INTEGER) AS position, '{name}' AS column, '{kind}' AS data_type,
                   COUNT(*) - COUNT({source}) AS nulls, MIN(CAST({source} AS VARCHAR)) AS smallest FROM v"""
        for i, (name, source, kind) in enumerate(_PREVIEW)
    ),
    "appended_table": ORACLE["canonical_sales"].replace(
        "seller_canon, region", "seller_canon, region, CASE WHEN year(sale_date) < 1996 THEN NULL ELSE 'p' END AS promo"
    ),
    "registered_reports": _stacked(
        "report",
        {
            "total_revenue_units": ("NULL::VARCHAR AS key, NULL::VARCHAR AS second_key, total_revenue AS revenue, total_units_sold AS n", ORACLE["total_revenue_units"]),
            "daily_revenue_365d": ("sale_date::VARCHAR, NULL, revenue, units_sold", ORACLE["daily_revenue_365d"]),
            "top_products_20": ("product_id, NULL, revenue, orders", ORACLE["top_products_20"]),
            "seller_performance": ("seller_id, NULL, revenue, orders", ORACLE["seller_performance"]),
            "cohort_retention": ("cohort_month::VARCHAR, activity_month::VARCHAR, revenue, active_customers", ORACLE["cohort_retention"]),
        },
    ),
    "published_marts": _stacked(
        "mart",
        {
            "daily": ("sale_date::VARCHAR AS key, revenue, orders", ORACLE["daily_aggregates"]),
            "top_products": ("product_id_canon, revenue, NULL", ORACLE["top_products_100"]),
            "top_categories": ("category_canon, revenue, NULL", ORACLE["top_categories"]),
        },
    ),
    "cli_job": ORACLE["rolling_7row_revenue"],
    "compacted_files": _SALES
    + """SELECT sale_date, COUNT(*) AS rows, COUNT(DISTINCT COALESCE(length(order_id), 0) % 2) AS files_before,
              CAST(1 AS BIGINT) AS files_after, false AS rewritten_again
       FROM sales GROUP BY sale_date""",
    "compacted_table": _SALES + "SELECT sale_date, COUNT(*) AS rows, CAST(1 AS BIGINT) AS files FROM sales GROUP BY sale_date",
    "drifting_stream": """
       SELECT CAST(event_id AS VARCHAR) AS order_id,
              CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS VARCHAR) END AS customer_id, ts AS order_ts,
              CASE WHEN event_id % 3 < 2 THEN value ELSE 0.0 END AS total_price, CAST(1 AS BIGINT) AS quantity,
              CASE WHEN event_id % 3 = 1 THEN event_type ELSE 'unknown' END AS category_canon,
              CASE WHEN event_id % 3 = 2 THEN event_type END AS note
       FROM events""",
}

ORACLE["incremental_marts"] = ORACLE["published_marts"]
