"""Physical-plan shape: pruning, pushdown, join avoidance, partial aggregation,
top-k fusion.  These are the properties the 100 TB design relies on."""

import datetime as dt
import os

from ledgerline.operators import marts, reports
from ledgerline.plans.registry import QUERIES
from ledgerline.sinks.tables import publish
from ledgerline.sources.files import read_sales_csv

from . import fixtures as fx
from .conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schemas(p: str) -> list[str]:
    return [seg.split("ReadSchema: ")[1].split("\n")[0] for seg in p.split("FileScan")[1:] if "ReadSchema: " in seg]


def test_single_table_reports_do_not_join(spark):
    for key in ("total_revenue_units", "top_products_100", "top_products_20", "seller_performance",
                "cli_top_sellers", "cli_top_products"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        assert "Join" not in p, key
        assert len(read_schemas(p)) == 1, key  # lineitem only


def test_scan_reads_only_used_columns(spark):
    p = plan(QUERIES["top_products_100"](spark, SF_SMALL))
    schemas = read_schemas(p)
    assert schemas == ["struct<l_partkey:bigint,l_extendedprice:double>"]


def test_partial_aggregation_before_every_shuffle(spark):
    for key in ("daily_aggregates", "top_categories", "revenue_by_region", "cohort_retention"):
        p = plan(QUERIES[key](spark, SF_SMALL))
        assert "partial_" in p, key


def test_top_k_is_fused(spark):
    for key in ("top_products_20", "seller_performance", "cli_top_products", "chart_top_categories"):
        assert "TakeOrderedAndProject" in plan(QUERIES[key](spark, SF_SMALL)), key


def test_dimension_join_is_size_checked_broadcast_at_small_scale(spark):
    p = plan(QUERIES["revenue_by_region"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p  # Spark's own size estimate chose it; no hint in our code


def test_trailing_window_prunes_partitions_of_published_table(spark, scratch):
    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F1)
    fx.write(src, "b.csv", fx.F2)
    out = os.path.join(scratch, "table")
    publish(read_sales_csv(spark, src), out)
    t = spark.read.parquet(out)
    df = reports.daily_revenue_trailing(t, 1, as_of=dt.date(2024, 1, 3))
    p = plan(df)
    assert "PartitionFilters: [isnotnull(sale_date" in p and "2024-01-02" in p
    assert [r["sale_date"] for r in df.collect()] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]


def test_marts_on_published_table_prune_columns(spark, scratch):
    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F1)
    out = os.path.join(scratch, "table")
    publish(read_sales_csv(spark, src), out)
    p = plan(marts.top_categories(spark.read.parquet(out)))
    assert read_schemas(p) == ["struct<total_price:double,category_canon:string>"]


def test_latest_trailing_window_prunes_at_runtime(spark, scratch):
    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F1)
    fx.write(src, "b.csv", fx.F2)
    out = os.path.join(scratch, "table")
    publish(read_sales_csv(spark, src), out)
    df = reports.daily_revenue_trailing(spark.read.parquet(out), 1, as_of="latest")
    assert [r["sale_date"] for r in df.collect()] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    p = plan(df)
    assert "PartitionFilters: [isnotnull(sale_date" in p and "subquery" in p.lower()
    assert "Window" not in p


def test_without_broadcast_the_view_falls_back_to_sort_merge_with_equal_results(spark):
    keys = ("revenue_by_region", "top_categories", "cohort_retention")
    small = {k: [tuple(r) for r in QUERIES[k](spark, SF_SMALL).collect()] for k in keys}
    confs = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {c: spark.conf.get(c, None) for c in confs}
    try:
        for c in confs:
            spark.conf.set(c, "-1")  # as at 100 TB: the lookup sides exceed any threshold
        for k in keys:
            df = QUERIES[k](spark, SF_SMALL)
            p = plan(df)
            assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p, k
            assert [tuple(r) for r in df.collect()] == small[k], k
    finally:
        for c, v in old.items():
            if v is None:
                spark.conf.unset(c)
            else:
                spark.conf.set(c, v)
