"""Report properties and NULL rules on hand-made canonical rows."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import charts, cli, marts, reports
from ledgerline.plans.sql_reports import run_report
from ledgerline.plans.registry import canonical

from . import fixtures as fx
from .conftest import SF_SMALL

D = dt.date


def _cohort_rows(spark):
    # three customers over three months, one NULL customer, one NULL date (F12)
    rows = [
        ("o1", "a", D(2024, 1, 5), 10.0),
        ("o2", "a", D(2024, 2, 5), 20.0),
        ("o3", "b", D(2024, 2, 9), 5.5),
        ("o4", "b", D(2024, 3, 1), 1.25),
        ("o5", "c", D(2024, 3, 3), 2.0),
        ("o6", None, D(2024, 1, 1), 100.0),
        ("o7", "c", None, 3.0),
        ("o8", "d", None, 4.0),
        ("o9", "a", D(2024, 1, 20), None),
    ]
    return spark.createDataFrame(rows, "order_id string, customer_id string, sale_date date, total_price double")


def test_cohort_matches_join_formulation(spark):
    s = _cohort_rows(spark)
    s.createOrReplaceTempView("cohort_fixture")
    ours = [tuple(r) for r in reports.cohort_retention(s).collect()]
    sql = [tuple(r) for r in run_report(spark, "cohort_retention", "cohort_fixture").collect()]
    assert ours == sql
    # NULL customer dropped; all-NULL-date customer gives (NULL, NULL)
    assert (None, None, 1, 4.0) in ours
    assert (D(2024, 1, 1), D(2024, 1, 1), 1, 10.0) in ours  # o9's NULL price ignored


def test_cohort_plan_has_no_join(spark):
    plan = reports.cohort_retention(_cohort_rows(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_sums_agree_across_reports(spark):
    s = canonical(spark, SF_SMALL, ("order_id", "order_date", "category", "product_id", "total_price", "quantity"))
    total = reports.total_revenue_units(s).first()
    daily = marts.daily_aggregates(s).agg(F.sum("revenue"), F.sum("units_sold")).first()
    cats = marts.top_categories(s).agg(F.sum("revenue")).first()
    assert abs(daily[0] - total["total_revenue"]) < 1e-6 and daily[1] == total["total_units_sold"]
    assert abs(cats[0] - total["total_revenue"]) < 1e-6


def test_top_k_is_prefix_of_full_ranking(spark):
    s = canonical(spark, SF_SMALL, ("product_id", "total_price"))
    top = [tuple(r) for r in marts.top_products_mart(s, 10).collect()]
    full = [tuple(r) for r in marts.top_products_mart(s, 10_000).collect()]
    assert top == full[:10]


def test_trailing_window_as_of(spark):
    rows = [("o1", D(2024, 1, 1), 1.0, 1), ("o2", D(2024, 12, 31), 2.0, 1), ("o3", D(2025, 1, 1), 3.0, 1),
            ("o4", None, 4.0, 1), ("o5", D(2023, 12, 31), 5.0, 1)]
    s = spark.createDataFrame(rows, "order_id string, sale_date date, total_price double, quantity long")
    got = [r["sale_date"] for r in reports.daily_revenue_trailing(s, 365, as_of="2024-12-31").collect()]
    assert got == [D(2024, 1, 1), D(2024, 12, 31), D(2025, 1, 1)]  # inclusive lower bound, no upper bound
    latest = [r["sale_date"] for r in reports.daily_revenue_trailing(s, 365, as_of="latest").collect()]
    assert latest == [D(2024, 12, 31), D(2025, 1, 1)]  # newest day 2025-01-01 -> from 2024-01-02
    s.createOrReplaceTempView("trail_fixture")
    sql = [r["sale_date"] for r in run_report(spark, "daily_revenue_365d", "trail_fixture", as_of="2024-12-31").collect()]
    assert sql == got
    sql_latest = [r["sale_date"] for r in run_report(spark, "daily_revenue_365d", "trail_fixture", as_of="latest").collect()]
    assert sql_latest == latest


def test_sql_reports_equal_dataframe_reports(spark):
    s = canonical(spark, SF_SMALL, ("order_id", "customer_id", "order_date", "product_id", "seller_id", "total_price", "quantity"))
    s.createOrReplaceTempView("sales_small")
    pairs = [
        ("total_revenue_units", reports.total_revenue_units(s)),
        ("top_products_20", reports.top_products(s)),
        ("seller_performance", reports.seller_performance(s)),
        ("cohort_retention", reports.cohort_retention(s)),
    ]
    for name, df in pairs:
        assert [tuple(r) for r in run_report(spark, name, "sales_small").collect()] == [tuple(r) for r in df.collect()], name


def test_rolling_rows_vs_days_with_gaps_and_null(spark):
    # dates with gaps and one NULL date
    rows = [("2024-01-01", "10"), ("2024-01-02", "20"), ("2024-01-10", "30"), (None, "40")]
    raw = spark.createDataFrame(rows, "order_date string, total_price string").withColumn("quantity", F.lit("1"))
    by_rows = {r["date"]: r["rolling_7d_revenue"] for r in cli.rolling_rows_revenue(raw).collect()}
    by_days = {r["date"]: r["rolling_7d_revenue"] for r in cli.rolling_days_revenue(raw).collect()}
    assert by_rows[None] == 40.0  # the NULL date sorts first and opens the row frame
    assert by_rows[D(2024, 1, 1)] == 25.0 and by_rows[D(2024, 1, 10)] == 25.0
    assert None not in by_days
    assert by_days[D(2024, 1, 2)] == 15.0 and by_days[D(2024, 1, 10)] == 30.0  # 2024-01-01..02 out of range


def test_cli_missing_column_is_a_clear_error(spark):
    raw = spark.createDataFrame([("2024-01-01", "1")], "order_date string, quantity string")
    try:
        cli.daily_revenue(raw)
    except ValueError as e:
        assert "total_price" in str(e)
    else:
        raise AssertionError("expected a ValueError")


def test_cli_top_outputs_skip_without_column(spark):
    raw = spark.createDataFrame([("2024-01-01", "1", "1")], "order_date string, quantity string, total_price string")
    assert cli.top_sellers(raw) is None and cli.top_products(raw) is None


def test_charts(spark):
    daily = spark.createDataFrame([("2024-01-02", 2.0), ("bad", 1.0), ("2024-01-01", 3.0)], "ds string, y double")
    ts = [tuple(r) for r in charts.revenue_timeseries(daily).collect()]
    assert ts == [(D(2024, 1, 1), 3.0), (D(2024, 1, 2), 2.0), (None, 1.0)]
    # 25 categories -> top 20
    cats = spark.createDataFrame([(f"c{i:02d}", float(i)) for i in range(25)], "category_canon string, revenue double")
    top = charts.top_categories_chart(cats).collect()
    assert len(top) == 20 and top[0]["category"] == "c24" and top[-1]["category"] == "c05"


def test_region_requires_column(spark):
    s = fx.sales_frame(spark, [("o1", "c", D(2024, 1, 1), 1.0, 1, "p", "k", "s")])
    try:
        reports.revenue_by_region(s)
    except ValueError as e:
        assert "region" in str(e)
    else:
        raise AssertionError("expected a ValueError")
