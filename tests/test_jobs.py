import os

import pytest

from ledgerline.plans import batch_ingest, cli_report
from ledgerline.operators.cli import CliColumns

from . import fixtures as fx


def test_batch_ingest_end_to_end(spark, scratch):
    src = os.path.join(scratch, "raw")
    for i, text in enumerate([fx.F1, fx.F2, fx.F5]):
        fx.write(src, f"f{i}.csv", text)
    res = batch_ingest.run(
        spark, src, os.path.join(scratch, "table"), os.path.join(scratch, "marts"),
        table_name="ingest_test_sales", overwrite=True,
    )
    assert res.partition_columns == ["sale_date"]
    assert spark.table("ingest_test_sales").count() == 6
    daily = spark.read.parquet(res.marts["daily"])
    assert daily.count() == 4 and {"sale_date", "revenue", "units_sold", "orders"} <= set(daily.columns)
    cats = {r["category_canon"]: r["revenue"] for r in spark.read.parquet(res.marts["top_categories"]).collect()}
    assert cats["toys"] == 10.5 + 15.75 + 3.0
    det = {r["canonical"]: r["matched_column"] for r in res.detected.collect()}
    assert det["order_ts"] == "order_date"
    assert res.preview.count() > 0
    spark.sql("DROP TABLE ingest_test_sales")


def test_batch_ingest_validates_before_writing(spark, scratch):
    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", "customer_id,total_price\nc1,1.0\n")
    out = os.path.join(scratch, "table")
    with pytest.raises(ValueError, match="order_id"):
        batch_ingest.run(spark, src, out, os.path.join(scratch, "marts"), table_name=None)
    assert not os.path.exists(out)


def test_cli_report_job(spark, scratch):
    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F1)
    fx.write(src, "b.csv", fx.F5)
    written = cli_report.run(spark, src, os.path.join(scratch, "reports"))
    assert set(written) == {"daily_revenue", "top_sellers", "top_products", "daily_with_rolling"}
    daily = spark.read.option("header", True).csv(written["daily_revenue"]).collect()
    assert len(daily) == 3
    with pytest.raises(ValueError, match="no_such"):
        cli_report.run(spark, src, os.path.join(scratch, "r2"), CliColumns(price_col="no_such"))


def test_charts_read_back_cli_marts(spark, scratch):
    """S10: the chart selections read the CSV report folders the CLI job wrote."""
    from ledgerline.operators import charts

    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F1)
    fx.write(src, "b.csv", fx.F5)
    written = cli_report.run(spark, src, os.path.join(scratch, "reports"))
    daily = spark.read.option("header", True).csv(written["daily_revenue"])
    series = [(d.isoformat(), v) for d, v in charts.revenue_timeseries(daily).collect()]
    assert series == [("2024-01-01", 15.75), ("2024-01-02", 15.75), ("2024-01-05", 9.99)]
    top = spark.read.option("header", True).csv(written["top_products"])
    chart = charts.top_categories_chart(top, top_n=1).collect()
    assert chart[0]["category"] == "p1" and chart[0]["revenue"] == 26.25


def test_cli_entry_point_as_a_process(scratch):
    """``python -m ledgerline.plans.cli_report`` with named columns, own session."""
    import subprocess
    import sys

    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F3)  # date / unit_price / qty names
    out = os.path.join(scratch, "reports")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run(
        [sys.executable, "-m", "ledgerline.plans.cli_report", "--input", src, "--output", out,
         "--datecol", "date", "--pricecol", "unit_price", "--qtycol", "qty"],
        cwd=root, capture_output=True, text=True, timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    names = sorted(os.listdir(out))
    assert names == ["daily_revenue", "daily_with_rolling", "top_products", "top_sellers"]
    lines = [ln for f in os.listdir(os.path.join(out, "daily_revenue")) if f.endswith(".csv")
             for ln in open(os.path.join(out, "daily_revenue", f)).read().splitlines()]
    assert "date,revenue,units_sold" in lines and "2024-01-04,2.5,4" in lines


def test_cli_job_parses_the_raw_files_once(spark, scratch, monkeypatch):
    from ledgerline.operators import cli

    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F1)
    seen = []
    for name in ("daily_revenue", "top_sellers", "top_products", "rolling_rows_revenue"):
        real = getattr(cli, name)
        monkeypatch.setattr(cli, name, lambda df, cols, real=real: seen.append(df.inputFiles()) or real(df, cols))
    cli_report.run(spark, src, os.path.join(scratch, "reports"))
    assert len(seen) == 4 and all(f.endswith(".parquet") for files in seen for f in files)


def test_columns_of_a_later_append_are_visible(spark, scratch):
    src, out = os.path.join(scratch, "raw"), os.path.join(scratch, "table")
    fx.write(src, "a.csv", fx.F1)
    batch_ingest.run(spark, src, out, os.path.join(scratch, "m"), table_name="append_test_sales", overwrite=True)
    later = os.path.join(scratch, "later")
    fx.write(later, "b.csv", "order_id,order_date,total_price,promo x\n77,2024-02-01,2.5,P1\n")
    res = batch_ingest.run(spark, later, out, os.path.join(scratch, "m"), table_name="append_test_sales")
    for df in (res.table, spark.table("append_test_sales")):
        assert {r["order_id"]: r["promo x"] for r in df.collect()}["77"] == "P1"
        assert df.count() == 4
    spark.sql("DROP TABLE append_test_sales")
