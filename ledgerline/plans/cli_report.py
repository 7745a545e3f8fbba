"""Command-line report job: daily revenue, top sellers, top products and the
rolling mean, written as headered CSV report folders.

    spark-submit -m ledgerline.plans.cli_report --input <csv folder> --output <dir>
        [--datecol order_date] [--pricecol total_price] [--qtycol quantity]

The input folder is read per header layout and aligned by column name, so
files with reordered columns are still read correctly.  Missing named columns
fail before any output is written.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..functions.resolve import first_existing
from ..operators import cli
from ..session import scratch_path
from ..sinks.tables import write_mart
from ..sources.files import read_raw_by_header
from ..spec import CLI_PRODUCT_ALIASES, SELLER_ALIASES


def run(spark: SparkSession, input_path: str, output_path: str, cols: cli.CliColumns = cli.CliColumns()) -> dict[str, str]:
    raw = read_raw_by_header(spark, input_path)
    cli.require_columns(raw, cols)
    # the raw files are parsed once, into a narrow table all reports read
    keys = [k for k in (first_existing(a, raw.columns) for a in (SELLER_ALIASES, CLI_PRODUCT_ALIASES)) if k]
    narrow = cli.coerce_named(raw, cols).select("date", "price_num", "qty_num", *[f"`{k}`" for k in dict.fromkeys(keys)])
    path = scratch_path(spark, "cli-sales")
    narrow.write.parquet(path)
    df, cols = spark.read.parquet(path), cli.CliColumns("date", "price_num", "qty_num")
    outputs = {
        "daily_revenue": cli.daily_revenue(df, cols),
        "top_sellers": cli.top_sellers(df, cols),
        "top_products": cli.top_products(df, cols),
        "daily_with_rolling": cli.rolling_rows_revenue(df, cols),
    }
    return {
        name: write_mart(out, output_path, name, fmt="csv")
        for name, out in outputs.items()
        if out is not None  # no seller/product column: that report is skipped
    }


def main(argv=None) -> int:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--datecol", default="order_date")
    p.add_argument("--pricecol", default="total_price")
    p.add_argument("--qtycol", default="quantity")
    a = p.parse_args(argv)
    from ..session import build_session

    spark = build_session(app_name="sales-cli-report")
    try:
        run(spark, a.input, a.output, cli.CliColumns(a.datecol, a.pricecol, a.qtycol))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
