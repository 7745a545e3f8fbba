import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.resolve import first_existing, resolve
from ledgerline.operators.canonical import canonicalise, validate_required
from ledgerline.sources.files import read_csv_layout, read_sales_csv
from ledgerline.spec import BATCH_SPEC, CANONICAL_COLUMNS, CLI_PRODUCT_ALIASES, STREAM_SPEC

from . import fixtures as fx


def _one_layout(spark, scratch, text, name="f.csv"):
    fx.write(scratch, name, text)
    return read_sales_csv(spark, scratch)


def _rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy("order_id").collect()]


def test_first_existing_order_and_case():
    assert first_existing(["a", "b"], ["B", "a"]) == "a"
    assert first_existing(["x", "total_price"], [" Total_Price "]) == " Total_Price "
    assert first_existing(["x"], ["y"]) is None
    # the CLI product list prefers product_title over product
    assert first_existing(CLI_PRODUCT_ALIASES, ["product", "product_title"]) == "product_title"
    assert first_existing(BATCH_SPEC.product, ["product", "product_title"]) == "product"


def test_first_alias_everywhere(spark, scratch):
    df = _one_layout(spark, scratch, fx.F1)
    assert df.columns[-len(CANONICAL_COLUMNS):] == list(CANONICAL_COLUMNS)
    got = _rows(df, "order_id", "sale_date", "total_price", "quantity", "product_id_canon", "category_canon", "seller_canon")
    assert got[0] == ("1", dt.date(2024, 1, 1), 10.5, 2, "p1", "toys", "s1")
    assert len(got) == 3


def test_other_aliases(spark, scratch):
    df = _one_layout(spark, scratch, fx.F2)
    got = _rows(df, "order_id", "order_ts", "total_price", "quantity", "product_id_canon", "category_canon", "seller_canon")
    assert got[0] == ("4", dt.datetime(2024, 1, 3, 10, 0), 7.0, 1, "p3", "garden", "s3")


def test_derived_price(spark, scratch):
    df = _one_layout(spark, scratch, fx.F3)
    r = df.first()
    assert r["total_price"] == 10.0 and r["quantity"] == 4
    assert r["product_id_canon"] == "Widget" and r["category_canon"] == "tools" and r["seller_canon"] == "s2"


def test_every_default(spark, scratch):
    df = _one_layout(spark, scratch, fx.F4)
    r = df.orderBy("order_id").first()
    assert r["order_ts"] is None and r["sale_date"] is None
    assert r["total_price"] == 0.0 and r["quantity"] == 1
    assert r["product_id_canon"] is None and r["seller_canon"] is None
    assert r["category_canon"] == "unknown"
    types = dict(df.dtypes)
    assert types["quantity"] == "bigint" and types["order_ts"] == "timestamp" and types["sale_date"] == "date"


def test_mixed_case_padded_headers(spark, scratch):
    df = _one_layout(spark, scratch, fx.F6)
    r = df.first()
    assert r["order_id"] == "10" and r["total_price"] == 12.0 and r["quantity"] == 3
    assert r["category_canon"] == "toys" and r["seller_canon"] == "s1"
    assert r["sale_date"] == dt.date(2024, 1, 6)
    # replaced raw columns are not duplicated (case-insensitive)
    lowered = [c.strip().lower() for c in df.columns]
    assert len(lowered) == len(set(lowered))


def test_lenient_coercion_keeps_ids_as_text(spark, scratch):
    df = _one_layout(spark, scratch, fx.F7)
    got = {r["order_id"]: r for r in df.collect()}
    assert set(got) == {"00012", "00013", "00014", "00015"}
    assert got["00012"]["quantity"] == 12 and got["00012"]["total_price"] is None  # '12.5' -> 12, 'oops' -> NULL
    assert got["00013"]["sale_date"] is None and got["00013"]["total_price"] is None  # '31/12/2024', '$5'
    assert got["00014"]["quantity"] is None and got["00014"]["total_price"] is None  # '', '1,234.50'
    assert got["00015"]["sale_date"] is None and got["00015"]["seller_canon"] is None


def test_alias_priority(spark, scratch):
    df = _one_layout(spark, scratch, fx.F10)
    r = df.first()
    assert r["total_price"] == 9.0  # total_price before price
    assert r["product_id_canon"] == "prodA"  # product before product_title (batch list)


def test_stream_spec_has_no_order_quantity_or_derived_price(spark):
    df = spark.createDataFrame([("1", "2.5", "3")], "order_id string, unit_price string, order_quantity string")
    batch = canonicalise(df, BATCH_SPEC).first()
    stream = canonicalise(df, STREAM_SPEC).first()
    assert batch["quantity"] == 3 and batch["total_price"] == 7.5
    assert stream["quantity"] == 1 and stream["total_price"] == 0.0


def test_presence_per_row_decides_not_the_value(spark):
    df = spark.createDataFrame(
        [("1", "2024-01-01", "9", "5", True), ("2", None, "3", None, True), ("3", None, "3", None, False)],
        "order_id string, order_date string, price string, total_price string, has boolean",
    )
    first = ("order_date", "total_price")
    present = lambda n: F.col("has") if n in first else F.lit(True)
    got = canonicalise(df, present=present).orderBy("order_id").collect()
    assert [r["total_price"] for r in got] == [5.0, None, 3.0]  # NULL in a present alias stays NULL
    assert [str(r["sale_date"]) for r in got] == ["2024-01-01", "None", "None"]
    assert {r["quantity"] for r in got} == {1} and {r["category_canon"] for r in got} == {"unknown"}


def test_validate_required(spark):
    df = spark.createDataFrame([("c1",)], "customer_id string")
    with pytest.raises(ValueError, match="order_id"):
        validate_required(df, ("order_id",))
    validate_required(df, ("customer_id",))


def test_drop_internal(spark):
    df = spark.createDataFrame([("1", "x")], "order_id string, _rescued string")
    assert "_rescued" in canonicalise(df).columns
    assert "_rescued" not in canonicalise(df, drop_internal=True).columns


def test_single_projection(spark, scratch):
    fx.write(scratch, "f.csv", fx.F1)
    raw = read_csv_layout(spark, fx.F1.splitlines()[0].split(","), [scratch + "/f.csv"])
    plan = canonicalise(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1


def test_resolution_report():
    res = resolve(["Order_Date", "amount", "units"], BATCH_SPEC)
    assert res.date == "Order_Date" and res.price == "amount" and res.quantity == "units"
    assert res.product is None and res.unit_price is None
