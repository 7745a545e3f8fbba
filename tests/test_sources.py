import gzip
import os

import pytest

from ledgerline.sources.files import csv_layouts, read_first_line, read_raw, read_raw_by_header, read_sales_csv
from ledgerline.sources.raw import detected_columns, schema_preview, source_manifest

from . import fixtures as fx


def test_header_drift_in_one_folder(spark, scratch):
    fx.write(scratch, "a.csv", fx.F1)
    fx.write(scratch, "b.csv", fx.F5)
    layouts = csv_layouts(spark, scratch)
    assert len(layouts) == 2
    df = read_sales_csv(spark, scratch)
    got = {r["order_id"]: r for r in df.collect()}
    assert len(got) == 4
    assert got["9"]["total_price"] == 9.99 and got["9"]["quantity"] == 1 and got["9"]["region"] == "EU"
    assert got["1"]["region"] is None


def test_positional_read_misplaces_values(spark, scratch):
    """The single inferred read maps the second file by position (the hazard)."""
    fx.write(scratch, "a.csv", fx.F1)
    fx.write(scratch, "b.csv", fx.F5.replace(",region", "").replace(",EU", ""))
    df = read_raw(spark, scratch, how="inferred")
    row9 = [r for r in df.collect() if str(r["order_id"]) not in ("1", "2", "3")]
    assert row9 and str(row9[0]["order_id"]) != "9"  # shifted: not what the file says


def test_curated_mode_rejects_mismatched_header(spark, scratch):
    fx.write(scratch, "b.csv", fx.F5)
    with pytest.raises(Exception):
        read_raw(spark, scratch, how="curated").collect()


def test_many_layouts_same_totals(spark, scratch):
    for i, text in enumerate([fx.F1, fx.F2, fx.F3, fx.F5, fx.F6]):
        fx.write(scratch, f"f{i}.csv", text)
    df = read_sales_csv(spark, scratch)
    total = df.agg({"total_price": "sum"}).first()[0]
    assert abs(total - (10.5 + 5.25 + 15.75 + 7 + 3 + 10 + 9.99 + 12)) < 1e-9
    assert df.count() == 8


def test_by_name_raw_union(spark, scratch):
    fx.write(scratch, "a.csv", fx.F1)
    fx.write(scratch, "b.csv", fx.F5)
    df = read_raw_by_header(spark, scratch)
    r = [x for x in df.collect() if x["order_id"] == "9"][0]
    assert r["total_price"] == "9.99" and r["quantity"] == "1"


def test_first_line_plain_and_gzip(scratch):
    p = fx.write(scratch, "a.csv", fx.F1)
    assert read_first_line("file:" + p).startswith("order_id,order_date")
    gz = os.path.join(scratch, "b.csv.gz")
    with gzip.open(gz, "wt") as fh:
        fh.write(fx.F2)
    assert read_first_line("file://" + gz).startswith("order_id,customer_id")


def test_gzip_layout_read(spark, scratch):
    with gzip.open(os.path.join(scratch, "b.csv.gz"), "wt") as fh:
        fh.write(fx.F2)
    fx.write(scratch, "a.csv", fx.F1)
    assert read_sales_csv(spark, scratch).count() == 5


def test_schema_preview_and_detected(spark, scratch):
    fx.write(scratch, "a.csv", fx.F7)
    raw = read_raw_by_header(spark, scratch)
    prev = {r["column"]: r for r in schema_preview(raw).collect()}
    assert prev["order_id"]["data_type"] == "string" and prev["order_id"]["smallest"] == "00012"
    assert prev["quantity"]["nulls"] == 1
    det = {r["canonical"]: r for r in detected_columns(raw).collect()}
    assert det["order_ts"]["matched_column"] == "order_date" and det["order_ts"]["non_null_rows"] == 3
    assert det["unit_price"]["matched_column"] is None and det["unit_price"]["non_null_rows"] is None


def test_source_manifest(spark, scratch):
    fx.write(scratch, "a.csv", fx.F1)
    fx.write(scratch, "b.csv", fx.F2)
    df = spark.read.option("header", True).csv(scratch)
    m = {r["file_name"]: r for r in source_manifest(df).collect()}
    assert m["a.csv"]["rows"] == 3 and m["b.csv"]["rows"] == 2
    assert m["a.csv"]["bytes"] == len(fx.F1)


def test_parquet_drops_with_drift_and_int_bigint(spark, scratch):
    from ledgerline.sources.files import read_sales

    a, b = os.path.join(scratch, "a"), os.path.join(scratch, "b")
    spark.createDataFrame([("1", "2024-01-01", 2, 5.0)],
                          "order_id string, order_date string, quantity int, total_price double").write.parquet(a)
    spark.createDataFrame([("2", "2024-01-02", 3, "7.5")],
                          "order_id string, date string, quantity long, revenue string").write.parquet(b)
    df = read_sales(spark, [a, b], fmt="parquet")
    got = sorted((r["order_id"], str(r["sale_date"]), r["quantity"], r["total_price"]) for r in df.collect())
    assert got == [("1", "2024-01-01", 2, 5.0), ("2", "2024-01-02", 3, 7.5)]
    assert dict(df.dtypes)["quantity"] == "bigint"


def test_json_records_with_different_names(spark, scratch):
    from ledgerline.sources.files import read_sales

    fx.write(scratch, "a.json", '{"order_id": "3", "Date": "2024-01-03", "amount": 1.5}\n')
    fx.write(scratch, "b.json", '{"order_id": "4", "order_date": "2024-01-04", "total_price": 2.5, "qty": 2}\n')
    df = read_sales(spark, scratch, fmt="json")
    got = sorted((r["order_id"], str(r["sale_date"]), r["quantity"], r["total_price"]) for r in df.collect())
    # presence is told per record: a record without a quantity takes the default
    assert got == [("3", "2024-01-03", 1, 1.5), ("4", "2024-01-04", 2, 2.5)]


def test_curated_mode_keeps_malformed_lines(spark, scratch):
    header = "order_id,order_date,customer_id,product_id,asin,quantity,total_price,category\n"
    fx.write(scratch, "a.csv", header + "1,2024-01-01,c1,p1,A1,2,10.5,toys\n2,2024-01-02,c2,p2,A2,12.5,oops,books\n")
    df = read_raw(spark, scratch, how="curated")
    rows = {r["order_id"]: r for r in df.collect()}
    assert rows["1"]["_corrupt_record"] is None and rows["1"]["quantity"] == 2
    assert rows["2"]["_corrupt_record"].startswith("2,2024-01-02") and rows["2"]["total_price"] is None
    assert len(read_raw(spark, scratch, how="curated").columns) == 9  # schema constant not mutated


def test_connector_schemes_map_to_arrow():
    from ledgerline.sources.header_probe import arrow_uri

    assert arrow_uri("s3a://bucket/raw/a.csv") == "s3://bucket/raw/a.csv"
    assert arrow_uri("s3n://bucket/a.csv") == "s3://bucket/a.csv"
    assert arrow_uri("hdfs://nn:8020/raw/a.csv") == "hdfs://nn:8020/raw/a.csv"
    assert arrow_uri("/local/a.csv") == "/local/a.csv"


def _orders(df):
    return sorted((r["order_id"], str(r["sale_date"]), r["total_price"]) for r in df.collect())


def test_partition_folder_columns_are_kept(spark, scratch):
    from ledgerline.sources.files import read_sales_csv

    import os

    for day in ("2024-03-01", "2024-03-02"):
        fx.write(os.path.join(scratch, "land", f"sale_date={day}"), "a.csv", f"order_id,total_price\n{day[-1]},2.5\n")
    df = read_sales_csv(spark, os.path.join(scratch, "land"))
    assert _orders(df) == [("1", "2024-03-01", 2.5), ("2", "2024-03-02", 2.5)]


def test_codecs_blank_lines_quotes_and_long_headers(spark, scratch):
    import bz2
    import gzip
    import os

    from ledgerline.sources.files import read_sales_csv

    text = "order_id,order_date,total_price\n1,2024-01-01,2.5\n"
    for i, (name, pack) in enumerate([("a.csv.bz2", bz2.compress), ("b.csv.gz", gzip.compress), ("c.csv", bytes)]):
        with open(os.path.join(scratch, name), "wb") as fh:
            fh.write(pack(text.replace("\n1,", f"\n{i},").encode()))
    fx.write(scratch, "d.csv", "\n\norder_date,order_id,total_price\n2024-01-01,3,2.5\n")
    assert _orders(read_sales_csv(spark, scratch)) == [(str(i), "2024-01-01", 2.5) for i in range(4)]

    other = os.path.join(scratch, "other")
    fx.write(other, "e.csv", "# made by hand\n'order_id';'order;date';'total_price'\n'1';'x';'2.5'\n")
    df = read_sales_csv(spark, other, sep=";", quote="'", comment="#")
    assert df.first()["order;date"] == "x" and df.first()["total_price"] == 2.5

    wide = os.path.join(scratch, "wide")
    names = [f"c{i:06d}{'x' * 600}" for i in range(2000)]  # a header of more than a megabyte
    fx.write(wide, "f.csv", ",".join([*names, "order_id"]) + "\n" + "v," * 2000 + "9\n")
    from ledgerline.sources.files import csv_layouts

    assert csv_layouts(spark, wide)[0][0][-1] == "order_id"


def test_parquet_files_are_read_by_their_own_columns(spark, scratch):
    import os

    from ledgerline.sources.files import read_sales

    land = os.path.join(scratch, "p")
    spark.createDataFrame([("1", None, 3.0)], "order_id string, total_price double, price double").coalesce(1).write.parquet(land)
    spark.createDataFrame([("2", 3.0, 4)], "order_id string, price double, qty int").coalesce(1).write.mode("append").parquet(land)
    got = {r["order_id"]: r for r in read_sales(spark, land, fmt="parquet").collect()}
    assert got["1"]["total_price"] is None and got["1"]["quantity"] == 1
    assert got["2"]["total_price"] == 3.0 and got["2"]["quantity"] == 4
