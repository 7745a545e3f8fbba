import os

from pyspark.sql import functions as F

from ledgerline.plans import registry
from ledgerline.sinks.tables import cluster, compact, publish, register_table, write_mart
from ledgerline.sources.files import read_sales_csv

from . import fixtures as fx


def _sales(spark, scratch):
    src = os.path.join(scratch, "raw")
    fx.write(src, "a.csv", fx.F1)
    fx.write(src, "b.csv", fx.F2)
    fx.write(src, "c.csv", fx.F4)  # NULL sale dates
    return read_sales_csv(spark, src)


def _multiset(df, cols):
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


def test_append_twice_doubles_overwrite_does_not(spark, scratch):
    s = _sales(spark, scratch)
    out = os.path.join(scratch, "table")
    assert publish(s, out) == ["sale_date"]
    publish(s, out)
    assert spark.read.parquet(out).count() == 2 * s.count()
    publish(s, out, overwrite=True)
    assert spark.read.parquet(out).count() == s.count()
    assert any(d.startswith("sale_date=") for d in os.listdir(out))


def test_partition_guard(spark, scratch):
    s = _sales(spark, scratch)
    assert publish(s, os.path.join(scratch, "t1"), partition_by="") == []
    assert publish(s, os.path.join(scratch, "t2"), partition_by="no_such_column") == []
    assert publish(s, os.path.join(scratch, "t3"), partition_by=None, layout="as_is") == []


def test_quantity_type_is_stable_across_appends(spark, scratch):
    out = os.path.join(scratch, "table")
    a = spark.createDataFrame([("1", 2)], "order_id string, quantity int")
    b = spark.createDataFrame([("2", 3)], "order_id string, quantity long")
    publish(a, out, partition_by=None)
    publish(b, out, partition_by=None)
    t = spark.read.parquet(out)
    assert dict(t.dtypes)["quantity"] == "bigint" and t.count() == 2


def test_registration_sees_appended_partitions(spark, scratch):
    s = _sales(spark, scratch)
    out = os.path.join(scratch, "table")
    publish(s, out)
    register_table(spark, "sink_test_table", out)
    n = spark.table("sink_test_table").count()
    assert n == s.count()
    publish(s.withColumn("sale_date", F.date_add("sale_date", 100)), out)
    register_table(spark, "sink_test_table", out)  # idempotent; recovers new partitions
    assert spark.table("sink_test_table").count() == 2 * n
    spark.sql("DROP TABLE sink_test_table")


def test_cluster_and_compact_keep_the_multiset(spark, scratch):
    s = _sales(spark, scratch)
    cols = ["order_id", "sale_date", "total_price", "quantity", "seller_canon", "product_id_canon"]
    c = cluster(s, os.path.join(scratch, "clustered"), num_partitions=3)
    assert _multiset(spark.read.parquet(c), cols) == _multiset(s, cols)
    k = compact(spark, c, os.path.join(scratch, "compacted"))
    assert _multiset(spark.read.parquet(k), cols) == _multiset(s, cols)
    files = [f for _, _, fs in os.walk(k) for f in fs if f.endswith(".parquet")]
    dates = [d for d in os.listdir(k) if d.startswith("sale_date=")]
    assert len(files) <= len(dates) + 1  # one output partition -> one file per date


def test_compaction_query_covers_every_date(spark, monkeypatch):
    """No date and no NULL date is left out: three years, one date missing."""
    days = ["1994-12-31", "1995-06-01", "1995-06-01", "2001-08-01", None, None, None]
    rows = [(str(10 ** (i % 2) + i), d, 1.0, 1, f"p{i}", "s") for i, d in enumerate(days)]
    schema = "order_id string, sale_date string, total_price double, quantity long, product_id_canon string, seller_canon string"
    sales = spark.createDataFrame(rows, schema).withColumn("sale_date", F.col("sale_date").cast("date"))
    monkeypatch.setattr(registry, "q_canonical_sales", lambda spark, sf_dir: sales)
    got = {str(r.sale_date): (r["rows"], r.files) for r in registry.QUERIES["compacted_table"](spark, "").collect()}
    assert got == {"1994-12-31": (1, 1), "1995-06-01": (2, 1), "2001-08-01": (1, 1), "None": (3, 1)}


def test_write_mart_csv_has_header(spark, scratch):
    df = spark.createDataFrame([("toys", 1.5)], "category_canon string, revenue double")
    p = write_mart(df, os.path.join(scratch, "marts"), "top_categories", fmt="csv")
    back = spark.read.option("header", True).csv(p)
    assert back.columns == ["category_canon", "revenue"] and back.count() == 1
