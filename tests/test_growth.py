"""Steps whose cost must not grow faster than the rows."""

import datetime
import glob

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import coerce
from ledgerline.operators import mart_states
from ledgerline.plans import batch_ingest, registry
from ledgerline.sinks import tables
from ledgerline.sinks.tables import publish
from ledgerline.sources import files
from ledgerline.spec import CANONICAL_COLUMNS

from . import fixtures as fx
from .conftest import SF_SMALL

TEXTS = ["12", " 12 ", "+7", "-7", "\t8\n", "\x7f9", "12.0", "12.5", "12.", ".5", "1e3", "-1.9", "", " ", "+", "1,234", "oops", "NaN", "Infinity",
         "9223372036854775807", "9223372036854775808", "00012", "1 2", "12L", "12d", " 12", "１２", "+-3", None]


def test_quantity_texts_are_cast_to_bigint_only_where_they_can_be(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "q string")
    c = F.col("q")
    plain = F.coalesce(c.try_cast("long"), c.try_cast("double").try_cast("long"))
    out = rows.select("q", coerce.to_long(c, T.StringType()).alias("now"), plain.alias("plain"))
    assert [r.q for r in out.collect() if r.now != r.plain] == []
    assert "RLIKE" in out.select("now")._jdf.queryExecution().optimizedPlan().toString()  # a failed cast costs an exception


def test_files_of_a_date_do_not_follow_the_splits_of_its_share(spark, scratch):
    dates = 60
    rows = spark.range(dates * 300).select(
        F.col("id").cast("string").alias("order_id"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % dates).cast("int")).alias("sale_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("seller_canon"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "64k")
    try:
        publish(rows, f"{scratch}/t")
    finally:
        spark.conf.unset(key)
    assert len(glob.glob(f"{scratch}/t/*/part-*")) <= 1.2 * dates


def test_states_keep_no_rows_in_memory(spark, scratch, monkeypatch):
    day = datetime.date(2020, 1, 1)
    data = [("a", 1.5, 2, "p", "c", day), ("b", 2.5, 1, "p", "d", None), ("b", None, 1, None, None, day)]
    sales = spark.createDataFrame(data, "order_id string, total_price double, quantity long, product_id_canon string, category_canon string, sale_date date")
    for name in ("persist", "cache"):
        monkeypatch.setattr(type(sales), name, lambda *a, **k: pytest.fail("rows kept"))
    mart_states.refresh(sales, scratch)
    got = {r.sale_date: (r.revenue, r.units_sold, r.orders) for r in mart_states.daily(spark, scratch).collect()}
    assert got == {day: (1.5, 3, 2), None: (2.5, 1, 1)}


def test_replaced_table_joins_the_raw_rows_once(spark, monkeypatch):
    written, plain = [], registry.versions.replace_table

    def replace(spark, name, root, df: DataFrame, **how):
        written.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(spark, name, root, df, **how, partition_by=None)  # one folder: the plan is what counts here

    monkeypatch.setattr(registry.versions, "replace_table", replace)
    monkeypatch.setattr(registry.versions, "append_to", lambda spark, name, df: written.append(df._jdf.queryExecution().optimizedPlan().toString()))
    registry.QUERIES["replaced_table"](spark, SF_SMALL)
    assert len(written) == 3 and not any("Join" in p for p in written)


# ------------------------------------------------- disk of the batch job (F1) ---


def _drops(scratch):
    """Three layouts that share a date; one row has none."""
    fx.write(f"{scratch}/raw", "a.csv", "order_id,order_date,total_price,quantity,product_id\n1,2024-01-01,1.5,2,p\n2,2024-01-02,2.5,1,q\n")
    fx.write(f"{scratch}/raw", "b.csv", "sku,units,amount,order_datetime,Order_ID\np,3,4.0,2024-01-01,3\nr,1,,2024-02-03,4\n")
    fx.write(f"{scratch}/raw", "c.csv", "order_id,date,price,asin,note\n5,,7.0,p,n\n6,2024-03-01,1.0,,\n")
    return f"{scratch}/raw"


def _ingest(spark, scratch, to, **how):
    res = batch_ingest.run(spark, _drops(scratch), f"{scratch}/{to}", f"{scratch}/{to}-marts", table_name=None, overwrite=True, **how)
    marts = {m: sorted(map(repr, spark.read.parquet(p).collect())) for m, p in res.marts.items()}
    return res.table.schema, sorted(map(repr, res.table.collect())), marts, res.partition_columns


def test_layouts_published_in_turn_give_the_table_of_one_write(spark, scratch, monkeypatch):
    want = _ingest(spark, scratch, "one")
    assert len(want[1]) == 6
    writes = []
    monkeypatch.setattr(files, "PASS_BYTES", 1)
    monkeypatch.setattr(batch_ingest, "STATE_ROWS", 1)
    monkeypatch.setattr(tables, "clustered", lambda df, *a, f=tables.clustered: writes.append(df) or f(df, *a))
    for mode, n in (("static", 3), ("dynamic", 1)):  # a dynamic overwrite replaces the dates of one write
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        try:
            writes.clear()
            _ingest(spark, scratch, mode)
            assert _ingest(spark, scratch, mode) == want  # again: what was there is replaced
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
        assert len(writes) == 2 * n


def test_shuffle_files_go_with_their_query(spark, scratch, monkeypatch):
    key, seen = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before = spark.conf.get(key)
    monkeypatch.setattr(batch_ingest, "publish", lambda *a, **k: seen.append(spark.conf.get(key)) or tables.publish(*a, **k))
    _ingest(spark, scratch, "t")
    assert seen == ["true"] and spark.conf.get(key) == before


def test_only_raw_columns_of_a_layout_pass_the_shuffle(spark, scratch, monkeypatch):
    shuffled = []
    monkeypatch.setattr(tables, "clustered", lambda df, *a, f=tables.clustered: shuffled.append(df.columns) or f(df, *a))
    raw = f"{scratch}/one"
    fx.write(raw, "a.csv", "sku,units,amount,order_datetime,Order_ID,sale_date\np,3,4.0,2024-01-01 05:00:00,3,x\n")
    res = batch_ingest.run(spark, raw, f"{scratch}/t", f"{scratch}/m", table_name=None, overwrite=True)
    assert shuffled == [["sku", "units", "amount", "order_datetime", "Order_ID", "sale_date", "_key_sale_date"]]
    row = res.table.first()
    assert (row.order_id, row.sale_date, row.product_id_canon, row.quantity, row.total_price, row.sku) == ("3", datetime.date(2024, 1, 1), "p", 3, 4.0, "p")
    assert res.table.columns == ["sku", "units", "amount", "order_datetime", *CANONICAL_COLUMNS[:3], *CANONICAL_COLUMNS[4:], "sale_date"]


def test_an_overwrite_in_turn_that_fails_leaves_no_rows(spark, scratch):
    good = spark.createDataFrame([("1", datetime.date(2024, 1, 1))], "order_id string, sale_date date")
    bad = good.select(F.raise_error(F.lit("stop")).cast("string").alias("order_id"), "sale_date")
    with pytest.raises(Exception, match="stop"):
        publish([good, bad], f"{scratch}/t", overwrite=True)
    assert glob.glob(f"{scratch}/t/*") == []
    written = publish([good, good], f"{scratch}/t", overwrite=True)
    assert (written, written.partitions, written.rows) == (["sale_date"], [(datetime.date(2024, 1, 1),)], 2)
    assert spark.read.parquet(f"{scratch}/t").count() == 2


def test_runs_of_months_hold_every_date_once(spark, scratch):
    days = [datetime.date(2024, m, d) for m in (1, 2, 5) for d in (1, 31 if m != 2 else 29)]
    cuts = mart_states.month_cuts([None, *days], 3)
    assert cuts == [datetime.date(2024, 2, 1), datetime.date(2024, 5, 1)]
    assert mart_states.month_cuts([None], 3) == mart_states.month_cuts(days[:2], 3) == []
    older = [datetime.date(1999, 1, 1), datetime.date(2030, 1, 1), None]  # dates the cuts were not made from
    rows = [(str(i), 1.5, 2, "p", "c", d) for i, d in enumerate([*days, *older])]
    sales = spark.createDataFrame(rows, "order_id string, total_price double, quantity long, product_id_canon string, category_canon string, sale_date date")
    publish(sales, f"{scratch}/t")
    sales = spark.read.parquet(f"{scratch}/t")
    mart_states.refresh(sales, f"{scratch}/s", cuts=cuts)
    state = mart_states.read_state(spark, f"{scratch}/s", "products").collect()
    assert sorted(str(r.sale_date) for r in state) == sorted(map(str, [*days, *older]))
    plan = mart_states.partial_states(sales)["products"].where(mart_states._between(cuts)[1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_date" in plan  # a run reads its own dates


def test_batch_ingest_keeps_no_joined_view_and_gzips_its_drops(spark, monkeypatch):
    at = []
    monkeypatch.setattr(registry, "scratch_path", lambda spark, name, f=registry.scratch_path: at.append(f(spark, name)) or at[-1])
    registry.QUERIES["batch_ingest"](spark, SF_SMALL)
    base = at[0].removeprefix("file:")
    assert {p.rsplit("/", 1)[1] for p in glob.glob(f"{base}/*")} == {"raw", "table", "marts"}
    drops = glob.glob(f"{base}/raw/*.csv*")
    assert drops and all(p.endswith(".csv.gz") for p in drops)
