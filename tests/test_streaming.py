import os

import pytest
from pyspark.sql import types as T

from ledgerline.sources.files import read_sales_csv
from ledgerline.spec import STREAM_SPEC
from ledgerline.streaming.ingest import register_after_first_commit, run_available, start_ingest

from . import fixtures as fx

COLS = ["order_id", "sale_date", "total_price", "quantity"]


def _set(df):
    return sorted(tuple(str(r[c]) for c in COLS) for r in df.collect())


def test_stream_equals_batch_on_same_files(spark, scratch):
    land = os.path.join(scratch, "land")
    fx.write(land, "a.csv", fx.F1)
    fx.write(land, "b.csv", fx.F5)
    fx.write(land, "c.csv", fx.F6)
    out = run_available(spark, land, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), max_files_per_trigger=1)
    batch = read_sales_csv(spark, land, STREAM_SPEC)
    assert _set(out) == _set(batch)


def test_restart_adds_nothing_then_picks_up_new_files(spark, scratch):
    land, out, ckpt = (os.path.join(scratch, x) for x in ("land", "out", "ckpt"))
    fx.write(land, "a.csv", fx.F1)
    assert run_available(spark, land, out, ckpt).count() == 3
    assert run_available(spark, land, out, ckpt).count() == 3  # restart: nothing re-ingested
    # a new drop with a new column arrives; the restart adds the column
    fx.write(land, "b.csv", fx.F5)
    back = run_available(spark, land, out, ckpt)
    assert back.count() == 4
    assert "region" in back.columns
    assert [r["region"] for r in back.collect() if r["order_id"] == "9"] == ["EU"]


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_json_and_parquet_sources(spark, scratch, fmt):
    land = os.path.join(scratch, "land")
    raw = spark.createDataFrame(
        [("1", "2024-01-01", 5.0, 2), ("2", "2024-01-02", 1.5, 1)],
        "order_id string, date string, amount double, qty long",
    )
    raw.coalesce(1).write.format(fmt).save(os.path.join(land, "d1"))
    out = run_available(spark, os.path.join(land, "d1"), os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), fmt=fmt)
    got = sorted((r["order_id"], str(r["sale_date"]), r["total_price"], r["quantity"]) for r in out.collect())
    assert got == [("1", "2024-01-01", 5.0, 2), ("2", "2024-01-02", 1.5, 1)]


def test_explicit_schema_keeps_zero_padded_ids(spark, scratch):
    land = os.path.join(scratch, "land")
    fx.write(land, "a.csv", fx.F7)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fx.F7.splitlines()[0].split(",")])
    out = run_available(spark, land, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), schema=schema)
    assert sorted(r["order_id"] for r in out.collect()) == ["00012", "00013", "00014", "00015"]


def test_register_after_first_commit(spark, scratch):
    land, out, ckpt = (os.path.join(scratch, x) for x in ("land", "out", "ckpt"))
    fx.write(land, "a.csv", fx.F1)
    q = start_ingest(spark, land, out, ckpt, available_now=True)
    assert register_after_first_commit(spark, q, "stream_sales_test", out, timeout_s=120)
    q.awaitTermination()
    assert spark.table("stream_sales_test").count() == 3
    spark.sql("DROP TABLE stream_sales_test")


def test_parquet_stream_reads_every_file_by_its_own_columns(spark, scratch):
    land = os.path.join(scratch, "land")
    spark.createDataFrame([("1", "2024-01-01", 5.0)], "order_id string, date string, amount double") \
        .coalesce(1).write.parquet(os.path.join(land, "d1"))
    spark.createDataFrame([("2", "2024-01-02", 1.5, "s9")], "order_id string, date string, amount double, seller string") \
        .coalesce(1).write.mode("append").parquet(os.path.join(land, "d1"))
    out = run_available(spark, os.path.join(land, "d1"), os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), fmt="parquet")
    got = sorted((r["order_id"], r["seller_canon"]) for r in out.collect())
    assert got == [("1", None), ("2", "s9")]


def test_processing_time_trigger_picks_up_new_drops_until_stopped(spark, scratch):
    from ledgerline.streaming.ingest import read_sink

    land, out, ckpt = (os.path.join(scratch, x) for x in ("land", "out", "ckpt"))
    fx.write(land, "a.csv", fx.F1)
    q = start_ingest(spark, land, out, ckpt, processing_time="1 second", partition_by="sale_date")
    try:
        q.processAllAvailable()
        assert read_sink(spark, out).count() == 3
        fx.write(land, "b.csv", fx.F5)  # arrives while the query runs
        q.processAllAvailable()
        back = read_sink(spark, out)
        assert back.count() == 4 and "sale_date" in back.columns
        assert q.isActive and q.id is not None
    finally:
        q.stop()
    assert not q.isActive


def test_explicit_schema_rejects_a_mismatching_header(spark, scratch):
    land = os.path.join(scratch, "land")
    fx.write(land, "a.csv", fx.F7)
    fx.write(land, "b.csv", fx.F5)  # same kind of data, other column order
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fx.F7.splitlines()[0].split(",")])
    with pytest.raises(Exception):
        run_available(spark, land, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), schema=schema)


def test_compacting_the_stream_sink_keeps_every_row(spark, scratch):
    from ledgerline.sinks.tables import compact

    land, out, ckpt = (os.path.join(scratch, x) for x in ("land", "out", "ckpt"))
    for i, text in enumerate([fx.F1, fx.F5, fx.F6]):
        fx.write(land, f"f{i}.csv", text)
    sink = run_available(spark, land, out, ckpt, max_files_per_trigger=1)  # three micro-batches
    compacted = spark.read.parquet(compact(spark, out, os.path.join(scratch, "compacted")))
    assert _set(compacted) == _set(sink) and compacted.count() == 5


def _rows(df):
    cols = [c for c in ("order_id", "order_ts", "sale_date", "total_price", "quantity", "product_id_canon", "category_canon", "seller_canon")]
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


DROPS = {
    "a.csv": "order_id,total_price,price,buyer's note\n00012,oops,3,for Ann\n00013,,3,\n",
    "b.csv": "order_id,order_datetime,sale_amount,qty\n00014,2024-05-01,7.5,2\n",
    "c.csv": "order_id,order_date\n00015,2024-05-02\n",  # no price, quantity, category
    "d.csv": fx.F1,
    "e.csv": fx.F6,
}


def test_every_file_is_read_by_its_own_header(spark, scratch):
    land = os.path.join(scratch, "land")
    for name, text in DROPS.items():
        fx.write(land, name, text)
    out = run_available(spark, land, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), max_files_per_trigger=2)
    assert _rows(out) == _rows(read_sales_csv(spark, land, STREAM_SPEC))
    got = {r["order_id"]: r for r in out.collect()}
    assert got["00012"]["total_price"] is None and got["00013"]["total_price"] is None  # total_price is present
    assert got["00012"]["buyer's note"] == "for Ann"
    assert got["00014"]["total_price"] == 7.5 and got["00014"]["quantity"] == 2
    assert (got["00015"]["total_price"], got["00015"]["quantity"], got["00015"]["category_canon"]) == (0.0, 1, "unknown")


def test_a_new_header_while_the_stream_runs(spark, scratch):
    from ledgerline.streaming.ingest import read_sink

    land, out, ckpt = (os.path.join(scratch, x) for x in ("land", "out", "ckpt"))
    fx.write(land, "a.csv", DROPS["c.csv"])
    q = start_ingest(spark, land, out, ckpt, processing_time="1 second")
    try:
        q.processAllAvailable()
        fx.write(land, "b.csv", "order_id,order_datetime,sale_amount,qty,promo\n2,2024-05-03,4.5,6,P9\n")
        q.processAllAvailable()
    finally:
        q.stop()
    got = {r["order_id"]: r for r in read_sink(spark, out).collect()}
    assert str(got["2"]["sale_date"]) == "2024-05-03" and got["2"]["total_price"] == 4.5
    assert got["2"]["quantity"] == 6 and got["2"]["promo"] == "P9" and got["00015"]["promo"] is None


def test_a_batch_that_runs_again_replaces_its_rows(spark, scratch):
    from ledgerline.streaming.ingest import _write_batch, read_sink

    land, out = os.path.join(scratch, "land"), os.path.join(scratch, "out")
    fx.write(land, "a.csv", fx.F1)
    write = _write_batch(out, "csv", STREAM_SPEC, None, None, {})
    paths = spark.createDataFrame([(os.path.join(land, "a.csv"),)], "path string")
    write(paths, 0)
    write(paths, 0)
    assert read_sink(spark, out).count() == 3


def test_json_stream_tells_null_from_absent(spark, scratch):
    land = os.path.join(scratch, "land")
    fx.write(land, "a.json", '{"order_id": "00012", "total_price": null, "price": 3, "qty": 2}\n{"order_id": "2", "price": 3}\n')
    out = run_available(spark, land, os.path.join(scratch, "out"), os.path.join(scratch, "ckpt"), fmt="json")
    got = {r["order_id"]: r for r in out.collect()}
    assert got["00012"]["total_price"] is None and got["00012"]["quantity"] == 2
    assert got["2"]["total_price"] == 3.0 and got["2"]["quantity"] == 1 and got["2"]["category_canon"] == "unknown"
