"""H19: money sums are exact and independent of row order / partitioning."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.money import money_avg, money_sum

prices = st.lists(
    st.decimals(min_value=Decimal("-5000"), max_value=Decimal("100000"), places=4, allow_nan=False, allow_infinity=False),
    min_size=1,
    max_size=300,
)


@settings(max_examples=15, deadline=None)
@given(prices, st.integers(min_value=1, max_value=9))
def test_sum_is_exact_and_partition_independent(spark, values, parts):
    df = spark.createDataFrame([(float(v),) for v in values], "total_price double")
    exact = float(sum(values))
    one = df.coalesce(1).agg(money_sum("total_price").alias("s"), money_avg("total_price").alias("a")).first()
    many = df.repartition(parts).agg(money_sum("total_price").alias("s"), money_avg("total_price").alias("a")).first()
    assert one["s"] == many["s"] == exact
    assert one["a"] == many["a"] == exact / len(values)


def test_nulls_are_ignored_like_sum_and_avg(spark):
    df = spark.createDataFrame([(1.25,), (None,), (2.5,)], "total_price double")
    r = df.agg(money_sum("total_price").alias("s"), money_avg("total_price").alias("a")).first()
    assert r["s"] == 3.75 and r["a"] == 1.875
    empty = df.where(F.col("total_price").isNull()).agg(money_sum("total_price").alias("s")).first()
    assert empty["s"] is None


def test_fractions_of_a_cent_add_up_and_bad_prices_never_fail(spark):
    rows = [(0.004,)] * 1000 + [(float("nan"),), (float("inf"),), (-float("inf"),), (1e30,), (None,)]
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        r = spark.createDataFrame(rows, "total_price double").agg(money_sum("total_price").alias("s"), money_avg("total_price").alias("a")).first()
        assert r["s"] == 4.0 and r["a"] == 0.004
    spark.conf.set("spark.sql.ansi.enabled", "true")
