"""Sketches keep their error bounds and roll up from days."""

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import sketches
from tidewater.operators import approximate


def _orders(spark, n=60_000):
    i = F.col("id")
    return spark.range(n).select(
        i.alias("order_id"), (i * 7919 % 9973).alias("customer_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 120).cast("int")).alias("order_date"),
        (F.pow(F.lit(1.1), (i * 31 % 100)) + (i % 97) / 7).cast("decimal(18,2)").alias("total_amount"))


def test_distinct_counts_of_months_from_days(spark):
    orders = _orders(spark)
    daily = approximate.daily_customers(orders)
    assert daily.count() == 120
    exact = dict(orders.groupBy(F.trunc("order_date", "month")).agg(F.count_distinct("customer_id")).collect())
    got = dict(approximate.customers_by_month(daily).collect())
    assert got.keys() == exact.keys()
    assert all(abs(got[m] - exact[m]) <= 4 * sketches.relative_error() * exact[m] for m in exact)
    whole = sketches.distinct_by_period(daily, F.trunc("day", "year")).first().estimate
    assert abs(whole - 9973) <= 4 * sketches.relative_error() * 9973


def test_checked_reports(spark):
    orders = _orders(spark).unionByName(spark.createDataFrame([(-1, 5, None, None), (-2, None, dt.date(2024, 1, 3), None)],
                                                              "order_id bigint, customer_id bigint, order_date date, total_amount decimal(18,2)"))
    for rows in (approximate.customers_by_month_checked(orders, approximate.daily_customers(orders)),
                 approximate.returning_customers_checked(orders),
                 approximate.amounts_by_month_checked(orders, approximate.daily_amounts(orders))):
        found = rows.collect()
        assert len(found) == 4 and all(r.within_bound for r in found)


def test_rank_error_of_percentiles_per_group(spark):
    df = spark.range(100_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 3).alias("g"), F.pow(F.col("id") * 7919 % 100_003, F.lit(3.0)).alias("v"))
    daily = sketches.daily_quantiles(df, F.col("day"), "v", ["g"])
    got = sketches.quantiles_by_period(daily, F.lit("all"), [0.1, 0.5, 0.99], ["a", "b", "c"], ["g"]).collect()
    assert len(got) == 3
    for r in got:
        values = [x.v for x in df.filter(F.col("g") == r.g).select("v").collect()]
        for p, q in zip([0.1, 0.5, 0.99], [r.a, r.b, r.c]):
            assert abs(sum(v <= q for v in values) / len(values) - p) <= sketches.rank_error() + 1 / len(values)
