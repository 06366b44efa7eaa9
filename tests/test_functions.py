"""The distributed building blocks equal their single-window / textbook forms."""

import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.functions.percentile import exact_percentiles, rank_candidates
from tidewater.functions.windows import previous_value, running_total


def _orders(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # customer 0 holds a third of all rows (hot key), several orders per day
        cust = 0 if i % 3 == 0 else rnd.randint(1, 40)
        data.append((i, cust, rnd.randint(0, 60), rnd.randint(1, 10_000) / 100))
    return (spark.createDataFrame(data, "order_id long, customer_id long, day int, amount double")
            .withColumn("order_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")))
            .withColumn("amount", F.col("amount").cast("decimal(18,2)")).drop("day"))


def test_running_total_equals_single_window(spark):
    df = _orders(spark)
    got = running_total(df, "customer_id", "order_date", "order_id", "amount")
    w = (Window.partitionBy("customer_id").orderBy("order_date", "order_id")
         .rowsBetween(Window.unboundedPreceding, 0))
    want = df.withColumn("running_total", F.sum("amount").over(w))
    assert sorted(got.select("order_id", "running_total").collect()) == \
        sorted(want.select("order_id", "running_total").collect())


def test_windows_keep_null_keys_days_and_values(spark):
    rows = [(1, "2024-01-01", 5, 10), (1, None, 7, 20), (1, "2024-01-02", None, 30), (None, "2024-01-01", 1, 40),
            (None, None, 2, 50), (None, None, None, 60), (2, "2024-01-01", 3, None), (2, "2024-01-01", 4, 5)]
    df = spark.createDataFrame(rows, "customer_id int, order_date string, order_id int, amount int")
    order = [F.col(c).asc_nulls_last() for c in ("order_date", "order_id")]
    w = Window.partitionBy("customer_id").orderBy(*order)
    key = lambda r: tuple((x is None, x) for x in r)
    for got, want in ((running_total(df, "customer_id", "order_date", "order_id", "amount", out="x", bucket_bits=1),
                       df.withColumn("x", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)))),
                      (previous_value(df, "customer_id", "order_date", "order_id", "amount", out="x", bucket_bits=1),
                       df.withColumn("x", F.lag("amount").over(w)))):
        got = sorted((tuple(r) for r in got.select(want.columns).collect()), key=key)
        assert got == sorted((tuple(r) for r in want.collect()), key=key) and len(got) == len(rows)


def test_balances_survive_a_null_date(spark):
    from tidewater.operators import accounts
    rows = [(1, "2020-01-05", "deposit", 100), (1, None, "deposit", 7), (2, "2020-02-01", "purchase", 30), (3, None, "deposit", 1)]
    df = spark.createDataFrame(rows, "customer_id int, txn_date string, txn_type string, txn_amount int")
    out = accounts.monthly_balances(df.withColumn("txn_date", F.to_date("txn_date"))).collect()
    assert {(r.customer_id, str(r.ending_month), float(r.ending_balance)) for r in out} == {
        (1, "2020-01-31", 100.0), (1, "2020-02-29", 100.0), (2, "2020-02-29", -30.0)}


def test_previous_value_equals_lag(spark):
    df = _orders(spark)
    got = previous_value(df, "customer_id", "order_date", "order_id", "amount")
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    want = df.withColumn("previous_value", F.lag("amount").over(w))
    assert sorted(got.select("order_id", "previous_value").collect()) == \
        sorted(want.select("order_id", "previous_value").collect())


@pytest.mark.parametrize("bits", [0, 3])
def test_bucketed_windows_equal_single_window(spark, bits):
    # tiny buckets: the hot customer's days split into many units
    df = _orders(spark)
    w = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    got = running_total(df, "customer_id", "order_date", "order_id", "amount", bucket_bits=bits)
    want = df.withColumn("running_total", F.sum("amount").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(got.select("order_id", "running_total").collect()) == \
        sorted(want.select("order_id", "running_total").collect())
    got = previous_value(df, "customer_id", "order_date", "order_id", "amount", bucket_bits=bits)
    want = df.withColumn("previous_value", F.lag("amount").over(w))
    assert sorted(got.select("order_id", "previous_value").collect()) == \
        sorted(want.select("order_id", "previous_value").collect())


def _check_percentiles(spark, values, accuracy=10_000):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    ps = [0.25, 0.5, 0.75, 0.95]
    got = exact_percentiles(df, "v", ps, ["a", "b", "c", "d"], scale=6, accuracy=accuracy).first()
    want = np.quantile(np.array(values, dtype=float), ps, method="linear")
    assert [round(x, 6) for x in got] == [round(float(x), 6) for x in want]


@pytest.mark.parametrize("accuracy", [2, 10, 10_000])
def test_exact_percentiles_match_linear_interpolation(spark, accuracy):
    rnd = random.Random(3)
    _check_percentiles(spark, [rnd.randint(0, 500) / 4 for _ in range(2001)], accuracy)


def test_exact_percentiles_with_an_outlier(spark):
    rnd = random.Random(5)
    _check_percentiles(spark, [rnd.random() * 1000 - 500 for _ in range(997)] + [1e13], accuracy=20)


def _largest_window(df, col, ps, by=(), accuracy=10_000):
    rows = rank_candidates(df, col, ps, by, accuracy).groupBy(*by, "i").count()
    return rows.agg(F.max("count")).first()[0]


def test_an_outlier_leaves_the_last_window_small(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).cast("double").alias("v")) \
        .unionByName(spark.createDataFrame([(1e7 * 200_003,)], "v double"))
    assert _largest_window(df, "v", [0.25, 0.5, 0.95], accuracy=1000) <= 200_000 * 6 // 1000
    assert exact_percentiles(df, "v", [0.5], ["m"]).first().m == np.quantile(
        np.r_[np.arange(200_000, dtype=np.int64) * 7919 % 200_003, 1e7 * 200_003], 0.5)


def test_percentiles_of_a_group_of_millions_of_distinct_values(spark):
    n = 2_000_000
    big = spark.range(n).select(F.lit("big").alias("g"), (F.col("id") * 7919 % 2_000_003).alias("v"))
    df = big.unionByName(spark.createDataFrame([("few", 1), ("few", 2), ("few", 4), (None, 5), (None, 7), ("none", None)], "g string, v bigint"))
    ps, names = [0.5, 0.8, 0.95], ["a", "b", "c"]
    got = {r.g: tuple(r)[1:] for r in exact_percentiles(df, "v", ps, names, by=["g"]).collect()}
    want = np.quantile(np.arange(n, dtype=np.int64) * 7919 % 2_000_003, ps)
    assert got.pop("big") == tuple(round(float(x), 4) for x in want)
    assert got == {"few": (2.0, 3.2, 3.8), None: (6.0, 6.6, 6.9)}
    assert _largest_window(df, "v", ps, ["g"]) <= n * 6 // 10_000


def test_exact_percentiles_with_most_rows_tied(spark):
    rnd = random.Random(6)
    _check_percentiles(spark, [100.0] * 1200 + [rnd.random() * 200 for _ in range(800)])


def test_exact_percentiles_single_value_and_none(spark):
    _check_percentiles(spark, [42.0])
    none = spark.createDataFrame([(None,)], "v double")
    assert tuple(exact_percentiles(none, "v", [0.5], ["a"]).first()) == (None,)


def test_building_percentiles_starts_no_job(spark):
    from tidewater.plans import registry
    spark.sparkContext.setJobGroup("percentiles", "build only")
    registry.queries()["revenue_percentiles"](spark, "/root/testdata/sf0.001")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("percentiles")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []
