"""Opt-in approximate reports over store orders(order_id, customer_id, order_date, total_amount).

The daily sketches are small result tables of their own; months and years derive from them without
rereading orders.  The ``*_checked`` forms set an estimate against the exact value and say whether it
lies within the error bound of its sketch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import sketches

#: Standard errors that an estimate may be off.
DEVIATIONS = 4


def month_of(day: str) -> Column:
    return F.trunc(day, "month")


def daily_customers(orders: DataFrame) -> DataFrame:
    """(day, sketch): the customers of each day."""
    return sketches.daily_distinct(orders.filter(F.col("order_date").isNotNull()), F.col("order_date"), "customer_id")


def customers_by_month(daily: DataFrame) -> DataFrame:
    """Approximate customers per month from daily sketches -> month, customers."""
    return sketches.distinct_by_period(daily, month_of("day")).select(F.col("period").alias("month"), F.col("estimate").alias("customers"))


def customers_by_month_checked(orders: DataFrame, daily: DataFrame) -> DataFrame:
    """-> month, customers (exact), within_bound"""
    exact = orders.filter(F.col("order_date").isNotNull()).groupBy(month_of("order_date").alias("month")) \
        .agg(F.count_distinct("customer_id").alias("customers"))
    about = customers_by_month(daily).withColumnRenamed("customers", "estimate")
    off = F.greatest(F.lit(1.0), F.col("customers") * (DEVIATIONS * sketches.relative_error()))
    return exact.join(about, "month").select("month", "customers", (F.abs(F.col("estimate") - F.col("customers")) <= off).alias("within_bound"))


def returning_customers(orders: DataFrame) -> DataFrame:
    """Approximate customers per month and how many of them order in the next month too -> month,
    customers, returning."""
    sets = sketches.period_sets(orders.filter(F.col("order_date").isNotNull()), month_of("order_date"), "customer_id")
    back = sketches.returning(sets, F.add_months("period", 1))
    return back.select(F.col("period").alias("month"), F.col("estimate").alias("customers"), F.col("back").alias("returning"))


def returning_customers_checked(orders: DataFrame) -> DataFrame:
    """-> month, customers, returning (both exact), within_bound"""
    per = orders.filter(F.col("order_date").isNotNull() & F.col("customer_id").isNotNull()) \
        .select(month_of("order_date").alias("month"), "customer_id").distinct()
    ahead = per.select(F.add_months("month", -1).alias("month"), "customer_id", F.lit(1).alias("again"))
    exact = per.join(ahead, ["month", "customer_id"], "left").groupBy("month").agg(
        F.count(F.lit(1)).alias("customers"), F.count("again").alias("returning"))
    about = returning_customers(orders).select("month", F.col("customers").alias("c"), F.col("returning").alias("r"))
    # an intersection is as exact as the union of its sets
    off = F.greatest(F.lit(1.0), 2 * F.greatest("customers", "c") * (DEVIATIONS / (1 << sketches.LG_DISTINCT) ** 0.5))
    close = (F.abs(F.col("c") - F.col("customers")) <= off) & (F.abs(F.col("r") - F.col("returning")) <= off)
    return exact.join(about, "month").select("month", "customers", "returning", close.alias("within_bound"))


def daily_amounts(orders: DataFrame) -> DataFrame:
    """(day, sketch): the order amounts of each day."""
    return sketches.daily_quantiles(orders.filter(F.col("order_date").isNotNull()), F.col("order_date"), "total_amount")


PERCENTILES = {"p25": 0.25, "p50": 0.5, "p95": 0.95}


def amounts_by_month(daily: DataFrame) -> DataFrame:
    """Approximate quartile, median and 95th percentile of order amounts per month from daily sketches."""
    return sketches.quantiles_by_period(daily, month_of("day"), list(PERCENTILES.values()), list(PERCENTILES)).withColumnRenamed("period", "month")


def amounts_by_month_checked(orders: DataFrame, daily: DataFrame) -> DataFrame:
    """-> month, orders, within_bound: whether the rank of every percentile is as exact as the sketch promises"""
    rows = orders.filter(F.col("order_date").isNotNull() & F.col("total_amount").isNotNull()).select(
        month_of("order_date").alias("month"), F.col("total_amount").cast("double").alias("x"))
    ranked = rows.join(amounts_by_month(daily), "month")
    ranks = ranked.groupBy("month").agg(
        F.count(F.lit(1)).alias("orders"),
        *[F.count_if(F.col("x") < F.col(c)).alias(f"{c}_below") for c in PERCENTILES],
        *[F.count_if(F.col("x") <= F.col(c)).alias(f"{c}_upto") for c in PERCENTILES])
    off = F.greatest(F.lit(1.0), F.col("orders") * sketches.rank_error())
    good = F.lit(True)
    for c, p in PERCENTILES.items():
        good = good & (F.col(f"{c}_below") - off <= F.col("orders") * p) & (F.col("orders") * p <= F.col(f"{c}_upto") + off)
    return ranks.select("month", "orders", good.alias("within_bound"))
