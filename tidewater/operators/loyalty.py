"""Restaurant loyalty questions over sales(customer_id, order_date, product_id),
menu(product_id, product_name, price) and members(customer_id, join_date).

The menu is a lookup whose join the planner picks; sales is the fact table and is
shuffled by customer for the per-customer aggregates and ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.common import top_k, top_per_group


def _priced(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return sales.join(menu, "product_id")


def customer_spend(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Total amount each customer spent -> customer_id, total_sales."""
    return (_priced(sales, menu).groupBy("customer_id")
            .agg(F.sum("price").cast("bigint").alias("total_sales")))


def customer_visit_days(sales: DataFrame) -> DataFrame:
    """Distinct days each customer visited -> customer_id, visit_count."""
    return sales.groupBy("customer_id").agg(F.count_distinct("order_date").alias("visit_count"))


def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Every item bought on each customer's first visit day -> customer_id, product_name."""
    firsts = top_per_group(_priced(sales, menu), ["customer_id"], [F.col("order_date")], 1, "dense_rank")
    return firsts.select("customer_id", "product_name").distinct()


def most_purchased_item(sales: DataFrame, menu: DataFrame, k: int = 1) -> DataFrame:
    """The k most purchased items -> product_name, purchased_times (ties broken by name)."""
    counts = (_priced(sales, menu).groupBy("product_name")
              .agg(F.count("product_id").alias("purchased_times")))
    return top_k(counts, k, [F.desc("purchased_times"), F.asc("product_name")])


def favourite_item_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Most bought item(s) per customer, ties kept -> customer_id, product_name, order_count."""
    counts = (_priced(sales, menu).groupBy("customer_id", "product_name")
              .agg(F.count("product_id").alias("order_count")))
    return top_per_group(counts, ["customer_id"], [F.desc("order_count")], 1, "dense_rank")


def _member_sales(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    return _priced(sales, menu).join(members, "customer_id")


def first_item_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """First item bought after joining -> customer_id, product_name.

    The reference orders by date only (arbitrary row on ties); ties are
    broken here by product_id so the answer is deterministic.
    """
    after = _member_sales(sales, menu, members).filter(F.col("order_date") > F.col("join_date"))
    first = top_per_group(after, ["customer_id"], [F.asc("order_date"), F.asc("product_id")], 1,
                          "row_number")
    return first.select("customer_id", "product_name")


def last_item_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Last item bought before joining -> customer_id, product_name (ties by product_id)."""
    before = _member_sales(sales, menu, members).filter(F.col("order_date") < F.col("join_date"))
    last = top_per_group(before, ["customer_id"], [F.desc("order_date"), F.asc("product_id")], 1,
                         "row_number")
    return last.select("customer_id", "product_name")


def spend_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Items and amount before joining -> customer_id, total_items, amount."""
    before = _member_sales(sales, menu, members).filter(F.col("order_date") < F.col("join_date"))
    return before.groupBy("customer_id").agg(F.count("product_id").alias("total_items"),
                                             F.sum("price").cast("bigint").alias("amount"))


def loyalty_points(sales: DataFrame, menu: DataFrame, double_item: str = "PROMO",
                   points_per_unit: int = 10) -> DataFrame:
    """10 points per $1, double for ``double_item`` -> customer_id, points."""
    price = F.col("price")
    pts = F.when(F.col("product_name") == double_item, price * 2 * points_per_unit) \
        .otherwise(price * points_per_unit)
    return (_priced(sales, menu).groupBy("customer_id")
            .agg(F.sum(pts).cast("bigint").alias("points")))


def loyalty_points_with_bonus_window(sales: DataFrame, menu: DataFrame, members: DataFrame,
                                     month: str, double_item: str = "PROMO", bonus_days: int = 7,
                                     points_per_unit: int = 10, from_join: bool = True) -> DataFrame:
    """Points up to the end of ``month`` with double points in the first week of membership.

    Sales count from the join date (inclusive) to the month end; the join
    day and the following ``bonus_days - 1`` days earn double on every item.
    ``from_join=False`` also counts purchases before joining (the reference
    drops them).  -> customer_id, points
    """
    last_date = F.last_day(F.lit(month).cast("date"))
    m = members.select("customer_id", "join_date",
                       F.date_add("join_date", bonus_days - 1).alias("valid_date"))
    joined = _priced(sales, menu).join(m, "customer_id")
    cond = F.col("order_date") <= last_date
    if from_join:
        cond = cond & (F.col("join_date") <= F.col("order_date"))
    price = F.col("price")
    pts = (F.when(F.col("product_name") == double_item, price * 2 * points_per_unit)
           .when(F.col("order_date").between(F.col("join_date"), F.col("valid_date")),
                 price * 2 * points_per_unit)
           .otherwise(price * points_per_unit))
    return joined.filter(cond).groupBy("customer_id").agg(F.sum(pts).cast("bigint").alias("points"))
