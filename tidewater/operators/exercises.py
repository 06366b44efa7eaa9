"""Exercise-sheet questions: clothing shop (S1), running club (S2) and
store orders (S3).

S1: colour(id, name, extra_fee), customer(id, first_name, last_name,
favorite_color_id), category(id, name, parent_id), clothing(id, name, size,
price, color_id, category_id), clothing_order(id, customer_id, clothing_id,
items, order_date).
S2: runner(id, name, main_distance, age, is_female), event(id, name,
start_date, city), runner_event(runner_id, event_id).
S3: customers(customer_id, full_name), orders(order_id, customer_id,
order_date, total_amount).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.common import rounded, top_k
from tidewater.functions.windows import previous_value, running_total


# ----------------------------------------------------------------------------- S1 clothing shop
def items_in_favourite_colour(clothing_order: DataFrame, customer: DataFrame, clothing: DataFrame,
                              colour: DataFrame) -> DataFrame:
    """Items bought in the buyer's favourite colour -> clothes, color, last_name, first_name."""
    items = clothing.select(F.col("id").alias("clothing_id"), F.col("name").alias("clothes"), "color_id")
    buyers = customer.select(F.col("id").alias("customer_id"), "last_name", "first_name", "favorite_color_id")
    colours = colour.select(F.col("id").alias("color_id"), F.col("name").alias("color"))
    return (clothing_order.select("customer_id", "clothing_id")
            .join(items, "clothing_id").join(buyers, "customer_id")
            .filter(F.col("color_id") == F.col("favorite_color_id"))
            .join(colours, "color_id")
            .select("clothes", "color", "last_name", "first_name"))


def non_buying_customers(customer: DataFrame, clothing_order: DataFrame, colour: DataFrame) -> DataFrame:
    """Customers without any order, with their favourite colour."""
    buyers = clothing_order.select(F.col("customer_id").alias("id"))
    colours = colour.select(F.col("id").alias("favorite_color_id"), F.col("name").alias("favorite_color"))
    return (customer.join(buyers, "id", "left_anti").join(colours, "favorite_color_id", "left")
            .select("last_name", "first_name", "favorite_color"))


def category_tree_level1(category: DataFrame) -> DataFrame:
    """Main categories (parent NULL) with each direct subcategory, or NULL."""
    main = category.filter(F.col("parent_id").isNull()).select("id", F.col("name").alias("category"))
    sub = category.select(F.col("parent_id").alias("id"), F.col("name").alias("subcategory"))
    return main.join(sub, "id", "left").select("category", "subcategory")


# ----------------------------------------------------------------------------- S2 running club
def distance_groups_over_n(runner: DataFrame, n: int = 3) -> DataFrame:
    return (runner.groupBy("main_distance").agg(F.count("id").alias("runners_number"))
            .filter(F.col("runners_number") > n))


def runners_per_event_with_zero(event: DataFrame, runner_event: DataFrame) -> DataFrame:
    """Club members per event, 0 for events nobody entered."""
    per = runner_event.groupBy("event_id").agg(F.count("runner_id").alias("n"))
    return (event.join(per, event.id == per.event_id, "left")
            .select(F.col("name").alias("event_name"), F.coalesce(F.col("n"), F.lit(0)).alias("runner_count")))


def runners_by_age_band(runner: DataFrame) -> DataFrame:
    """Runners per main distance in five age bands (50 counts as over 50)."""
    age = F.col("age")
    return runner.groupBy("main_distance").agg(
        F.count_if(age < 20).alias("under_20"),
        F.count_if(age.between(20, 29)).alias("age_20_29"),
        F.count_if(age.between(30, 39)).alias("age_30_39"),
        F.count_if(age.between(40, 49)).alias("age_40_49"),
        F.count_if(age >= 50).alias("over_50"))


# ----------------------------------------------------------------------------- S3 store orders
def top_orders_by_amount(orders: DataFrame, k: int = 3) -> DataFrame:
    top = top_k(orders, k, [F.desc("total_amount"), F.asc("order_id")])
    return top.select("order_id", "customer_id", "order_date", rounded("total_amount").alias("total_amount"))


def order_deltas(orders: DataFrame) -> DataFrame:
    """Each order with the customer's previous order value (by date, then id) and the change."""
    with_prev = previous_value(orders, "customer_id", "order_date", "order_id", "total_amount")
    return with_prev.select("order_id", "customer_id", rounded("total_amount").alias("total_amount"),
                            rounded("previous_value").alias("previous_value"),
                            rounded(F.col("total_amount") - F.col("previous_value")).alias("delta"))


def running_total_per_customer(orders: DataFrame, customers: DataFrame) -> DataFrame:
    rt = running_total(orders, "customer_id", "order_date", "order_id", "total_amount")
    return (rt.join(customers, "customer_id")
            .select("customer_id", "full_name", "order_id", "order_date",
                    rounded("total_amount").alias("total_amount"), rounded("running_total").alias("running_total")))
