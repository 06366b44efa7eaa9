"""Metamorphic pairs (the reference's 'OR' answers) and invariants on the
smallest given data set."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL
from tidewater.operators import clickstream, exercises, retail
from tidewater.sources.fixtures import Fixtures

Q = entry.queries()

# Pairs that must agree exactly.
TWINS = ["max_items_in_delivered_order", "items_with_exclusions_and_extras", "churn_after_trial"]


@pytest.mark.parametrize("name", TWINS)
def test_twin_forms_agree(spark, name):
    a = Q[name](spark, SMALL).collect()
    b = Q[name + "_alt"](spark, SMALL).collect()
    assert a == b


def test_rank_forms_name_the_same_products(spark):
    for level in ("segment", "category"):
        dense = {tuple(r) for r in Q[f"top_product_per_{level}"](spark, SMALL).collect()}
        ranked = {(r[f"{level}_name"], r["product_name"]) for r in Q[f"top_product_per_{level}_alt"](spark, SMALL).collect()}
        assert dense == ranked


def test_first_month_sign_forms_agree_up_to_rounding(spark):
    a = Q["first_month_sign_pct"](spark, SMALL).first()
    b = Q["first_month_sign_pct_alt"](spark, SMALL).first()
    assert a[0] == b[0] and abs(a[1] - b[1]) <= 0.1


def test_shares_sum_to_100(spark):
    fx = Fixtures(spark, SMALL)
    total = retail.revenue_share_by_category(fx.retail_sales, fx.product_details).agg(F.sum("revenue_percentage")).first()[0]
    assert abs(total - 100) < 0.05
    per_seg = (retail.revenue_share_product_in_segment(fx.retail_sales, fx.product_details)
               .groupBy("segment_name").agg(F.sum("revenue_percentage").alias("s"), F.count(F.lit(1)).alias("n"))
               .collect())
    # each share is rounded to 2 decimals: the sum is off by at most 0.005 per product
    assert all(abs(r["s"] - 100) <= 0.005 * r["n"] + 1e-9 for r in per_seg)


def test_last_running_total_is_customer_total(spark):
    fx = Fixtures(spark, SMALL)
    rt = exercises.running_total_per_customer(fx.store_orders, fx.store_customers)
    last = rt.groupBy("customer_id").agg(F.max_by("running_total", F.struct("order_date", "order_id")).alias("last"))
    totals = fx.store_orders.groupBy("customer_id").agg(F.sum("total_amount").cast("double").alias("t"))
    bad = last.join(totals, "customer_id").filter(F.abs(F.col("last") - F.col("t")) > 0.005)
    assert bad.count() == 0


def test_funnel_purchases_plus_abandoned_equal_visits_with_cart_adds(spark):
    fx = Fixtures(spark, SMALL)
    vpe = clickstream.visit_product_events(fx.click_events, fx.page_hierarchy)
    with_cart = vpe.filter(F.col("cart_add") >= 1).groupBy("product_id").count()
    funnel = clickstream.product_funnel(fx.click_events, fx.page_hierarchy)
    bad = funnel.join(with_cart, "product_id").filter(F.col("purchases") + F.col("abandoned") != F.col("count"))
    assert bad.count() == 0
