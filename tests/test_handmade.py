"""Hand-made fixtures with worked answers for the traps listed in SURVEY
2.13 (ties, null tokens, empty months, zero balances, overlapping
campaigns, repeated cart adds, basket sizes)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidewater.operators import accounts, clickstream, delivery, loyalty, retail, subscriptions, weekly_sales

D = dt.date
TS = dt.datetime


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ----------------------------------------------------------------------------- CS1
def _diner(spark):
    menu = spark.createDataFrame([(1, "PROMO", 10), (2, "LARGE", 15), (3, "SMALL", 12)],
                                 "product_id int, product_name string, price int")
    sales = spark.createDataFrame([
        (1, D(2021, 1, 1), 1), (1, D(2021, 1, 1), 2), (1, D(2021, 1, 7), 3), (1, D(2021, 1, 10), 3),
        (2, D(2021, 1, 2), 2), (2, D(2021, 1, 3), 3), (2, D(2021, 2, 2), 1),
    ], "customer_id long, order_date date, product_id int")
    members = spark.createDataFrame([(1, D(2021, 1, 7)), (2, D(2021, 1, 2))], "customer_id long, join_date date")
    return sales, menu, members


def test_first_items_keeps_all_items_of_first_day(spark):
    sales, menu, _ = _diner(spark)
    assert rows(loyalty.first_items(sales, menu), "customer_id", "product_name") == [
        (1, "LARGE"), (1, "PROMO"), (2, "LARGE")]


def test_first_item_after_join_breaks_ties_by_product(spark):
    sales, menu, members = _diner(spark)
    got = rows(loyalty.first_item_after_join(sales, menu, members), "customer_id", "product_name")
    assert got == [(1, "SMALL"), (2, "SMALL")]


def test_points_with_bonus_week(spark):
    sales, menu, members = _diner(spark)
    got = rows(loyalty.loyalty_points_with_bonus_window(sales, menu, members, "2021-01-31"), "customer_id", "points")
    # customer 1: 7 Jan and 10 Jan SMALL, both in the bonus week -> 2 * 2 * 12 * 10
    # customer 2: 2 Jan LARGE (bonus) 300 + 3 Jan SMALL (bonus) 240; February excluded
    assert got == [(1, 480), (2, 540)]


# ----------------------------------------------------------------------------- CS2
def test_runner_order_cleaning(spark):
    raw = spark.createDataFrame([
        (1, 1, "2022-03-04 11:05:09", "7km", "41 minutes", ""),
        (2, 1, "null", "null", "null", "Restaurant Cancellation"),
        (3, 2, None, None, None, None),
        (4, 2, "2022-03-05 23:59:01", "8.6 km", "19mins", "null"),
        (5, 3, "2020-01-03 01:00:00", "10", "15 minute", " "),
    ], "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    got = rows(delivery.clean_runner_orders(raw), "order_id", "pickup_time", "distance", "duration", "cancellation")
    assert got == [
        (1, TS(2022, 3, 4, 11, 5, 9), 7.0, 41, None),
        (2, None, None, None, "Restaurant Cancellation"),
        (3, None, None, None, None),
        (4, TS(2022, 3, 5, 23, 59, 1), 8.6, 19, None),
        (5, TS(2020, 1, 3, 1, 0, 0), 10.0, 15, None),
    ]


def test_null_tokens_and_change_counts(spark):
    orders = spark.createDataFrame([
        (1, 7, 1, "null", "", TS(2020, 1, 1, 18)),
        (1, 7, 2, "4", None, TS(2020, 1, 1, 18)),
        (2, 7, 1, " ", "1, 5", TS(2020, 1, 2, 18)),
        (3, 8, 1, None, "null", TS(2020, 1, 3, 18)),
    ], "order_id int, customer_id int, pizza_id int, exclusions string, extras string, order_time timestamp_ntz")
    runner = spark.createDataFrame([(1, 1, "2020-01-01 18:20:00", "5km", "10", None),
                                    (2, 1, "2020-01-02 18:30:00", "5", "10", None),
                                    (3, 1, "null", "null", "null", "Customer Cancellation")],
                                   "order_id int, runner_id int, pickup_time string, distance string, "
                                   "duration string, cancellation string")
    co, cr = delivery.clean_customer_orders(orders), delivery.clean_runner_orders(runner)
    assert rows(co, "order_id", "pizza_id", "exclusions", "extras") == [
        (1, 1, None, None), (1, 2, "4", None), (2, 1, None, "1, 5"), (3, 1, None, None)]
    assert rows(delivery.changed_vs_unchanged(co, cr), "customer_id", "no_changes", "at_least_one_change") == [
        (7, 1, 2)]
    # pickup minutes per order, not per pizza: order 1 -> 20, order 2 -> 30
    assert rows(delivery.avg_pickup_minutes(co, cr), "runner_id", "avg_pickup_minutes") == [(1, 25.0)]


def _pizza_menu(spark):
    recipes = spark.createDataFrame([(10, "1, 2, 3"), (20, "1, 2, 13, 14")], "pizza_id long, toppings string")
    names = spark.createDataFrame([(10, "Meatlovers"), (20, "Supreme")], "pizza_id long, pizza_name string")
    toppings = spark.createDataFrame([(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (13, "anchovy")],
                                     "topping_id int, topping_name string")
    return recipes, names, toppings


LINE_DDL = "order_id int, customer_id int, pizza_id long, exclusions string, extras string"


def test_ingredient_list_with_double_topping(spark):
    orders = spark.createDataFrame([(1, 7, 10, "3", "1, 4"), (2, 8, 10, "1,2,3", None)], LINE_DDL)
    recipes, names, toppings = _pizza_menu(spark)
    got = rows(delivery.order_ingredient_list(orders, names, recipes, toppings), "order_id", "ingredient_list")
    assert got == [(1, "Meatlovers: 2xBacon, BBQ Sauce, Cheese"), (2, "Meatlovers: ")]
    label = rows(delivery.order_item_label(orders, names, toppings), "order_id", "order_item")
    assert label == [(1, "Meatlovers - Exclude Beef - Extra Bacon, Cheese"),
                     (2, "Meatlovers - Exclude Bacon, BBQ Sauce, Beef")]


def test_toppings_come_from_the_table_and_unnamed_ids_stay(spark):
    # two equal lines, an id beyond the usual list (13) and one that the table lacks (14)
    orders = spark.createDataFrame([(1, 7, 20, None, "1, 13"), (1, 7, 20, None, "1, 13"), (2, 8, 20, "14", "14, 2")], LINE_DDL)
    runner = spark.createDataFrame([(1, 1, None, 5.0, 10), (2, 1, None, 5.0, 10)],
                                   "order_id int, runner_id int, pickup_time timestamp_ntz, distance double, duration int")
    recipes, names, toppings = _pizza_menu(spark)
    got = rows(delivery.order_ingredient_list(orders, names, recipes, toppings), "order_id", "ingredient_list")
    assert got == [(1, "Supreme: #14, 2xanchovy, 2xBacon, BBQ Sauce")] * 2 + [(2, "Supreme: #14, anchovy, Bacon, 2xBBQ Sauce")]
    label = rows(delivery.order_item_label(orders, names, toppings), "order_id", "order_item")
    assert label == [(1, "Supreme - Extra Bacon, anchovy")] * 2 + [(2, "Supreme - Exclude #14 - Extra #14, BBQ Sauce")]
    totals = delivery.ingredient_totals_delivered(orders, runner, recipes, toppings).collect()
    assert [tuple(r) for r in totals] == [  # most frequent first
        (1, "Bacon", 5), (13, "anchovy", 5), (2, "BBQ Sauce", 4), (14, "#14", 3)]
    listed = rows(delivery.standard_ingredients(recipes, names, toppings), "pizza_id", "standard_ingredients")
    assert listed == [(10, "Bacon, BBQ Sauce, Beef"), (20, "#14, anchovy, Bacon, BBQ Sauce")]
    assert tuple(delivery.most_common_exclusion(orders, toppings).first()) == (14, "#14", 1)
    assert tuple(delivery.most_common_extra(orders, toppings).first()) == (1, "Bacon", 2)


# ----------------------------------------------------------------------------- CS3
def test_days_to_annual_histogram_bins(spark):
    subs = spark.createDataFrame([
        (1, 0, D(2020, 1, 1)), (1, 3, D(2020, 1, 1)),      # 0 days
        (2, 0, D(2020, 1, 1)), (2, 3, D(2020, 1, 31)),     # 30 days
        (3, 0, D(2020, 1, 1)), (3, 3, D(2020, 2, 1)),      # 31 days
        (4, 0, D(2020, 1, 1)), (4, 3, D(2020, 12, 31)),    # 365 days
    ], "customer_id long, plan_id int, start_date date")
    got = rows(subscriptions.days_to_annual_histogram(subs), "bucket", "num_of_customers")
    assert got == [("0 - 30 days", 2), ("31 - 60 days", 1), ("361 - 390 days", 1)]


def test_downgrade_forms_differ_only_on_non_immediate(spark):
    subs = spark.createDataFrame([
        (1, 2, D(2020, 1, 1)), (1, 1, D(2020, 2, 1)),                          # immediate
        (2, 2, D(2020, 1, 1)), (2, 3, D(2020, 2, 1)), (2, 1, D(2020, 3, 1)),   # later, not immediate
    ], "customer_id long, plan_id int, start_date date")
    assert subscriptions.downgrades(subs, 2020).first()[0] == 2
    assert subscriptions.downgrades_immediate(subs, 2020).first()[0] == 1


# ----------------------------------------------------------------------------- CS4
def test_monthly_balances_fill_empty_months(spark):
    txns = spark.createDataFrame([
        (1, D(2020, 1, 5), "deposit", Decimal("100.00")),
        (1, D(2020, 1, 20), "purchase", Decimal("30.00")),
        (1, D(2020, 3, 2), "withdrawal", Decimal("100.00")),
        (2, D(2020, 2, 1), "deposit", Decimal("0.00")),
    ], "customer_id long, txn_date date, txn_type string, txn_amount decimal(18,2)")
    bal = accounts.monthly_balances(txns)
    got = rows(bal, "customer_id", "ending_month", "total_monthly_change", "ending_balance")
    assert got == [
        (1, D(2020, 1, 31), Decimal("70.00"), Decimal("70.00")),
        (1, D(2020, 2, 29), Decimal("0.00"), Decimal("70.00")),
        (1, D(2020, 3, 31), Decimal("-100.00"), Decimal("-30.00")),
        (2, D(2020, 2, 29), Decimal("0.00"), Decimal("0.00")),
        (2, D(2020, 3, 31), Decimal("0.00"), Decimal("0.00")),
    ]
    # zero opening balance is neither an increase nor a reduction; 1 of 2 customers goes + to -
    assert accounts.balance_increase_pct(bal).first()[0] == 0.0
    assert accounts.positive_to_negative_pct(bal).first()[0] == 0.0
    assert rows(accounts.first_month_sign_pct(bal), "negative_first_month_percentage",
                "positive_first_month_percentage") == [(0.0, 100.0)]


# ----------------------------------------------------------------------------- CS5
def test_before_after_uses_dates_around_pivot(spark):
    raw = spark.createDataFrame([
        ("8/6/20", "ASIA", "Retail", "C1", "New", 10, 100),
        ("15/6/20", "ASIA", "Retail", "F2", "New", 10, 150),
        ("1/6/20", "ASIA", "Shopify", "null", "New", 5, 50),
        ("13/7/20", "ASIA", "Shopify", "C3", "New", 5, 1000),   # outside 4 weeks
    ], "week_date string, region string, platform string, segment string, customer_type string, "
       "transactions int, sales bigint")
    clean = weekly_sales.clean_weekly_sales(raw)
    assert rows(clean.filter(F.col("week_date") == D(2020, 6, 15)), "week_number", "age_band", "demographic") == [
        (25, "Middle Aged", "Families")]
    got = weekly_sales.before_after(clean, "2020-06-15", 4).first()
    assert (got["sales_variance"], got["variance_percentage"]) == (0, 0.0)


# ----------------------------------------------------------------------------- CS6
def _clicks(spark):
    pages = spark.createDataFrame([(3, "Trout", "Fish", 1), (4, "Crab", "Shellfish", 2), (12, "Checkout", None, None)],
                                  "page_id int, page_name string, product_category string, product_id int")
    ev = spark.createDataFrame([
        ("v1", "c1", 3, 1, 1, TS(2024, 1, 9, 10, 0)),
        ("v1", "c1", 3, 2, 2, TS(2024, 1, 9, 10, 1)),
        ("v1", "c1", 3, 2, 3, TS(2024, 1, 9, 10, 2)),     # same product added twice
        ("v1", "c1", 4, 2, 4, TS(2024, 1, 9, 10, 3)),
        ("v1", "c1", 12, 1, 5, TS(2024, 1, 9, 10, 4)),
        ("v1", "c1", 13, 3, 6, TS(2024, 1, 9, 10, 5)),
        ("v2", "c1", 4, 1, 1, TS(2024, 1, 25, 9, 0)),
        ("v2", "c1", 4, 2, 2, TS(2024, 1, 25, 9, 1)),
        ("v2", "c1", 12, 1, 3, TS(2024, 1, 25, 9, 2)),
        ("v3", "c2", 3, 4, 1, TS(2024, 2, 20, 9, 0)),
    ], "visit_id string, cookie_id string, page_id int, event_type int, sequence_number int, event_time timestamp_ntz")
    users = spark.createDataFrame([(1, "c1"), (2, "c2")], "user_id long, cookie_id string")
    camps = spark.createDataFrame([
        (1, "1-2", "Early", TS(2024, 1, 1), TS(2024, 1, 10, 23, 59, 59)),
        (2, "1-2", "Overlap", TS(2024, 1, 8), TS(2024, 1, 15, 23, 59, 59)),
    ], "campaign_id int, products string, campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    return users, ev, pages, camps


def test_product_funnel_counts_repeat_cart_adds(spark):
    _, ev, pages, _ = _clicks(spark)
    got = rows(clickstream.product_funnel(ev, pages), "product_name", "views", "cart_adds", "abandoned", "purchases")
    assert got == [("Crab", 1, 2, 1, 1), ("Trout", 1, 2, 0, 1)]
    assert clickstream.checkout_no_purchase_pct(ev).first()[0] == 50.0


def test_visit_summary_campaign_and_cart_order(spark):
    users, ev, pages, camps = _clicks(spark)
    got = rows(clickstream.visit_campaign_summary(users, ev, pages, camps),
               "visit_id", "page_views", "cart_adds", "purchase", "campaign_name", "impression", "cart_products")
    assert got == [("v1", 2, 3, 1, "Overlap", 0, "Trout, Trout, Crab"),
                   ("v2", 2, 1, 0, None, 0, "Crab"),
                   ("v3", 0, 0, 0, None, 1, None)]


# ----------------------------------------------------------------------------- CS7
def test_triple_only_from_three_product_baskets(spark):
    sales = spark.createDataFrame([
        (1, 1, Decimal("10.00"), 0, True, 100), (2, 1, Decimal("10.00"), 0, True, 100),
        (3, 1, Decimal("10.00"), 0, True, 100), (3, 2, Decimal("10.00"), 0, True, 100),   # duplicate line
        (1, 1, Decimal("10.00"), 0, True, 101), (2, 1, Decimal("10.00"), 0, True, 101),
        (3, 1, Decimal("10.00"), 0, True, 101),
        (1, 1, Decimal("10.00"), 0, True, 102), (2, 1, Decimal("10.00"), 0, True, 102),   # 2 products
        (1, 1, Decimal("10.00"), 0, True, 103), (2, 1, Decimal("10.00"), 0, True, 103),
        (3, 1, Decimal("10.00"), 0, True, 103), (4, 1, Decimal("10.00"), 0, True, 103),
        (5, 1, Decimal("10.00"), 0, True, 103),                                           # 5 products
    ], "prod_id long, qty int, price decimal(18,2), discount int, member boolean, txn_id long")
    details = spark.createDataFrame([(i, f"P{i}", 1, 101, "Cat", "Seg") for i in range(1, 6)],
                                    "product_id long, product_name string, category_id int, segment_id int, "
                                    "category_name string, segment_name string")
    top = retail.top_product_triple(sales, details).first()
    assert (top["product_id_1"], top["product_id_2"], top["product_id_3"], top["combination_count"]) == (1, 2, 3, 2)
    assert top["product_name_2"] == "P2"


def test_revenue_and_discount_definitions(spark):
    sales = spark.createDataFrame([(1, 2, Decimal("10.50"), 10, True, 1), (1, 1, Decimal("10.50"), 5, False, 2)],
                                  "prod_id long, qty int, price decimal(18,2), discount int, member boolean, txn_id long")
    details = spark.createDataFrame([(1, "P1", 1, 101, "Cat", "Seg")],
                                    "product_id long, product_name string, category_id int, segment_id int, "
                                    "category_name string, segment_name string")
    r = retail.segment_totals(sales, details).first()
    # revenue = sum(price * qty) = 31.50; discount = 21.00 * 10% + 10.50 * 5% = 2.625 -> 2.63
    assert (r["total_quantity"], r["total_revenue"], r["total_discount"]) == (3, 31.5, 2.63)


def test_missing_weeks_are_those_without_sales(spark):
    clean = spark.createDataFrame([(1,), (3,), (3,), (5,), (None,)], "week_number int")
    assert rows(weekly_sales.missing_weeks(clean, weeks_in_year=5), "week_number") == [(2,), (4,)]


def test_business_areas_worst_first(spark):
    clean = spark.createDataFrame(
        [(D(2020, 6, 8), "A", 100), (D(2020, 6, 15), "A", 50), (D(2020, 6, 8), "B", 100), (D(2020, 6, 15), "B", 120),
         (D(2020, 6, 15), "C", 10)], "week_date date, region string, sales bigint")
    got = weekly_sales.business_area_impact(clean, "2020-06-15", 12, areas=("region",)).collect()
    assert [(r.area_value, r.variance_percentage) for r in got] == [("A", -50.0), ("B", 20.0), ("C", None)]


def test_width_bucket_histogram(spark):
    days = [0, 30, 31, 364, 365]
    subs = spark.createDataFrame(
        [(i, p, D(2020, 1, 1) + dt.timedelta(days=d if p == 3 else 0)) for i, d in enumerate(days) for p in (0, 3)],
        "customer_id int, plan_id int, start_date date")
    got = [tuple(r) for r in subscriptions.days_to_annual_histogram(subs, method="width_bucket").collect()]
    assert got == [("0 - 30 days", 2), ("30 - 60 days", 1), ("330 - 360 days", 1), ("360 - 390 days", 1)]


def test_visit_summary_counts_a_visit_over_several_cookies_and_long_campaigns(spark):
    users = spark.createDataFrame([(1, "a"), (1, "b")], "user_id int, cookie_id string")
    events = spark.createDataFrame(
        [("v", "a", 1, 1, 1, TS(2020, 2, 1, 0, 0)), ("v", "b", 2, 2, 2, TS(2020, 2, 1, 0, 1)),
         ("v", "a", 2, 2, 3, TS(2020, 2, 1, 0, 2)), ("w", "a", 1, 1, 1, TS(2020, 3, 2, 0, 0)),
         ("x", "none", 1, 1, 1, TS(2020, 3, 2, 0, 0))],
        "visit_id string, cookie_id string, page_id int, event_type int, sequence_number int, event_time timestamp_ntz")
    pages = spark.createDataFrame([(1, "Home", None), (2, "Tea", 7)], "page_id int, page_name string, product_id int")
    camps = spark.createDataFrame(
        [(1, "Long", TS(2020, 1, 1), TS(2020, 3, 1)), (2, "Backwards", TS(2020, 3, 3), TS(2020, 3, 1)), (3, "Open", None, TS(2020, 4, 1))],
        "campaign_id int, campaign_name string, start_date timestamp_ntz, end_date timestamp_ntz")
    got = clickstream.visit_campaign_summary(users, events, pages, camps)
    assert rows(got, "visit_id", "page_views", "cart_adds", "campaign_name", "cart_products") == [
        ("v", 1, 2, "Long", "Tea, Tea"), ("w", 1, 0, None, None)]


def test_a_customer_downgrades_once_however_often_plans_change(spark):
    days = ["2020-01-05", "2020-02-05", "2020-03-05", "2020-04-05"]
    events = [(1, 2, 0), (1, 1, 1), (1, 2, 2), (1, 1, 3), (2, 1, 0), (2, 2, 1), (3, 2, 0), (3, 1, 0), (4, 2, 1), (4, 4, 2), (4, 1, 3), (5, 1, 2)]
    subs = spark.createDataFrame([(c, p, days[d]) for c, p, d in events], "customer_id int, plan_id int, start_date string") \
        .withColumn("start_date", F.to_date("start_date"))
    assert subscriptions.downgrades(subs, 2020).first()[0] == 2  # customers 1 and 4
    assert subscriptions.downgrades(subs, 2021).first()[0] == 0


def test_two_digit_years_have_a_century(spark):
    raw = spark.createDataFrame([(d, "r", "p", "C1", "New", 1, 10) for d in ("1/2/69", "1/2/70", "29/2/96", "31/12/99", "1/1/00", "15/6/20", "x")],
                                "week_date string, region string, platform string, segment string, customer_type string, transactions int, sales int")
    got = [str(r.week_date) for r in weekly_sales.clean_weekly_sales(raw).select("week_date").collect()]
    assert got == ["2069-02-01", "1970-02-01", "1996-02-29", "1999-12-31", "2000-01-01", "2020-06-15", "None"]


def test_reports_come_sorted(spark):
    from tests.conftest import SMALL
    from tidewater.plans import registry
    for name, columns in registry.REPORT_ORDER.items():
        rows = registry.run(name, spark, SMALL).collect()
        c = columns[0].lstrip("-")
        values = [r[c] for r in rows]
        known = sorted((v for v in values if v is not None), reverse=columns[0][0] == "-")
        none = [None] * (len(values) - len(known))
        assert values == (none + known if columns[0][0] == "-" else known + none), name
    df = spark.createDataFrame([(None, 1), (2, 2), (1, 3)], "customer_id int, total_sales int")
    assert [r[0] for r in registry.in_report_order("customer_spend", df).collect()] == [1, 2, None]
    share = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "product_name string, purchase_per_view_percentage double")
    assert [r[0] for r in registry.in_report_order("view_to_purchase_pct", share).collect()] == ["b", "c", "a"]
