"""Clickstream funnel and campaign analysis over users(user_id, cookie_id),
events(visit_id, cookie_id, page_id, event_type, sequence_number,
event_time), event_identifier, page_hierarchy and campaign_identifier.

Event types: 1 page view, 2 add to cart, 3 purchase, 4 ad impression,
5 ad click.  Page 12 is the checkout page.

Plan shape of the funnel: events are reduced to one row per visit and
product (map-side partial aggregate, so a very busy visit shrinks before
the shuffle), purchase visits to one row per visit, and the two meet in
one equi-join on visit_id.  How page and campaign tables are joined is left
to the planner.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.common import avg_round, pct, ratio, top_k
from tidewater.functions.intervals import interval_pairs

VIEW, CART_ADD, PURCHASE, IMPRESSION, AD_CLICK = 1, 2, 3, 4, 5
CHECKOUT_PAGE = 12


def _is(t: int) -> Column:
    return F.col("event_type") == t


def user_count(users: DataFrame) -> DataFrame:
    return users.agg(F.count_distinct("user_id").alias("number_of_users"))


def avg_cookies_per_user(users: DataFrame) -> DataFrame:
    per = users.groupBy("user_id").agg(F.count("cookie_id").alias("cookie_count"))
    return per.agg(avg_round("cookie_count").alias("avg_cookies_per_user"))


def visits_by_month(users: DataFrame, events: DataFrame) -> DataFrame:
    joined = events.join(users, "cookie_id")
    return (joined.groupBy(F.month("event_time").alias("month_number"),
                           F.date_format("event_time", "MMMM").alias("month_name"))
            .agg(F.count_distinct("visit_id").alias("visit_count")))


def events_by_type(events: DataFrame, event_identifier: DataFrame) -> DataFrame:
    counts = events.groupBy("event_type").agg(F.count("event_type").alias("event_count"))
    return counts.join(event_identifier, "event_type") \
        .select("event_type", "event_name", "event_count")


def purchase_visit_pct(events: DataFrame) -> DataFrame:
    """Share of visits with at least one purchase (distinct visits, not events)."""
    visits = _visit_flags(events.filter(F.col("visit_id").isNotNull()))
    return visits.agg(pct(F.sum("purchase"), F.count("visit_id"), 2).alias("purchased_percentage"))


def _visit_flags(events: DataFrame) -> DataFrame:
    return events.groupBy("visit_id").agg(
        F.max(F.when(_is(VIEW) & (F.col("page_id") == CHECKOUT_PAGE), 1).otherwise(0)).alias("checkout"),
        F.max(F.when(_is(PURCHASE), 1).otherwise(0)).alias("purchase"))


def checkout_no_purchase_pct(events: DataFrame) -> DataFrame:
    """Of the visits that viewed the checkout page, the share without a purchase."""
    flags = _visit_flags(events)
    return flags.agg(pct(F.count_if((F.col("checkout") == 1) & (F.col("purchase") == 0)),
                         F.count_if(F.col("checkout") == 1), 2)
                     .alias("percentage_checkout_view_with_no_purchase"))


def top_pages_by_views(events: DataFrame, page_hierarchy: DataFrame, k: int = 3) -> DataFrame:
    views = (events.filter(_is(VIEW)).groupBy("page_id").agg(F.count(F.lit(1)).alias("views_count"))
             .join(page_hierarchy, "page_id"))
    return top_k(views, k, [F.desc("views_count"), F.asc("page_id")]).select("page_name", "views_count")


def views_and_carts_by_category(events: DataFrame, page_hierarchy: DataFrame) -> DataFrame:
    per_page = events.groupBy("page_id").agg(F.count_if(_is(VIEW)).alias("v"), F.count_if(_is(CART_ADD)).alias("c"))
    joined = per_page.join(page_hierarchy, "page_id").filter(F.col("product_category").isNotNull())
    return joined.groupBy("product_category").agg(F.sum("v").alias("views_count"),
                                                   F.sum("c").alias("add_to_cart_count"))


def visit_product_events(events: DataFrame, page_hierarchy: DataFrame) -> DataFrame:
    """One row per visit and product with views, cart adds and the visit's purchase flag."""
    products = (page_hierarchy.filter(F.col("product_id").isNotNull())
                .select("page_id", "product_id", F.col("page_name").alias("product_name"), "product_category"))
    # One scan: counts per (visit, page), including the purchase events of
    # the visit, reduced map-side.  The visit's purchase flag is then a
    # window over that visit's page rows (at most one per page, so bounded
    # however many events a visit has).
    per_page = events.groupBy("visit_id", "page_id").agg(
        F.count_if(_is(VIEW)).alias("page_view"), F.count_if(_is(CART_ADD)).alias("cart_add"),
        F.count_if(_is(PURCHASE)).alias("_purchases"))
    flagged = per_page.withColumn(
        "purchase", F.max(F.when(F.col("_purchases") > 0, 1).otherwise(0)).over(Window.partitionBy("visit_id")))
    return (flagged.join(products, "page_id")
            .select("visit_id", "product_id", "product_name", "product_category", "page_view", "cart_add",
                    "purchase"))


def _funnel(vpe: DataFrame, keys: list[str]) -> DataFrame:
    added = F.col("cart_add") >= 1
    return vpe.groupBy(*keys).agg(
        F.sum("page_view").alias("views"),
        F.sum("cart_add").alias("cart_adds"),
        F.count_if(added & (F.col("purchase") == 0)).alias("abandoned"),
        F.count_if(added & (F.col("purchase") == 1)).alias("purchases"))


def product_funnel(events: DataFrame, page_hierarchy: DataFrame) -> DataFrame:
    """views, cart_adds, abandoned (added, no purchase in the visit), purchases per product."""
    return _funnel(visit_product_events(events, page_hierarchy),
                   ["product_id", "product_name", "product_category"])


def category_funnel(events: DataFrame, page_hierarchy: DataFrame) -> DataFrame:
    return _funnel(visit_product_events(events, page_hierarchy), ["product_category"])


def view_to_purchase_pct(funnel: DataFrame) -> DataFrame:
    return funnel.select("product_name", "product_category",
                         pct(F.col("purchases"), F.col("views"), 2).alias("purchase_per_view_percentage"))


def _avg_rate(funnel: DataFrame, num: str, den: str, name: str) -> DataFrame:
    rate = F.try_divide(F.col(num).cast("decimal(24,4)"), F.col(den).cast("decimal(24,4)"))
    return funnel.agg(F.round(F.avg(rate) * 100, 2).cast("double").alias(name))


def avg_view_to_cart_rate(funnel: DataFrame) -> DataFrame:
    return _avg_rate(funnel, "cart_adds", "views", "avg_view_to_cart_add_conversion")


def avg_cart_to_purchase_rate(funnel: DataFrame) -> DataFrame:
    return _avg_rate(funnel, "purchases", "cart_adds", "avg_cart_add_to_purchases_conversion_rate")


def top_products_by_purchase(funnel: DataFrame, k: int = 3) -> DataFrame:
    return top_k(funnel, k, [F.desc("purchases"), F.asc("product_id")]).select("product_name", "purchases")


def top_product_by_funnel_metric(funnel: DataFrame,
                                 metrics=("views", "cart_adds", "purchases", "abandoned")) -> DataFrame:
    """The leading product for each funnel metric -> metric, product_name, value.

    The funnel has one row per product, so the unpivot + rank works on a
    small table.
    """
    long = funnel.select("product_id", "product_name", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value")) for m in metrics])).alias("m"))
    long = long.select("product_id", "product_name", "m.metric", "m.value")
    from tidewater.functions.common import top_per_group
    best = top_per_group(long, ["metric"], [F.desc("value"), F.asc("product_id")], 1, "row_number")
    return best.select("metric", "product_name", "value")


def visit_campaign_summary(users: DataFrame, events: DataFrame, page_hierarchy: DataFrame,
                           campaign_identifier: DataFrame) -> DataFrame:
    """One row per visit: user, start time, page views, cart adds, purchase
    flag, ad impressions and clicks, the campaign running at the visit's
    start, and the products added to the cart in the order they were added.

    Where campaigns overlap, the visit goes to the one that started last; a
    campaign without an end (NULL, or a date far off) is still running, one
    without a start has not begun.
    Events are reduced to one row per visit and cookie before users are
    joined; visits meet the campaigns by an interval join.
    """
    pages = page_hierarchy.select("page_id", "page_name", "product_id")
    cart_item = F.when(_is(CART_ADD) & F.col("product_id").isNotNull(),
                       F.struct(F.col("sequence_number").alias("seq"), F.col("page_name").alias("name")))
    per_cookie = events.join(pages, "page_id", "left").groupBy("cookie_id", "visit_id").agg(
        F.min("event_time").alias("visit_start_time"),
        F.count_if(_is(VIEW)).alias("page_views"),
        F.count_if(_is(CART_ADD)).alias("cart_adds"),
        F.max(F.when(_is(PURCHASE), 1).otherwise(0)).alias("purchase"),
        F.count_if(_is(IMPRESSION)).alias("impression"),
        F.count_if(_is(AD_CLICK)).alias("click"),
        F.collect_list(cart_item).alias("cart_items"))
    visits = per_cookie.join(users, "cookie_id").groupBy("user_id", "visit_id").agg(
        F.min("visit_start_time").alias("visit_start_time"),
        *[F.sum(c).alias(c) for c in ("page_views", "cart_adds")],
        F.max("purchase").alias("purchase"),
        *[F.sum(c).alias(c) for c in ("impression", "click")],
        F.flatten(F.collect_list("cart_items")).alias("cart_items"))
    camps = campaign_identifier.filter(F.col("start_date").isNotNull()).select(
        "campaign_id", "campaign_name", F.col("start_date").alias("c_start"), F.col("end_date").alias("c_end"))
    matched = interval_pairs(visits, camps, "visit_start_time", "c_start", "c_end", keep_points=True)
    same = ["visit_start_time", "page_views", "cart_adds", "purchase", "impression", "click", "cart_items"]
    picked = matched.groupBy("user_id", "visit_id").agg(
        *[F.any_value(c).alias(c) for c in same],
        F.max_by("campaign_name", F.struct(F.col("c_start"), -F.col("campaign_id"))).alias("campaign_name"))
    cart = F.array_join(F.array_sort("cart_items")["name"], ", ")
    return picked.select("user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase",
                         "campaign_name", "impression", "click",
                         F.when(F.size("cart_items") > 0, cart).alias("cart_products"))


def campaign_uplift(summary: DataFrame) -> DataFrame:
    """Visit metrics per campaign split by whether the visit had an ad
    impression and an ad click -> campaign_name, received_impression,
    clicked, visits, purchase_rate, avg_page_views, avg_cart_adds."""
    return (summary.groupBy("campaign_name",
                            (F.col("impression") > 0).alias("received_impression"),
                            (F.col("click") > 0).alias("clicked"))
            .agg(F.count(F.lit(1)).alias("visits"),
                 pct(F.sum("purchase"), F.count(F.lit(1)), 2).alias("purchase_rate"),
                 ratio(F.sum("page_views"), F.count(F.lit(1)), 2).alias("avg_page_views"),
                 ratio(F.sum("cart_adds"), F.count(F.lit(1)), 2).alias("avg_cart_adds")))
