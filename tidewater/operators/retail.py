"""Retail product mix and baskets over sales(prod_id, qty, price, discount,
member, txn_id, start_txn_time) and product_details(product_id,
product_name, category_id, segment_id, category_name, segment_name).

Revenue is price * qty and discount is price * qty * discount / 100 (the
reference multiplies SUM(price) by SUM(qty) in places; see SURVEY D30/D31).

Plan shape: sales are reduced to one row per product (map-side partial
aggregate) before the join with product details, so the join and every
roll-up to segment or category work on product-level rows.  Shares join a
roll-up (one row per segment / category / the grand total) instead of a
window over a possibly huge segment.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.common import grand, pct, ratio, rounded, top_k, top_per_group
from tidewater.functions.hierarchy import flatten_hierarchy
from tidewater.functions.itemsets import top_triples


def revenue_expr(sales: DataFrame) -> Column:
    """Revenue of a row of order lines, or of sales already summed (``basket_lines``)."""
    return F.col("revenue") if "revenue" in sales.columns else F.col("price") * F.col("qty")


def discount_expr(sales: DataFrame) -> Column:
    if "discount_amt" in sales.columns:
        return F.col("discount_amt")
    return F.col("price") * F.col("qty") * F.col("discount") * F.lit(Decimal("0.01"))


def basket_lines(sales: DataFrame) -> DataFrame:
    """Sales reduced to one row per transaction and product, with everything the reports
    need: quantity, revenue, discount, and whether the product was bought (a line with a
    positive quantity).  The functions of this module take it in place of sales."""
    return sales.groupBy("member", "txn_id", "prod_id").agg(
        F.sum("qty").alias("qty"), F.sum(revenue_expr(sales)).alias("revenue"), F.sum(discount_expr(sales)).alias("discount_amt"),
        F.max(F.col("qty") > 0).alias("bought"))


def product_totals(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    """One row per product: quantity, revenue and discount, with its details."""
    per = sales.groupBy("prod_id").agg(F.sum("qty").alias("total_quantity"),
                                       F.sum(revenue_expr(sales)).alias("revenue"),
                                       F.sum(discount_expr(sales)).alias("discount_amt"))
    return per.join(product_details, per.prod_id == product_details.product_id).drop("prod_id")


def qty_by_product(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    return product_totals(sales, product_details).select("product_name", "total_quantity")


def revenue_by_product(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    return product_totals(sales, product_details).select("product_name", rounded("revenue").alias("revenues"))


def discount_by_product(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    return product_totals(sales, product_details).select(
        "product_name", rounded("discount_amt").alias("total_discount"))


def unique_transactions(sales: DataFrame) -> DataFrame:
    return sales.agg(F.count_distinct("txn_id").alias("unique_transactions"))


def _baskets(sales: DataFrame) -> DataFrame:
    """Distinct (txn, product) pairs with a positive quantity."""
    bought = F.col("bought") if "bought" in sales.columns else F.col("qty") > 0
    return sales.filter(bought).select("txn_id", "prod_id").distinct()


def avg_unique_products_per_txn(sales: DataFrame) -> DataFrame:
    """Average number of distinct products per transaction (whole number)."""
    per = _baskets(sales).groupBy("txn_id").agg(F.count("prod_id").alias("n"))
    return per.agg(ratio(F.sum("n"), F.count("n"), 0).alias("avg_unique_products"))


def txn_revenue(sales: DataFrame) -> DataFrame:
    return sales.groupBy("member", "txn_id").agg(F.sum(revenue_expr(sales)).alias("revenue"))


def revenue_percentiles(sales: DataFrame, percentiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Interpolated percentiles of revenue per transaction."""
    from tidewater.functions.percentile import exact_percentiles
    per = txn_revenue(sales).select(F.col("revenue").cast("double").alias("revenue"))
    names = ["median_25th", "median_50th", "median_75th"]
    return exact_percentiles(per, "revenue", list(percentiles), names, scale=4)


def avg_discount_per_txn(sales: DataFrame) -> DataFrame:
    return sales.agg(ratio(F.sum(discount_expr(sales)), F.count_distinct("txn_id")).alias("avg_discount_per_transaction"))


def member_txn_split(sales: DataFrame) -> DataFrame:
    per = sales.groupBy("member").agg(F.count_distinct("txn_id").alias("transactions"))
    return per.select("member", "transactions",
                      pct(F.col("transactions"), grand(per, F.sum("transactions")), 2).alias("percentage"))


def member_avg_revenue(sales: DataFrame) -> DataFrame:
    per = txn_revenue(sales)
    return per.groupBy("member").agg(ratio(F.sum("revenue"), F.count("revenue")).alias("avg_revenue"))


def top_products_by_revenue(sales: DataFrame, product_details: DataFrame, k: int = 3) -> DataFrame:
    totals = product_totals(sales, product_details)
    return top_k(totals, k, [F.desc("revenue"), F.asc("product_id")]) \
        .select("product_name", rounded("revenue").alias("total_revenue"))


def _level_totals(totals: DataFrame, keys: list[str]) -> DataFrame:
    return totals.groupBy(*keys).agg(F.sum("total_quantity").alias("total_quantity"),
                                     rounded(F.sum("revenue")).alias("total_revenue"),
                                     rounded(F.sum("discount_amt")).alias("total_discount"))


def segment_totals(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    return _level_totals(product_totals(sales, product_details), ["segment_id", "segment_name"])


def category_totals(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    return _level_totals(product_totals(sales, product_details), ["category_id", "category_name"])


def top_product_per_level(sales: DataFrame, product_details: DataFrame, level: str,
                          kind: str = "dense_rank") -> DataFrame:
    """Top-selling product(s) by quantity per segment or category (ties kept).

    ``kind='dense_rank'`` -> <level>_name, product_name;
    ``kind='rank'`` -> ids, names and total_quantity.
    """
    totals = product_totals(sales, product_details)
    top = top_per_group(totals, [f"{level}_id"], [F.desc("total_quantity")], 1, kind)
    if kind == "dense_rank":
        return top.select(f"{level}_name", "product_name")
    return top.select(f"{level}_id", f"{level}_name", "product_id", "product_name", "total_quantity")


def _share_of_parent(child: DataFrame, parent_keys: list[str], value: str, out: str,
                     select: list[str]) -> DataFrame:
    parent = child.groupBy(*parent_keys).agg(F.sum(value).alias("_parent_total"))
    return child.join(parent, parent_keys).select(*select, pct(F.col(value), F.col("_parent_total"), 2).alias(out))


def revenue_share_product_in_segment(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    totals = product_totals(sales, product_details)
    return _share_of_parent(totals, ["segment_id"], "revenue", "revenue_percentage",
                            ["segment_name", "product_name"])


def revenue_share_segment_in_category(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    seg = (product_totals(sales, product_details)
           .groupBy("category_id", "category_name", "segment_id", "segment_name")
           .agg(F.sum("revenue").alias("revenue")))
    return _share_of_parent(seg, ["category_id"], "revenue", "revenue_percentage",
                            ["category_name", "segment_name"])


def revenue_share_by_category(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    cat = (product_totals(sales, product_details).groupBy("category_name")
           .agg(F.sum("revenue").alias("revenue")))
    return cat.select("category_name", pct(F.col("revenue"), grand(cat, F.sum("revenue")), 2)
                      .alias("revenue_percentage"))


def product_penetration(sales: DataFrame, product_details: DataFrame) -> DataFrame:
    """Share of all transactions that contain the product (percent)."""
    per = _baskets(sales).groupBy("prod_id").agg(F.count("txn_id").alias("n"))
    n_txn = grand(sales, F.count_distinct("txn_id"))
    return (per.join(product_details, per.prod_id == product_details.product_id)
            .select("product_id", "product_name", pct(F.col("n"), n_txn, 2).alias("penetration_percentage")))


def top_product_triple(sales: DataFrame, product_details: DataFrame, k: int = 1) -> DataFrame:
    """Most common product combination among baskets of exactly three
    distinct products -> product_id_1..3, product_name_1..3, combination_count.

    A basket's three products are recovered as (min, sum - min - max, max)
    of its distinct product ids, so no basket is collected and no
    combinations are generated within a basket.
    """
    per = _baskets(sales).groupBy("txn_id").agg(
        F.count("prod_id").alias("n"), F.min("prod_id").alias("a"), F.max("prod_id").alias("c"),
        F.sum("prod_id").alias("s"))
    triples = per.filter(F.col("n") == 3).select(
        F.col("a").alias("product_id_1"), (F.col("s") - F.col("a") - F.col("c")).alias("product_id_2"),
        F.col("c").alias("product_id_3"))
    counts = triples.groupBy(*TRIPLE).agg(F.count(F.lit(1)).alias("combination_count"))
    return _named_triples(top_k(counts, k, [F.desc("combination_count"), *[F.asc(i) for i in TRIPLE]]), product_details)


TRIPLE = ["product_id_1", "product_id_2", "product_id_3"]


def top_product_triple_any(sales: DataFrame, product_details: DataFrame, k: int = 1) -> DataFrame:
    """The k combinations of any three products that most baskets hold, whatever
    else is in them -> as ``top_product_triple``.  Exact; see ``functions.itemsets``."""
    top = top_triples(_baskets(sales), "txn_id", "prod_id", k)
    return _named_triples(top.select(*[F.col(x).alias(i) for x, i in zip("abc", TRIPLE)], F.col("n").alias("combination_count")), product_details)


def _named_triples(top: DataFrame, product_details: DataFrame) -> DataFrame:
    """Product names for the (at most 3k) ids of the top rows: those ids are
    broadcast and product_details streams once through a hash join."""
    slots = top.select(*TRIPLE, F.explode(F.array(*[
        F.struct(F.lit(n).alias("slot"), F.col(i).alias("product_id")) for n, i in enumerate(TRIPLE, 1)])).alias("s"))
    slots = slots.select(*TRIPLE, "s.slot", "s.product_id")
    named = (product_details.select("product_id", "product_name").join(F.broadcast(slots), "product_id")
             .groupBy(*TRIPLE).agg(*[F.max(F.when(F.col("slot") == n, F.col("product_name"))).alias(f"product_name_{n}")
                                     for n in (1, 2, 3)]))
    return top.join(named, TRIPLE, "left").select(*TRIPLE, "product_name_1", "product_name_2", "product_name_3",
                                                  "combination_count")


def sales_of_month(sales: DataFrame, month: str) -> DataFrame:
    """The sales of one calendar month (``month`` = 'YYYY-MM')."""
    start = F.lit(f"{month}-01").cast("date")
    return sales.filter((F.col("start_txn_time") >= start) & (F.col("start_txn_time") < F.add_months(start, 1)))


def monthly_report(lines: DataFrame, product_details: DataFrame) -> dict[str, DataFrame]:
    """Every retail answer for the sales ``lines`` of a month.

    Pass ``basket_lines(sales_of_month(sales, month))`` kept as a result table: the sales are
    then scanned once for the whole report, and each table derives from the kept rows.
    """
    return {
        "kpis": monthly_kpis(lines),
        "qty_by_product": qty_by_product(lines, product_details),
        "revenue_by_product": revenue_by_product(lines, product_details),
        "discount_by_product": discount_by_product(lines, product_details),
        "member_txn_split": member_txn_split(lines),
        "member_avg_revenue": member_avg_revenue(lines),
        "top_products_by_revenue": top_products_by_revenue(lines, product_details),
        "segment_totals": segment_totals(lines, product_details),
        "category_totals": category_totals(lines, product_details),
        "top_product_per_segment": top_product_per_level(lines, product_details, "segment"),
        "top_product_per_category": top_product_per_level(lines, product_details, "category"),
        "revenue_share_product_in_segment": revenue_share_product_in_segment(lines, product_details),
        "revenue_share_segment_in_category": revenue_share_segment_in_category(lines, product_details),
        "revenue_share_by_category": revenue_share_by_category(lines, product_details),
        "product_penetration": product_penetration(lines, product_details),
        "top_product_triple": top_product_triple(lines, product_details),
        "avg_unique_products_per_txn": avg_unique_products_per_txn(lines),
        "revenue_percentiles": revenue_percentiles(lines),
    }


def monthly_kpis(lines: DataFrame) -> DataFrame:
    """High-level numbers of one month in one row."""
    return lines.agg(
        F.sum("qty").alias("total_quantity"),
        rounded(F.sum(revenue_expr(lines))).alias("total_revenue"),
        rounded(F.sum(discount_expr(lines))).alias("total_discount"),
        F.count_distinct("txn_id").alias("unique_transactions"),
        ratio(F.sum(discount_expr(lines)), F.count_distinct("txn_id")).alias("avg_discount_per_transaction"))


def hierarchy_paths(nodes: DataFrame, label_col: str, separator: str = " > ") -> DataFrame:
    """Every node of a hierarchy of any depth with its root, depth, status ('ok', 'orphan',
    'cycle') and the text of its path -> id, parent_id, root_id, depth, status, path."""
    flat = flatten_hierarchy(nodes, "id", "parent_id", label_col)
    return flat.select("id", "parent_id", "root_id", "depth", "status", F.array_join("labels", separator).alias("path"))


def product_details_from_hierarchy(product_hierarchy: DataFrame, product_prices: DataFrame) -> DataFrame:
    """Flatten category > segment > style (two parent joins) and attach prices."""
    h = product_hierarchy
    style = h.filter(F.col("level_name") == "Style").select(
        F.col("id").alias("style_id"), F.col("parent_id").alias("segment_id"), F.col("level_text").alias("style_name"))
    seg = h.filter(F.col("level_name") == "Segment").select(
        F.col("id").alias("segment_id"), F.col("parent_id").alias("category_id"),
        F.col("level_text").alias("segment_name"))
    cat = h.filter(F.col("level_name") == "Category").select(
        F.col("id").alias("category_id"), F.col("level_text").alias("category_name"))
    flat = style.join(seg, "segment_id").join(cat, "category_id")
    prices = product_prices.select(F.col("product_id"), F.col("id").alias("price_id"), "price")
    return (flat.join(prices, flat.style_id == prices.product_id)
            .select(F.col("price_id").alias("product_id"), rounded("price").alias("price"),
                    F.concat_ws(" ", "style_name", "segment_name", F.lit("-"), "category_name").alias("product_name"),
                    "category_id", "segment_id", "style_id", "category_name", "segment_name", "style_name"))
