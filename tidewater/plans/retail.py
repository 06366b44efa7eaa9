"""Registered retail product-mix and basket queries (CS7 and its stated-only tasks)."""

from __future__ import annotations

import re

from tidewater.operators import retail as op
from tidewater.plans.registry import REGISTRY, query
from tidewater.plans.sqlfrag import rdiv, rpct

T = ("retail_sales", "product_details")
REPORT_MONTH = "1998-01"

_PT = """
WITH per AS (
  SELECT prod_id, sum(qty) AS total_quantity, sum(price * qty) AS revenue,
    sum(price * qty * discount * 0.01) AS discount_amt
  FROM retail_sales GROUP BY prod_id),
pt AS (SELECT pd.*, per.total_quantity, per.revenue, per.discount_amt
       FROM per JOIN product_details pd ON per.prod_id = pd.product_id)
"""


@query("qty_by_product", T, _PT + "SELECT product_name, CAST(total_quantity AS BIGINT) AS total_quantity FROM pt")
def qty_by_product(fx):
    return op.qty_by_product(fx.retail_sales, fx.product_details)


@query("revenue_by_product", T, _PT + "SELECT product_name, CAST(revenue AS DOUBLE) AS revenues FROM pt")
def revenue_by_product(fx):
    return op.revenue_by_product(fx.retail_sales, fx.product_details)


@query("discount_by_product", T, _PT + "SELECT product_name, CAST(round(discount_amt, 2) AS DOUBLE) AS total_discount FROM pt")
def discount_by_product(fx):
    return op.discount_by_product(fx.retail_sales, fx.product_details)


@query("unique_transactions", ("retail_sales",),
       "SELECT count(DISTINCT txn_id) AS unique_transactions FROM retail_sales")
def unique_transactions(fx):
    return op.unique_transactions(fx.retail_sales)


@query("avg_unique_products_per_txn", ("retail_sales",), f"""
WITH per AS (SELECT txn_id, count(DISTINCT prod_id) AS n FROM retail_sales WHERE qty > 0 GROUP BY txn_id)
SELECT {rdiv("sum(n)", "count(n)", 0)} AS avg_unique_products FROM per""")
def avg_unique_products_per_txn(fx):
    return op.avg_unique_products_per_txn(fx.retail_sales)


@query("revenue_percentiles", ("retail_sales",), """
WITH per AS (SELECT txn_id, CAST(sum(price * qty) AS DOUBLE) AS revenue FROM retail_sales GROUP BY member, txn_id)
SELECT round(quantile_cont(revenue, 0.25), 4) AS median_25th, round(quantile_cont(revenue, 0.5), 4) AS median_50th,
  round(quantile_cont(revenue, 0.75), 4) AS median_75th
FROM per""")
def revenue_percentiles(fx):
    return op.revenue_percentiles(fx.retail_sales)


@query("avg_discount_per_txn", ("retail_sales",), f"""
SELECT {rdiv("sum(price * qty * discount * 0.01)", "count(DISTINCT txn_id)", 2, 4, 0)} AS avg_discount_per_transaction
FROM retail_sales""")
def avg_discount_per_txn(fx):
    return op.avg_discount_per_txn(fx.retail_sales)


@query("member_txn_split", ("retail_sales",), f"""
WITH t AS (SELECT member, count(DISTINCT txn_id) AS transactions FROM retail_sales GROUP BY member)
SELECT member, transactions, {rpct("transactions", "(SELECT sum(transactions) FROM t)")} AS percentage FROM t""")
def member_txn_split(fx):
    return op.member_txn_split(fx.retail_sales)


@query("member_avg_revenue", ("retail_sales",), f"""
WITH per AS (SELECT member, txn_id, sum(price * qty) AS revenue FROM retail_sales GROUP BY member, txn_id)
SELECT member, {rdiv("sum(revenue)", "count(revenue)", 2, 2, 0)} AS avg_revenue FROM per GROUP BY member""")
def member_avg_revenue(fx):
    return op.member_avg_revenue(fx.retail_sales)


@query("top_products_by_revenue", T, _PT + """
SELECT product_name, CAST(revenue AS DOUBLE) AS total_revenue FROM pt ORDER BY revenue DESC, product_id LIMIT 3""")
def top_products_by_revenue(fx):
    return op.top_products_by_revenue(fx.retail_sales, fx.product_details)


def _level_sql(level: str) -> str:
    return _PT + f"""
SELECT {level}_id, {level}_name, CAST(sum(total_quantity) AS BIGINT) AS total_quantity,
  CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(round(sum(discount_amt), 2) AS DOUBLE) AS total_discount
FROM pt GROUP BY {level}_id, {level}_name"""


@query("segment_totals", T, _level_sql("segment"))
def segment_totals(fx):
    return op.segment_totals(fx.retail_sales, fx.product_details)


@query("category_totals", T, _level_sql("category"))
def category_totals(fx):
    return op.category_totals(fx.retail_sales, fx.product_details)


def _top_sql(level: str, kind: str) -> str:
    if kind == "dense_rank":
        cols = f"{level}_name, product_name"
    else:
        cols = f"{level}_id, {level}_name, product_id, product_name, CAST(total_quantity AS BIGINT) AS total_quantity"
    return _PT + f""",
ranked AS (SELECT *, {kind}() OVER (PARTITION BY {level}_id ORDER BY total_quantity DESC) AS rnk FROM pt)
SELECT {cols} FROM ranked WHERE rnk = 1"""


@query("top_product_per_segment", T, _top_sql("segment", "dense_rank"))
def top_product_per_segment(fx):
    return op.top_product_per_level(fx.retail_sales, fx.product_details, "segment", "dense_rank")


@query("top_product_per_segment_alt", T, _top_sql("segment", "rank"))
def top_product_per_segment_alt(fx):
    return op.top_product_per_level(fx.retail_sales, fx.product_details, "segment", "rank")


@query("top_product_per_category", T, _top_sql("category", "dense_rank"))
def top_product_per_category(fx):
    return op.top_product_per_level(fx.retail_sales, fx.product_details, "category", "dense_rank")


@query("top_product_per_category_alt", T, _top_sql("category", "rank"))
def top_product_per_category_alt(fx):
    return op.top_product_per_level(fx.retail_sales, fx.product_details, "category", "rank")


@query("revenue_share_product_in_segment", T, _PT + f""",
seg AS (SELECT segment_id, sum(revenue) AS seg_revenue FROM pt GROUP BY segment_id)
SELECT pt.segment_name, pt.product_name, {rpct("pt.revenue", "seg.seg_revenue", 2, 2, 2)} AS revenue_percentage
FROM pt JOIN seg ON pt.segment_id = seg.segment_id""")
def revenue_share_product_in_segment(fx):
    return op.revenue_share_product_in_segment(fx.retail_sales, fx.product_details)


@query("revenue_share_segment_in_category", T, _PT + f""",
seg AS (SELECT category_id, category_name, segment_id, segment_name, sum(revenue) AS revenue
        FROM pt GROUP BY category_id, category_name, segment_id, segment_name),
cat AS (SELECT category_id, sum(revenue) AS cat_revenue FROM seg GROUP BY category_id)
SELECT seg.category_name, seg.segment_name, {rpct("seg.revenue", "cat.cat_revenue", 2, 2, 2)} AS revenue_percentage
FROM seg JOIN cat ON seg.category_id = cat.category_id""")
def revenue_share_segment_in_category(fx):
    return op.revenue_share_segment_in_category(fx.retail_sales, fx.product_details)


@query("revenue_share_by_category", T, _PT + f""",
cat AS (SELECT category_name, sum(revenue) AS revenue FROM pt GROUP BY category_name)
SELECT category_name, {rpct("revenue", "(SELECT sum(revenue) FROM cat)", 2, 2, 2)} AS revenue_percentage FROM cat""")
def revenue_share_by_category(fx):
    return op.revenue_share_by_category(fx.retail_sales, fx.product_details)


@query("product_penetration", T, f"""
WITH per AS (SELECT prod_id, count(DISTINCT txn_id) AS n FROM retail_sales WHERE qty > 0 GROUP BY prod_id)
SELECT pd.product_id, pd.product_name,
  {rpct("per.n", "(SELECT count(DISTINCT txn_id) FROM retail_sales)")} AS penetration_percentage
FROM per JOIN product_details pd ON per.prod_id = pd.product_id""")
def product_penetration(fx):
    return op.product_penetration(fx.retail_sales, fx.product_details)


@query("top_product_triple", T, """
WITH baskets AS (SELECT DISTINCT txn_id, prod_id FROM retail_sales WHERE qty > 0),
grouped AS (
  SELECT txn_id, list_sort(list(prod_id)) AS ids FROM baskets GROUP BY txn_id HAVING count(*) = 3),
counted AS (
  SELECT ids[1] AS product_id_1, ids[2] AS product_id_2, ids[3] AS product_id_3, count(*) AS combination_count
  FROM grouped GROUP BY ids),
top AS (SELECT * FROM counted ORDER BY combination_count DESC, product_id_1, product_id_2, product_id_3 LIMIT 1)
SELECT t.product_id_1, t.product_id_2, t.product_id_3,
  a.product_name AS product_name_1, b.product_name AS product_name_2, c.product_name AS product_name_3,
  t.combination_count
FROM top t
LEFT JOIN product_details a ON a.product_id = t.product_id_1
LEFT JOIN product_details b ON b.product_id = t.product_id_2
LEFT JOIN product_details c ON c.product_id = t.product_id_3""")
def top_product_triple(fx):
    return op.top_product_triple(fx.retail_sales, fx.product_details)


@query("top_product_triple_any", T, """
WITH baskets AS (SELECT DISTINCT txn_id, prod_id FROM retail_sales WHERE qty > 0),
counted AS (
  SELECT x.prod_id AS product_id_1, y.prod_id AS product_id_2, z.prod_id AS product_id_3, count(*) AS combination_count
  FROM baskets x JOIN baskets y ON x.txn_id = y.txn_id AND x.prod_id < y.prod_id
  JOIN baskets z ON y.txn_id = z.txn_id AND y.prod_id < z.prod_id
  GROUP BY ALL),
top AS (SELECT * FROM counted ORDER BY combination_count DESC, product_id_1, product_id_2, product_id_3 LIMIT 10)
SELECT t.product_id_1, t.product_id_2, t.product_id_3,
  a.product_name AS product_name_1, b.product_name AS product_name_2, c.product_name AS product_name_3,
  t.combination_count
FROM top t
LEFT JOIN product_details a ON a.product_id = t.product_id_1
LEFT JOIN product_details b ON b.product_id = t.product_id_2
LEFT JOIN product_details c ON c.product_id = t.product_id_3""")
def top_product_triple_any(fx):
    return op.top_product_triple_any(fx.retail_sales, fx.product_details, 10)


@query("monthly_report", ("retail_sales",), f"""
SELECT CAST(sum(qty) AS BIGINT) AS total_quantity, CAST(sum(price * qty) AS DOUBLE) AS total_revenue,
  CAST(round(sum(price * qty * discount * 0.01), 2) AS DOUBLE) AS total_discount,
  count(DISTINCT txn_id) AS unique_transactions,
  {rdiv("sum(price * qty * discount * 0.01)", "count(DISTINCT txn_id)", 2, 4, 0)} AS avg_discount_per_transaction
FROM retail_sales
WHERE start_txn_time >= DATE '{REPORT_MONTH}-01' AND start_txn_time < DATE '{REPORT_MONTH}-01' + INTERVAL 1 MONTH""")
def monthly_report(fx):
    return op.monthly_kpis(_month_lines(fx))


def _month_lines(fx):
    """The month's sales by transaction and product, which all tables of the report share."""
    return fx.shared_result(f"sales-{REPORT_MONTH}", lambda: op.basket_lines(op.sales_of_month(fx.retail_sales, REPORT_MONTH)),
                            "lineitem", "orders", "part")


@query("product_details_from_hierarchy", ("product_hierarchy", "product_prices"), """
WITH style AS (SELECT id AS style_id, parent_id AS segment_id, level_text AS style_name
               FROM product_hierarchy WHERE level_name = 'Style'),
seg AS (SELECT id AS segment_id, parent_id AS category_id, level_text AS segment_name
        FROM product_hierarchy WHERE level_name = 'Segment'),
cat AS (SELECT id AS category_id, level_text AS category_name FROM product_hierarchy WHERE level_name = 'Category')
SELECT pp.id AS product_id, CAST(pp.price AS DOUBLE) AS price,
  style.style_name || ' ' || seg.segment_name || ' - ' || cat.category_name AS product_name,
  cat.category_id, seg.segment_id, style.style_id, cat.category_name, seg.segment_name, style.style_name
FROM style JOIN seg ON style.segment_id = seg.segment_id JOIN cat ON seg.category_id = cat.category_id
JOIN product_prices pp ON style.style_id = pp.product_id""")
def product_details_from_hierarchy(fx):
    return op.product_details_from_hierarchy(fx.product_hierarchy, fx.product_prices)


def _tree_sql(table: str, label: str) -> str:
    return f"""
WITH RECURSIVE walk AS (
  SELECT id, id AS root_id, CAST(0 AS BIGINT) AS depth, CASE WHEN parent_id IS NULL THEN 'ok' ELSE 'orphan' END AS status,
    {label} AS path
  FROM {table} WHERE parent_id IS NULL OR parent_id NOT IN (SELECT id FROM {table})
  UNION ALL
  SELECT c.id, w.root_id, w.depth + 1, w.status, w.path || ' > ' || c.{label}
  FROM walk w JOIN {table} c ON c.parent_id = w.id)
SELECT t.id, t.parent_id, w.root_id, w.depth, coalesce(w.status, 'cycle') AS status, w.path
FROM {table} t LEFT JOIN walk w ON t.id = w.id"""


@query("product_hierarchy_paths", ("product_hierarchy",), _tree_sql("product_hierarchy", "level_text"))
def product_hierarchy_paths(fx):
    return op.hierarchy_paths(fx.product_hierarchy, "level_text")


@query("part_tree_paths", ("part_tree",), _tree_sql("part_tree", "name"))
def part_tree_paths(fx):
    return op.hierarchy_paths(fx.part_tree, "name")


# ----------------------------------------------------------------------------- the other tables of the monthly report
_MONTH_SALES = (f"(SELECT * FROM retail_sales WHERE start_txn_time >= DATE '{REPORT_MONTH}-01' "
                f"AND start_txn_time < DATE '{REPORT_MONTH}-01' + INTERVAL 1 MONTH)")
REPORT_TABLES = ("qty_by_product", "revenue_by_product", "discount_by_product", "member_txn_split", "member_avg_revenue",
                 "top_products_by_revenue", "segment_totals", "category_totals", "top_product_per_segment",
                 "top_product_per_category", "revenue_share_product_in_segment", "revenue_share_segment_in_category",
                 "revenue_share_by_category", "product_penetration", "top_product_triple",
                 "avg_unique_products_per_txn", "revenue_percentiles")


def _report_table(name: str) -> None:
    sql = re.sub(r"\bretail_sales\b", _MONTH_SALES, REGISTRY[name].sql)

    @query(f"monthly_{name}", T, sql)
    def table(fx):
        return op.monthly_report(_month_lines(fx), fx.product_details)[name]


for _name in REPORT_TABLES:
    _report_table(_name)
