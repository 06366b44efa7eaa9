"""Registered weekly-sales queries (CS5)."""

from __future__ import annotations

from tidewater.operators import weekly_sales as op
from tidewater.plans.registry import query
from tidewater.plans.sqlfrag import rdiv, rpct

PIVOT = "2020-06-15"
TABLES = ("weekly_sales",)

_CLEAN = """
WITH parsed AS (
  SELECT CAST(try_strptime(week_date, '%d/%m/%y') AS DATE) AS d, region, platform,
    CASE WHEN segment IS NULL OR segment = 'null' THEN 'unknown' ELSE segment END AS seg,
    customer_type, transactions, sales
  FROM weekly_sales),
clean AS (
  SELECT d AS week_date, CAST(weekofyear(d) AS INTEGER) AS week_number, CAST(month(d) AS INTEGER) AS month_number,
    CAST(year(d) AS INTEGER) AS calendar_year, region, platform, seg AS segment,
    CASE WHEN right(seg, 1) = '1' THEN 'Young Adults' WHEN right(seg, 1) = '2' THEN 'Middle Aged'
      WHEN right(seg, 1) IN ('3', '4') THEN 'Retirees' ELSE 'unknown' END AS age_band,
    CASE WHEN left(seg, 1) = 'C' THEN 'Couples' WHEN left(seg, 1) = 'F' THEN 'Families' ELSE 'unknown' END
      AS demographic,
    customer_type, transactions, """ + rdiv("sales", "transactions") + """ AS avg_transaction, sales
  FROM parsed)
"""


def _clean(fx):
    return fx.shared_result("clean-weekly-sales", lambda: op.clean_weekly_sales(fx.weekly_sales),
                            "lineitem", "part", "supplier", "nation", "region")


@query("clean_weekly_sales", TABLES, _CLEAN + "SELECT * FROM clean")
def clean_weekly_sales(fx):
    return _clean(fx)


@query("weekday_used", TABLES, _CLEAN + "SELECT DISTINCT lower(dayname(week_date)) AS week_day FROM clean")
def weekday_used(fx):
    return op.weekday_used(_clean(fx))


@query("missing_weeks", TABLES, _CLEAN + """,
weeks AS (SELECT CAST(range AS INTEGER) AS week_number FROM range(1, 53))
SELECT w.week_number FROM weeks w
WHERE NOT EXISTS (SELECT 1 FROM clean c WHERE c.week_number = w.week_number)""")
def missing_weeks(fx):
    return op.missing_weeks(_clean(fx))


@query("transactions_by_year", TABLES, _CLEAN + """
SELECT calendar_year, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM clean GROUP BY calendar_year""")
def transactions_by_year(fx):
    return op.transactions_by_year(_clean(fx))


@query("sales_by_region_month", TABLES, _CLEAN + """
SELECT region, month_number, CAST(sum(sales) AS BIGINT) AS total_sales FROM clean GROUP BY region, month_number""")
def sales_by_region_month(fx):
    return op.sales_by_region_month(_clean(fx))


@query("transactions_by_platform", TABLES, _CLEAN + """
SELECT platform, CAST(sum(transactions) AS BIGINT) AS total_transactions FROM clean GROUP BY platform""")
def transactions_by_platform(fx):
    return op.transactions_by_platform(_clean(fx))


@query("platform_share_by_month", TABLES, _CLEAN + f"""
SELECT calendar_year, month_number,
  {rpct("sum(CASE WHEN platform = 'Retail' THEN sales ELSE 0 END)", "sum(sales)")} AS retail_percentage,
  {rpct("sum(CASE WHEN platform = 'Shopify' THEN sales ELSE 0 END)", "sum(sales)")} AS shopify_percentage
FROM clean GROUP BY calendar_year, month_number""")
def platform_share_by_month(fx):
    return op.platform_share_by_month(_clean(fx))


@query("demographic_share_by_year", TABLES, _CLEAN + f"""
SELECT calendar_year,
  {rpct("sum(CASE WHEN demographic = 'Couples' THEN sales ELSE 0 END)", "sum(sales)")} AS couples_percentage,
  {rpct("sum(CASE WHEN demographic = 'Families' THEN sales ELSE 0 END)", "sum(sales)")} AS families_percentage,
  {rpct("sum(CASE WHEN demographic = 'unknown' THEN sales ELSE 0 END)", "sum(sales)")} AS unknown_percentage
FROM clean GROUP BY calendar_year""")
def demographic_share_by_year(fx):
    return op.demographic_share_by_year(_clean(fx))


@query("top_retail_segment", TABLES, _CLEAN + """
SELECT age_band, demographic, CAST(sum(sales) AS BIGINT) AS sales
FROM clean WHERE platform = 'Retail' GROUP BY age_band, demographic
ORDER BY sales DESC, age_band, demographic LIMIT 1""")
def top_retail_segment(fx):
    return op.top_retail_segment(_clean(fx))


@query("avg_transaction_by_year_platform", TABLES, _CLEAN + f"""
SELECT calendar_year, platform, {rdiv("sum(sales)", "sum(transactions)")} AS avg_transaction
FROM clean GROUP BY calendar_year, platform""")
def avg_transaction_by_year_platform(fx):
    return op.avg_transaction_by_year_platform(_clean(fx))


@query("week_of_date", TABLES, _CLEAN + f"""
SELECT DISTINCT week_number FROM clean WHERE week_date = DATE '{PIVOT}' AND calendar_year = year(DATE '{PIVOT}')""")
def week_of_date(fx):
    return op.week_of_date(_clean(fx), PIVOT)


def _before_after_sql(weeks: int) -> str:
    return _CLEAN + f""",
changes AS (
  SELECT sum(CASE WHEN week_date < DATE '{PIVOT}' THEN sales END) AS before_sales,
    sum(CASE WHEN week_date >= DATE '{PIVOT}' THEN sales END) AS after_sales
  FROM clean
  WHERE week_date >= DATE '{PIVOT}' - INTERVAL {7 * weeks} DAY AND week_date < DATE '{PIVOT}' + INTERVAL {7 * weeks} DAY)
SELECT CAST(after_sales - before_sales AS BIGINT) AS sales_variance,
  {rpct("after_sales - before_sales", "before_sales")} AS variance_percentage
FROM changes"""


def _before_after_by_year_sql(weeks: int) -> str:
    return _CLEAN + f""",
pw AS (SELECT weekofyear(DATE '{PIVOT}') AS w),
changes AS (
  SELECT calendar_year,
    sum(CASE WHEN week_number < pw.w THEN sales END) AS before_sales,
    sum(CASE WHEN week_number >= pw.w THEN sales END) AS after_sales
  FROM clean, pw
  WHERE week_number >= pw.w - {weeks} AND week_number < pw.w + {weeks}
  GROUP BY calendar_year)
SELECT calendar_year, CAST(after_sales - before_sales AS BIGINT) AS sales_variance,
  {rpct("after_sales - before_sales", "before_sales")} AS variance_percentage
FROM changes"""


@query("before_after_4w", TABLES, _before_after_sql(4))
def before_after_4w(fx):
    return op.before_after(_clean(fx), PIVOT, 4)


@query("before_after_12w", TABLES, _before_after_sql(12))
def before_after_12w(fx):
    return op.before_after(_clean(fx), PIVOT, 12)


@query("before_after_4w_by_year", TABLES, _before_after_by_year_sql(4))
def before_after_4w_by_year(fx):
    return op.before_after_by_year(_clean(fx), PIVOT, 4)


@query("before_after_12w_by_year", TABLES, _before_after_by_year_sql(12))
def before_after_12w_by_year(fx):
    return op.before_after_by_year(_clean(fx), PIVOT, 12)


def _area_sql(area: str) -> str:
    return f"""
SELECT '{area}' AS area, {area} AS area_value,
  sum(CASE WHEN week_date < DATE '{PIVOT}' THEN sales END) AS before_sales,
  sum(CASE WHEN week_date >= DATE '{PIVOT}' THEN sales END) AS after_sales
FROM clean
WHERE week_date >= DATE '{PIVOT}' - INTERVAL 84 DAY AND week_date < DATE '{PIVOT}' + INTERVAL 84 DAY
GROUP BY {area}"""


@query("business_area_impact", TABLES, _CLEAN + ", areas AS (" + " UNION ALL ".join(
    _area_sql(a) for a in op.AREAS) + f""")
SELECT area, area_value, CAST(before_sales AS BIGINT) AS before_sales, CAST(after_sales AS BIGINT) AS after_sales,
  CAST(after_sales - before_sales AS BIGINT) AS sales_variance,
  {rpct("after_sales - before_sales", "before_sales")} AS variance_percentage
FROM areas""")
def business_area_impact(fx):
    return op.business_area_impact(_clean(fx), PIVOT, 12)
