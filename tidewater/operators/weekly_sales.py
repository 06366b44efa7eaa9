"""Weekly sales cleaning, exploration and before/after comparison over
weekly_sales(week_date 'D/M/YY' text, region, platform, segment,
customer_type, transactions, sales).

The before/after operator works on dates: the pivot date splits a window
of ``weeks`` weeks on each side, so no week number has to be looked up by
hand; the by-year form compares the same ISO weeks across years.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.common import pct, ratio, top_k

AREAS = ("region", "platform", "age_band", "demographic", "customer_type")


def clean_weekly_sales(weekly_sales: DataFrame, week: str = "iso") -> DataFrame:
    """Typed weekly sales with week/month/year numbers, age band and demographic.

    ``week='iso'`` numbers weeks as ISO weeks (2020-06-15 is week 25);
    ``'jan1'`` counts 7-day periods from 1 January.  The text 'null' in
    segment becomes 'unknown'.  Unparsable dates become NULL.  Two-digit
    years 70 to 99 lie in the last century, 00 to 69 in this one.
    """
    d = F.try_to_date(F.col("week_date"), "d/M/yy")
    d = F.when(F.year(d) >= 2070, F.make_date(F.year(d) - 100, F.month(d), F.day(d))).otherwise(d)
    if week == "iso":
        wk = F.weekofyear(d)
    else:
        wk = (F.floor((F.dayofyear(d) - 1) / 7) + 1).cast("int")
    seg = F.when(F.col("segment").isNull() | (F.col("segment") == "null"), F.lit("unknown")) \
        .otherwise(F.col("segment"))
    last, first = F.right(seg, F.lit(1)), F.left(seg, F.lit(1))
    age_band = (F.when(last == "1", "Young Adults").when(last == "2", "Middle Aged")
                .when(last.isin("3", "4"), "Retirees").otherwise("unknown"))
    demographic = (F.when(first == "C", "Couples").when(first == "F", "Families").otherwise("unknown"))
    return weekly_sales.select(
        d.alias("week_date"), wk.alias("week_number"), F.month(d).alias("month_number"),
        F.year(d).alias("calendar_year"), "region", "platform", seg.alias("segment"),
        age_band.alias("age_band"), demographic.alias("demographic"), "customer_type",
        "transactions", ratio(F.col("sales"), F.col("transactions")).alias("avg_transaction"), "sales")


def weekday_used(clean: DataFrame) -> DataFrame:
    return clean.select(F.lower(F.date_format("week_date", "EEEE")).alias("week_day")).distinct()


def missing_weeks(clean: DataFrame, weeks_in_year: int = 52) -> DataFrame:
    """Week numbers 1..52 that never occur (anti join against a generated range)."""
    spark = clean.sparkSession
    all_weeks = spark.range(1, weeks_in_year + 1).select(F.col("id").cast("int").alias("week_number"))
    present = clean.select("week_number").distinct()
    return all_weeks.join(present, "week_number", "left_anti")


def transactions_by_year(clean: DataFrame) -> DataFrame:
    return clean.groupBy("calendar_year").agg(F.sum("transactions").alias("total_transactions"))


def sales_by_region_month(clean: DataFrame) -> DataFrame:
    return clean.groupBy("region", "month_number").agg(F.sum("sales").alias("total_sales"))


def transactions_by_platform(clean: DataFrame) -> DataFrame:
    return clean.groupBy("platform").agg(F.sum("transactions").alias("total_transactions"))


def _shares(clean: DataFrame, keys: Sequence[str], by: str, values: dict[str, str]) -> DataFrame:
    """Share of sales per value of ``by`` within ``keys``, one column per value
    (conditional sums over a single aggregation, no pivot round trip)."""
    aggs = [pct(F.sum(F.when(F.col(by) == v, F.col("sales")).otherwise(0)), F.sum("sales"), 2).alias(name)
            for v, name in values.items()]
    return clean.groupBy(*keys).agg(*aggs)


def platform_share_by_month(clean: DataFrame) -> DataFrame:
    return _shares(clean, ["calendar_year", "month_number"], "platform",
                   {"Retail": "retail_percentage", "Shopify": "shopify_percentage"})


def demographic_share_by_year(clean: DataFrame) -> DataFrame:
    return _shares(clean, ["calendar_year"], "demographic",
                   {"Couples": "couples_percentage", "Families": "families_percentage",
                    "unknown": "unknown_percentage"})


def top_retail_segment(clean: DataFrame, k: int = 1) -> DataFrame:
    retail = clean.filter(F.col("platform") == "Retail")
    totals = retail.groupBy("age_band", "demographic").agg(F.sum("sales").alias("sales"))
    return top_k(totals, k, [F.desc("sales"), F.asc("age_band"), F.asc("demographic")])


def avg_transaction_by_year_platform(clean: DataFrame) -> DataFrame:
    """Average transaction size as total sales / total transactions (the
    reference sums the weekly averages)."""
    return clean.groupBy("calendar_year", "platform").agg(
        ratio(F.sum("sales"), F.sum("transactions")).alias("avg_transaction"))


def week_of_date(clean: DataFrame, date: str) -> DataFrame:
    d = F.lit(date).cast("date")
    return (clean.filter((F.col("week_date") == d) & (F.col("calendar_year") == F.year(d)))
            .select("week_number").distinct())


def _variance(before: Column, after: Column) -> list[Column]:
    return [(after - before).alias("sales_variance"),
            pct(after - before, before, 2).alias("variance_percentage")]


def before_after(clean: DataFrame, pivot: str, weeks: int = 4, by: Sequence[str] = ()) -> DataFrame:
    """Sales in the ``weeks`` weeks before ``pivot`` against the ``weeks`` weeks
    from ``pivot`` on -> [by...], sales_variance, variance_percentage."""
    p = F.lit(pivot).cast("date")
    d = F.col("week_date")
    window = clean.filter((d >= F.date_sub(p, 7 * weeks)) & (d < F.date_add(p, 7 * weeks)))
    before = F.sum(F.when(d < p, F.col("sales")))
    after = F.sum(F.when(d >= p, F.col("sales")))
    agg = window.groupBy(*by).agg(before.alias("before_sales"), after.alias("after_sales"))
    return agg.select(*by, *_variance(F.col("before_sales"), F.col("after_sales")))


def before_after_by_year(clean: DataFrame, pivot: str, weeks: int = 4) -> DataFrame:
    """The same ISO weeks around the pivot's week number, for every year."""
    pw = F.weekofyear(F.lit(pivot).cast("date"))
    wk = F.col("week_number")
    window = clean.filter((wk >= pw - weeks) & (wk < pw + weeks))
    before = F.sum(F.when(wk < pw, F.col("sales")))
    after = F.sum(F.when(wk >= pw, F.col("sales")))
    agg = window.groupBy("calendar_year").agg(before.alias("before_sales"), after.alias("after_sales"))
    return agg.select("calendar_year", *_variance(F.col("before_sales"), F.col("after_sales")))


def business_area_impact(clean: DataFrame, pivot: str, weeks: int = 12,
                         areas: Sequence[str] = AREAS) -> DataFrame:
    """Before/after change for every value of every business area in one
    pass (GROUPING SETS), most negative first -> area, area_value,
    before_sales, after_sales, sales_variance, variance_percentage."""
    p = F.lit(pivot).cast("date")
    d = F.col("week_date")
    window = clean.filter((d >= F.date_sub(p, 7 * weeks)) & (d < F.date_add(p, 7 * weeks)))
    agg = window.groupingSets([[a] for a in areas], *areas).agg(
        F.sum(F.when(d < p, F.col("sales"))).alias("before_sales"),
        F.sum(F.when(d >= p, F.col("sales"))).alias("after_sales"),
        *[F.grouping(a).alias(f"g_{a}") for a in areas])
    area = F.when(F.col(f"g_{areas[0]}") == 0, F.lit(areas[0]))
    value = F.when(F.col(f"g_{areas[0]}") == 0, F.col(areas[0]))
    for a in areas[1:]:
        area = area.when(F.col(f"g_{a}") == 0, F.lit(a))
        value = value.when(F.col(f"g_{a}") == 0, F.col(a))
    impact = agg.select(area.alias("area"), value.alias("area_value"), "before_sales", "after_sales",
                        *_variance(F.col("before_sales"), F.col("after_sales")))
    return impact.orderBy(F.asc_nulls_last("variance_percentage"), "area", "area_value")
