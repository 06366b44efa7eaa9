"""Subscription journeys over plans(plan_id, plan_name, price) and
subscriptions(customer_id, plan_id, start_date).

Journey steps are ordered by start_date with plan_id as tie-break (two
plans can start on one day).  Windows are partitioned by customer, whose
journey is a handful of rows, so no window holds a large group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.common import avg_round, grand, pct

TRIAL, BASIC, PRO_MONTHLY, PRO_ANNUAL, CHURN = 0, 1, 2, 3, 4


def _journey_window() -> Window:
    return Window.partitionBy("customer_id").orderBy("start_date", "plan_id")


def _named(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    return subscriptions.join(plans.select("plan_id", "plan_name"), "plan_id")


def _customers(subscriptions: DataFrame) -> Column:
    return grand(subscriptions, F.count_distinct("customer_id"))


def customer_journey(subscriptions: DataFrame, plans: DataFrame,
                     customers: Sequence[int] | None = None) -> DataFrame:
    """Plans and start dates per customer (optionally for a list of customers)."""
    subs = subscriptions if customers is None else subscriptions.filter(F.col("customer_id").isin(*customers))
    return _named(subs, plans).select("customer_id", "plan_id", "plan_name", "start_date")


def customer_count(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.agg(F.count_distinct("customer_id").alias("num_of_customers"))


def trial_starts_by_month(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    trials = _named(subscriptions, plans).filter(F.col("plan_name") == "trial")
    return (trials.groupBy(F.month("start_date").alias("month_date"),
                           F.date_format("start_date", "MMMM").alias("month_name"))
            .agg(F.count("customer_id").alias("trial_plan_subscriptions")))


def plan_starts_after(subscriptions: DataFrame, plans: DataFrame, cut: str) -> DataFrame:
    """Plan starts on or after ``cut`` per plan."""
    later = _named(subscriptions, plans).filter(F.col("start_date") >= F.lit(cut).cast("date"))
    return later.groupBy("plan_id", "plan_name").agg(F.count("customer_id").alias("num_of_events"))


def churn_rate(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    named = _named(subscriptions, plans)
    churned = F.count_if(F.col("plan_name") == "churn")
    return named.agg(churned.alias("churned_customers"),
                     pct(churned, F.count_distinct("customer_id"), 1).alias("percentage_churned_customer"))


def churn_after_trial(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Customers whose second plan is churn (row_number form), whole percent."""
    steps = _named(subscriptions, plans).withColumn("step", F.row_number().over(_journey_window()))
    churned = steps.filter((F.col("plan_name") == "churn") & (F.col("step") == 2))
    return churned.agg(F.count(F.lit(1)).alias("churned_customers"),
                       pct(F.count(F.lit(1)), _customers(subscriptions), 0).alias("churn_percentage"))


def churn_after_trial_lead(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Same answer with LEAD: trial immediately followed by churn."""
    steps = _named(subscriptions, plans).withColumn(
        "next_plan", F.lead("plan_name").over(_journey_window()))
    churned = steps.filter((F.col("plan_name") == "trial") & (F.col("next_plan") == "churn"))
    return churned.agg(F.count("customer_id").alias("churned_customers"),
                       pct(F.count("customer_id"), _customers(subscriptions), 0).alias("churn_percentage"))


def next_plan_after_trial(subscriptions: DataFrame) -> DataFrame:
    """Plan that follows the trial, by start date -> plan_id, converted_customers, pct."""
    steps = subscriptions.withColumn("next_plan_id", F.lead("plan_id").over(_journey_window()))
    after = steps.filter((F.col("plan_id") == TRIAL) & F.col("next_plan_id").isNotNull())
    return (after.groupBy(F.col("next_plan_id").alias("plan_id"))
            .agg(F.count("customer_id").alias("converted_customers"),
                 pct(F.count("customer_id"), _customers(subscriptions), 1).alias("conversion_percentage")))


def plan_mix_at_date(subscriptions: DataFrame, as_of: str) -> DataFrame:
    """Each customer's current plan on ``as_of`` -> plan_id, customers, percentage."""
    until = subscriptions.filter(F.col("start_date") <= F.lit(as_of).cast("date"))
    steps = until.withColumn("next_date", F.lead("start_date").over(_journey_window()))
    current = steps.filter(F.col("next_date").isNull())
    return (current.groupBy("plan_id")
            .agg(F.count_distinct("customer_id").alias("customers"),
                 pct(F.count_distinct("customer_id"), _customers(subscriptions), 1).alias("percentage")))


def annual_upgrades_in_year(subscriptions: DataFrame, plans: DataFrame, year: int) -> DataFrame:
    named = _named(subscriptions, plans)
    return (named.filter((F.year("start_date") == year) & (F.col("plan_name") == "pro annual"))
            .agg(F.count_distinct("customer_id").alias("annual_customers")))


def _days_to_annual(subscriptions: DataFrame) -> DataFrame:
    """Per customer: days from trial start to pro-annual start (one pass,
    conditional minimum per customer instead of a self-join)."""
    per = subscriptions.groupBy("customer_id").agg(
        F.min(F.when(F.col("plan_id") == TRIAL, F.col("start_date"))).alias("trial_date"),
        F.min(F.when(F.col("plan_id") == PRO_ANNUAL, F.col("start_date"))).alias("annual_date"))
    both = per.filter(F.col("trial_date").isNotNull() & F.col("annual_date").isNotNull())
    return both.select("customer_id", F.datediff("annual_date", "trial_date").alias("days"))


def avg_days_to_annual(subscriptions: DataFrame) -> DataFrame:
    return _days_to_annual(subscriptions).agg(avg_round("days", 1).alias("avg_days_to_upgrade"))


def days_to_annual_histogram(subscriptions: DataFrame, width: int = 30,
                             method: str = "bins") -> DataFrame:
    """Customers per ``width``-day period to upgrade, shortest first: '0 - 30 days', '31 - 60 days', ...

    ``method='width_bucket'`` reproduces the reference's 12 buckets over
    365 days (labels then are approximate, see SURVEY D14).
    """
    days = _days_to_annual(subscriptions)
    if method == "width_bucket":
        b = F.width_bucket(F.col("days"), F.lit(0), F.lit(365), F.lit(12))
        label = F.concat(((b - 1) * width).cast("string"), F.lit(" - "), (b * width).cast("string"),
                         F.lit(" days"))
    else:
        b = F.greatest(F.ceil(F.col("days") / width), F.lit(1)).cast("int")
        lo = F.when(b == 1, F.lit(0)).otherwise((b - 1) * width + 1)
        label = F.concat(lo.cast("string"), F.lit(" - "), (b * width).cast("string"), F.lit(" days"))
    return (days.groupBy(b.alias("bin"), label.alias("bucket"))
            .agg(F.count(F.lit(1)).alias("num_of_customers"))
            .orderBy("bin").select("bucket", "num_of_customers"))


def downgrades(subscriptions: DataFrame, year: int) -> DataFrame:
    """Customers with a basic-monthly start after a pro-monthly start, both in ``year`` (any later one).

    One row per customer: some basic start is later than some pro start if the last is later than the
    first, so a customer counts once however often plans change.
    """
    in_year = subscriptions.filter(F.year("start_date") == year)
    per = in_year.groupBy("customer_id").agg(
        F.min(F.when(F.col("plan_id") == PRO_MONTHLY, F.col("start_date"))).alias("first_pro"),
        F.max(F.when(F.col("plan_id") == BASIC, F.col("start_date"))).alias("last_basic"))
    return per.agg(F.count_if(F.col("last_basic") > F.col("first_pro")).alias("downgraded_customers"))


def downgrades_immediate(subscriptions: DataFrame, year: int) -> DataFrame:
    """Pro monthly immediately followed by basic monthly within ``year`` (LEAD form)."""
    in_year = subscriptions.filter(F.year("start_date") == year)
    steps = in_year.withColumn("next_plan_id", F.lead("plan_id").over(_journey_window()))
    return (steps.filter((F.col("plan_id") == PRO_MONTHLY) & (F.col("next_plan_id") == BASIC))
            .agg(F.count("customer_id").alias("downgraded_customers")))
