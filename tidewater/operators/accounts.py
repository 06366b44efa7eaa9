"""Node allocation and account balances over customer_nodes(customer_id,
region_id, node_id, start_date, end_date), regions(region_id, region_name)
and customer_transactions(customer_id, txn_date, txn_type, txn_amount).

Monthly balances: transactions are first reduced to one signed change per
customer and month (map-side partial aggregate), then to one row per
customer holding its month -> change map, so the month spine and the
running-sum window work on at most one row per customer and calendar
month, however many transactions a customer has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.common import grand, pct, ratio, rounded
from tidewater.functions.percentile import exact_percentiles

OPEN_END = "9999-12-31"


# ----------------------------------------------------------------------------- nodes
def unique_nodes(customer_nodes: DataFrame) -> DataFrame:
    return customer_nodes.agg(F.count_distinct("node_id").alias("unique_nodes"))


def nodes_per_region(customer_nodes: DataFrame, regions: DataFrame) -> DataFrame:
    return (customer_nodes.join(regions, "region_id")
            .groupBy("region_id", "region_name").agg(F.count_distinct("node_id").alias("node_counts")))


def customers_per_region(customer_nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """Distinct customers per region (the reference counts allocation rows)."""
    return (customer_nodes.join(regions, "region_id")
            .groupBy("region_id", "region_name").agg(F.count_distinct("customer_id").alias("customer_counts")))


def _node_days(customer_nodes: DataFrame, by_region: bool = False) -> DataFrame:
    """Total days per customer and node (and region) over closed allocations,
    each allocation counted once."""
    keys = ["customer_id", "node_id"] + (["region_id"] if by_region else [])
    closed = customer_nodes.filter(F.col("end_date") != F.lit(OPEN_END).cast("date"))
    spans = closed.select(*keys, "start_date", "end_date").distinct()
    return (spans.groupBy(*keys)
            .agg(F.sum(F.datediff("end_date", "start_date")).alias("total_days_in_node")))


def avg_reallocation_days(customer_nodes: DataFrame) -> DataFrame:
    days = _node_days(customer_nodes)
    return days.agg(ratio(F.sum("total_days_in_node"), F.count("total_days_in_node"), 0)
                    .alias("avg_node_reallocation_days"))


def reallocation_percentiles(customer_nodes: DataFrame, percentiles=(0.5, 0.8, 0.95)) -> DataFrame:
    """Exact (interpolated) percentiles of the node-days metric per region; a
    region is never gathered in one task, however many customers it has."""
    days = _node_days(customer_nodes, by_region=True)
    names = ["median_days", "percentile_80", "percentile_95"]
    return exact_percentiles(days, "total_days_in_node", percentiles, names, scale=2, by=["region_id"])


# ----------------------------------------------------------------------------- transactions
def txn_summary_by_type(customer_transactions: DataFrame) -> DataFrame:
    return customer_transactions.groupBy("txn_type").agg(
        F.count("txn_type").alias("transaction_count"),
        rounded(F.sum("txn_amount")).alias("total_amount"))


def avg_deposit_per_customer(customer_transactions: DataFrame) -> DataFrame:
    """Average of per-customer deposit counts and of per-customer average deposit."""
    per = (customer_transactions.filter(F.col("txn_type") == "deposit").groupBy("customer_id")
           .agg(F.count("customer_id").alias("txn_count"), F.avg("txn_amount").alias("avg_amount")))
    return per.agg(ratio(F.sum("txn_count"), F.count("txn_count"), 0).alias("avg_deposit_count"),
                   rounded(F.avg("avg_amount"), 0).alias("avg_deposit_amt"))


def active_mix_customers_by_month(customer_transactions: DataFrame, min_deposits: int = 2) -> DataFrame:
    """Customers per month with more than one deposit and at least one
    purchase or withdrawal -> txn_month, customer_count."""
    t = F.col("txn_type")
    per = (customer_transactions
           .groupBy(F.trunc("txn_date", "month").alias("txn_month"), "customer_id")
           .agg(F.count_if(t == "deposit").alias("deposit_count"),
                F.count_if(t == "purchase").alias("purchase_count"),
                F.count_if(t == "withdrawal").alias("withdrawal_count")))
    active = per.filter((F.col("deposit_count") >= min_deposits)
                        & ((F.col("purchase_count") >= 1) | (F.col("withdrawal_count") >= 1)))
    return active.groupBy("txn_month").agg(F.count_distinct("customer_id").alias("customer_count"))


def _signed_amount() -> Column:
    t = F.col("txn_type")
    return F.when(t.isin("withdrawal", "purchase"), -F.col("txn_amount")).otherwise(F.col("txn_amount"))


def monthly_balances(customer_transactions: DataFrame) -> DataFrame:
    """Closing balance and change per customer and month end.

    Months run from each customer's first transaction month to the last
    month in the data (the reference fixes Jan-Apr 2020); months without
    transactions carry the balance with a change of 0.
    A transaction without a date belongs to no month and is left out.
    -> customer_id, ending_month, total_monthly_change, ending_balance (decimal)
    """
    monthly = (customer_transactions.filter(F.col("txn_date").isNotNull())
               .groupBy("customer_id", F.last_day("txn_date").alias("ending_month"))
               .agg(F.sum(_signed_amount()).alias("change")))
    last_month = grand(monthly, F.max(F.trunc("ending_month", "month")))
    # One row per customer with its month -> change map: at most one entry
    # per calendar month, however many transactions the customer has.  The
    # spine is expanded from that row, so the rows stay partitioned by
    # customer and the running-sum window needs no further shuffle.
    per_customer = monthly.groupBy("customer_id").agg(
        F.min(F.trunc("ending_month", "month")).alias("first_month"),
        F.map_from_entries(F.collect_list(F.struct("ending_month", "change"))).alias("changes"))
    spine = (per_customer
             .select("customer_id", "changes",
                     F.explode(F.sequence("first_month", last_month, F.expr("INTERVAL 1 MONTH")))
                      .alias("month_start"))
             .select("customer_id", "changes", F.last_day("month_start").alias("ending_month")))
    w = (Window.partitionBy("customer_id").orderBy("ending_month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    change = F.coalesce(F.try_element_at("changes", F.col("ending_month")), F.lit(0).cast(monthly.schema["change"].dataType))
    return (spine.select("customer_id", "ending_month", change.alias("total_monthly_change"))
            .select("customer_id", "ending_month", "total_monthly_change",
                    F.sum("total_monthly_change").over(w).alias("ending_balance")))


def ranked_monthly_balances(balances: DataFrame) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("ending_month")
    return balances.select("customer_id", "ending_month", "ending_balance",
                           F.row_number().over(w).alias("ranked_row"))


def as_double(balances: DataFrame) -> DataFrame:
    """Report form of the balances (money as DOUBLE)."""
    return balances.select(*[rounded(c).alias(c) if c in ("total_monthly_change", "ending_balance")
                             else F.col(c) for c in balances.columns])


def _first_two_months(balances: DataFrame) -> DataFrame:
    """Per customer: first month's closing balance and the next month's."""
    w = Window.partitionBy("customer_id").orderBy("ending_month")
    ranked = balances.select("customer_id", "ending_balance",
                             F.row_number().over(w).alias("ranked_row"),
                             F.lead("ending_balance").over(w).alias("following_balance"))
    return ranked.filter(F.col("ranked_row") == 1)


def _share_of_customers(balances: DataFrame, cond: Column, name: str) -> DataFrame:
    """Percentage of customers whose first two months satisfy ``cond``.

    ``_first_two_months`` keeps one row per customer, so the denominator
    (distinct customers) is a count over the same rows: one aggregate, no
    second pass over the balances.
    """
    first = _first_two_months(balances)
    who = F.col("customer_id")
    return first.agg(pct(F.count(F.when(cond, who)), F.count(who), 1).alias(name))


def first_month_sign_pct(balances: DataFrame) -> DataFrame:
    """Share of customers whose first month closes negative / not negative."""
    first = _first_two_months(balances)
    who, o = F.col("customer_id"), F.col("ending_balance")
    n = F.count(who)
    return first.agg(pct(F.count_if(o < 0), n, 1).alias("negative_first_month_percentage"),
                     pct(F.count_if(o >= 0), n, 1).alias("positive_first_month_percentage"))


def first_month_sign_pct_complement(balances: DataFrame) -> DataFrame:
    """Second form: negative share, and 100 minus it."""
    first = _first_two_months(balances)
    who = F.col("customer_id")
    neg = pct(F.count(F.when(F.col("ending_balance") < 0, who)), F.count(who), 1)
    return first.agg(neg.alias("negative_first_month_percentage"),
                     (F.lit(100.0) - neg).alias("positive_first_month_percentage"))


def balance_increase_pct(balances: DataFrame, threshold_pct: int = 5) -> DataFrame:
    """Customers whose positive first-month balance grows by more than the
    threshold in the next month, as a share of all customers."""
    o, f = F.col("ending_balance"), F.col("following_balance")
    grew = (o > 0) & f.isNotNull() & ((f - o) * 100 > o * threshold_pct)
    return _share_of_customers(balances, grew, "increase_5_percentage")


def balance_reduce_pct(balances: DataFrame, threshold_pct: int = 5) -> DataFrame:
    """Customers whose positive first-month balance falls by more than the threshold."""
    o, f = F.col("ending_balance"), F.col("following_balance")
    fell = (o > 0) & f.isNotNull() & ((f - o) * 100 < -o * threshold_pct)
    return _share_of_customers(balances, fell, "reduce_5_percentage")


def positive_to_negative_pct(balances: DataFrame) -> DataFrame:
    moved = (F.col("ending_balance") >= 0) & (F.col("following_balance") < 0)
    return _share_of_customers(balances, moved, "positive_to_negative_percentage")
