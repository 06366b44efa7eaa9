"""Registered approximate reports, each set against its exact value."""

from __future__ import annotations

from tidewater.operators import approximate as op
from tidewater.plans.registry import query

T = ("store_orders",)


def _daily(fx, name, make):
    return fx.shared_result(name, lambda: make(fx.store_orders), "orders")


@query("approx_customers_by_month", T, """
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(DISTINCT customer_id) AS customers, TRUE AS within_bound
FROM store_orders WHERE order_date IS NOT NULL GROUP BY 1""")
def approx_customers_by_month(fx):
    return op.customers_by_month_checked(fx.store_orders, _daily(fx, "daily-customers", op.daily_customers))


@query("approx_returning_customers", T, """
WITH per AS (SELECT DISTINCT CAST(date_trunc('month', order_date) AS DATE) AS month, customer_id FROM store_orders
             WHERE order_date IS NOT NULL AND customer_id IS NOT NULL)
SELECT p.month, count(*) AS customers, count(n.customer_id) AS returning, TRUE AS within_bound
FROM per p LEFT JOIN per n ON n.customer_id = p.customer_id AND n.month = p.month + INTERVAL 1 MONTH
GROUP BY p.month""")
def approx_returning_customers(fx):
    return op.returning_customers_checked(fx.store_orders)


@query("approx_amount_percentiles_by_month", T, """
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(total_amount) AS orders, TRUE AS within_bound
FROM store_orders WHERE order_date IS NOT NULL AND total_amount IS NOT NULL GROUP BY 1""")
def approx_amount_percentiles_by_month(fx):
    return op.amounts_by_month_checked(fx.store_orders, _daily(fx, "daily-amounts", op.daily_amounts))
