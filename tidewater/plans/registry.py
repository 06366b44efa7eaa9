"""The catalogue of registered queries.

Each query is a function of the case-study tables (``Fixtures``) plus, when
it can be written in SQL, the equivalent DuckDB statement over the same
derived tables.  ``__spark_entry__`` exposes both.
"""

from __future__ import annotations

import importlib
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import spread
from tidewater.sources.fixtures import Fixtures
from tidewater.sources.oracle_fixtures import with_tables


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Fixtures], DataFrame]
    tables: tuple[str, ...]
    sql: str | None


REGISTRY: dict[str, Query] = {}

_PLAN_MODULES = ("loyalty", "delivery", "subscriptions", "accounts", "weekly_sales",
                 "clickstream", "retail", "exercises", "approximate")


#: Reports that come sorted: their columns in order, a leading minus for descending.  Nulls stand where
#: PostgreSQL puts them: last when ascending, first when descending.
REPORT_ORDER: dict[str, tuple[str, ...]] = {
    "customer_spend": ("customer_id",), "last_item_before_join": ("customer_id",), "spend_before_join": ("customer_id",),
    "loyalty_points": ("customer_id",),
    "customer_journey": ("customer_id", "start_date"), "trial_starts_by_month": ("month_date",), "plan_starts_after": ("plan_id",),
    "next_plan_after_trial": ("plan_id",),
    "customers_per_region": ("region_id",), "active_mix_customers_by_month": ("txn_month",),
    "monthly_balances": ("customer_id", "ending_month"),
    "sales_by_region_month": ("region", "month_number"), "transactions_by_platform": ("platform",),
    "platform_share_by_month": ("calendar_year", "month_number"), "demographic_share_by_year": ("calendar_year",),
    "avg_transaction_by_year_platform": ("calendar_year", "platform"),
    "visits_by_month": ("month_number",), "events_by_type": ("event_type",), "product_funnel": ("product_id",),
    "view_to_purchase_pct": ("-purchase_per_view_percentage", "product_name"),
    "top_product_per_segment": ("segment_name", "product_name"),
}


def in_report_order(name: str, df: DataFrame) -> DataFrame:
    columns = REPORT_ORDER.get(name)
    if not columns:
        return df
    return df.orderBy(*[F.col(c[1:]).desc_nulls_first() if c[0] == "-" else F.col(c).asc_nulls_last() for c in columns])


def query(name: str, tables: tuple[str, ...] = (), sql: str | None = None):
    """Register ``fn(fixtures) -> DataFrame`` under ``name`` with its oracle SQL."""
    def deco(fn: Callable[[Fixtures], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, tuple(tables), sql)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    for mod in _PLAN_MODULES:
        importlib.import_module(f"tidewater.plans.{mod}")
    return REGISTRY


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = Fixtures(spark, sf_dir)
    spread(spark, fx.td.n_bytes())
    return in_report_order(name, load_all()[name].build(fx))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _name=name: run(_name, spark, sf_dir)) for name in load_all()}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(q.tables, q.sql) for name, q in load_all().items() if q.sql}
