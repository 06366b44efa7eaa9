"""Results do not depend on the session time zone (the driver's session may
not be UTC): date and timestamp logic works on DATE / TIMESTAMP_NTZ only."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_oracle import multiset

TIME_SENSITIVE = ["clean_runner_orders", "avg_pickup_minutes", "items_by_hour", "orders_by_weekday",
                  "clean_weekly_sales", "before_after_4w", "visits_by_month", "visit_campaign_summary",
                  "monthly_balances", "trial_starts_by_month", "monthly_report"]


@pytest.mark.parametrize("name", TIME_SENSITIVE)
def test_query_independent_of_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = entry.queries()[name](spark, SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert multiset(rows, list(df.columns)) == multiset(cur.fetchall(), cols)
