"""Case-study tables as temp views: SQL written against the case-study
schemas runs through spark.sql and agrees with the operators."""

from tests.conftest import SMALL
from tidewater.operators import delivery, loyalty
from tidewater.sources.fixtures import VIEWS, Fixtures


def test_views_and_sql(spark):
    fx = Fixtures(spark, SMALL)
    assert set(fx.register_views()) == set(VIEWS)
    got = spark.sql("""
        SELECT s.customer_id, SUM(m.price) AS total_sales
        FROM loyalty_sales s INNER JOIN loyalty_menu m ON s.product_id = m.product_id
        GROUP BY s.customer_id""")
    assert sorted(got.collect()) == sorted(loyalty.customer_spend(fx.diner_sales, fx.menu).collect())
    hours = spark.sql("""
        SELECT DATE_PART('hour', order_time::TIMESTAMP) AS hour_of_day, COUNT(order_id) AS pizza_count
        FROM delivery_customer_orders GROUP BY hour_of_day""")
    want = delivery.items_by_hour(fx.customer_orders)
    assert sorted((int(a), b) for a, b in hours.collect()) == sorted((a, b) for a, b in want.collect())
