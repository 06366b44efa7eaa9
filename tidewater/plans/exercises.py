"""Registered exercise-sheet queries (S1 clothing shop, S2 running club, S3 store)."""

from __future__ import annotations

from tidewater.operators import exercises as op
from tidewater.plans.registry import query


@query("items_in_favourite_colour", ("clothing_order", "shop_customer", "clothing", "colour"), """
SELECT cl.name AS clothes, co.name AS color, cu.last_name, cu.first_name
FROM clothing_order o
JOIN clothing cl ON o.clothing_id = cl.id
JOIN shop_customer cu ON o.customer_id = cu.id
JOIN colour co ON cl.color_id = co.id
WHERE cl.color_id = cu.favorite_color_id""")
def items_in_favourite_colour(fx):
    return op.items_in_favourite_colour(fx.clothing_order, fx.shop_customer, fx.clothing, fx.colour)


@query("non_buying_customers", ("shop_customer", "clothing_order", "colour"), """
SELECT cu.last_name, cu.first_name, co.name AS favorite_color
FROM shop_customer cu LEFT JOIN colour co ON cu.favorite_color_id = co.id
WHERE NOT EXISTS (SELECT 1 FROM clothing_order o WHERE o.customer_id = cu.id)""")
def non_buying_customers(fx):
    return op.non_buying_customers(fx.shop_customer, fx.clothing_order, fx.colour)


@query("category_tree_level1", ("shop_category",), """
SELECT m.name AS category, s.name AS subcategory
FROM shop_category m LEFT JOIN shop_category s ON s.parent_id = m.id
WHERE m.parent_id IS NULL""")
def category_tree_level1(fx):
    return op.category_tree_level1(fx.shop_category)


@query("distance_groups_over_n", ("club_runner",), """
SELECT main_distance, count(id) AS runners_number FROM club_runner
GROUP BY main_distance HAVING count(id) > 3""")
def distance_groups_over_n(fx):
    return op.distance_groups_over_n(fx.club_runner)


@query("runners_per_event_with_zero", ("club_event", "runner_event"), """
SELECT e.name AS event_name, count(re.runner_id) AS runner_count
FROM club_event e LEFT JOIN runner_event re ON e.id = re.event_id
GROUP BY e.id, e.name""")
def runners_per_event_with_zero(fx):
    return op.runners_per_event_with_zero(fx.club_event, fx.runner_event)


@query("runners_by_age_band", ("club_runner",), """
SELECT main_distance,
  count(*) FILTER (WHERE age < 20) AS under_20,
  count(*) FILTER (WHERE age BETWEEN 20 AND 29) AS age_20_29,
  count(*) FILTER (WHERE age BETWEEN 30 AND 39) AS age_30_39,
  count(*) FILTER (WHERE age BETWEEN 40 AND 49) AS age_40_49,
  count(*) FILTER (WHERE age >= 50) AS over_50
FROM club_runner GROUP BY main_distance""")
def runners_by_age_band(fx):
    return op.runners_by_age_band(fx.club_runner)


@query("top_orders_by_amount", ("store_orders",), """
SELECT order_id, customer_id, order_date, CAST(total_amount AS DOUBLE) AS total_amount
FROM store_orders ORDER BY total_amount DESC, order_id LIMIT 3""")
def top_orders_by_amount(fx):
    return op.top_orders_by_amount(fx.store_orders)


@query("order_deltas", ("store_orders",), """
WITH d AS (
  SELECT order_id, customer_id, total_amount,
    lag(total_amount) OVER (PARTITION BY customer_id ORDER BY order_date, order_id) AS previous_value
  FROM store_orders)
SELECT order_id, customer_id, CAST(total_amount AS DOUBLE) AS total_amount,
  CAST(previous_value AS DOUBLE) AS previous_value, CAST(total_amount - previous_value AS DOUBLE) AS delta
FROM d""")
def order_deltas(fx):
    return op.order_deltas(fx.store_orders)


@query("running_total_per_customer", ("store_orders", "store_customers"), """
SELECT o.customer_id, c.full_name, o.order_id, o.order_date, CAST(o.total_amount AS DOUBLE) AS total_amount,
  CAST(sum(o.total_amount) OVER (PARTITION BY o.customer_id ORDER BY o.order_date, o.order_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_total
FROM store_orders o JOIN store_customers c ON o.customer_id = c.customer_id""")
def running_total_per_customer(fx):
    return op.running_total_per_customer(fx.store_orders, fx.store_customers)
