"""The case-study tables of ``fixtures`` written as DuckDB SQL CTEs.

Used only to build the oracle SQL of ``__spark_entry__.oracle_sql``: each
query's SQL is prefixed with the CTEs of the tables it reads.  The views
``region nation customer supplier part orders lineitem events`` are the
given tables.
"""

from __future__ import annotations

from tidewater.sources.inline import INLINE_NAMES, RUN_DISTANCES, SIZES, inline_sql


def _case(expr: str, values: list) -> str:
    whens = " ".join(
        f"WHEN {i} THEN {repr(v) if isinstance(v, str) else v}" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {name: ((), inline_sql(name)) for name in INLINE_NAMES}

CTES.update({
    # ------------------------------------------------------------------ CS1
    "diner_sales": (("menu",), """
SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date, m.product_id
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
JOIN menu m ON m.product_name = p.p_type"""),
    "members": ((), """
SELECT o.o_custkey AS customer_id, CAST(min(o.o_orderdate) AS DATE) + 180 AS join_date
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment <> 'AUTOMOBILE' GROUP BY o.o_custkey"""),

    # ------------------------------------------------------------------ CS2
    "customer_orders": ((), """
SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS pizza_id,
  CASE l.l_partkey % 5 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN NULL
    WHEN 3 THEN CAST(l.l_partkey % 12 + 1 AS VARCHAR)
    ELSE CAST(l.l_partkey % 12 + 1 AS VARCHAR) || ', ' || CAST((l.l_partkey + 5) % 12 + 1 AS VARCHAR) END
    AS exclusions,
  CASE l.l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN ''
    WHEN 3 THEN CAST(l.l_suppkey % 12 + 1 AS VARCHAR)
    ELSE CAST(l.l_suppkey % 12 + 1 AS VARCHAR) || ', ' || CAST((l.l_suppkey + 7) % 12 + 1 AS VARCHAR) END
    AS extras,
  o.o_orderdate + to_hours(CAST(l.l_orderkey % 24 AS INTEGER)) AS order_time
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),
    "runner_orders": ((), """
SELECT order_id, runner_id,
  CASE WHEN cancelled THEN null_token ELSE strftime(pickup, '%Y-%m-%d %H:%M:%S') END AS pickup_time,
  CASE WHEN cancelled THEN null_token ELSE
    CASE order_id % 4 WHEN 0 THEN dist || 'km' WHEN 1 THEN dist || ' km' WHEN 2 THEN dist
      ELSE dist || 'km ' END END AS distance,
  CASE WHEN cancelled THEN null_token ELSE
    CASE order_id % 5 WHEN 0 THEN mins || ' minutes' WHEN 1 THEN mins || 'mins'
      WHEN 2 THEN mins || ' minute' WHEN 3 THEN mins || 'minutes' ELSE mins END END AS duration,
  CASE WHEN cancelled AND order_id % 2 = 0 THEN 'Restaurant Cancellation'
    WHEN cancelled THEN 'Customer Cancellation'
    WHEN order_id % 3 = 0 THEN NULL WHEN order_id % 3 = 1 THEN '' ELSE 'null' END AS cancellation
FROM (
  SELECT o_orderkey AS order_id, o_orderkey % 10 + 1 AS runner_id,
    o_orderkey % 9 = 0 AS cancelled,
    CASE WHEN o_orderkey % 2 = 0 THEN 'null' ELSE NULL END AS null_token,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
      + to_minutes(CAST(o_orderkey % 26 + 5 AS INTEGER)) AS pickup,
    CASE WHEN o_orderkey % 10 = 0 THEN CAST((o_orderkey + day(o_orderdate)) % 23 + 2 AS VARCHAR)
      ELSE CAST((o_orderkey + day(o_orderdate)) % 23 + 2 AS VARCHAR) || '.' || CAST(o_orderkey % 10 AS VARCHAR)
    END AS dist,
    CAST(o_orderkey % 31 + 10 AS VARCHAR) AS mins
  FROM orders) r"""),
    "runner_ratings": (("runner_orders",), """
SELECT order_id, CAST(order_id % 5 + 1 AS INTEGER) AS rating FROM runner_orders
WHERE cancellation IS NULL OR NOT ends_with(cancellation, 'Cancellation')"""),
    "runners": ((), """
SELECT s_suppkey AS runner_id, DATE '2021-01-01' + CAST(s_suppkey % 60 AS INTEGER) AS registration_date
FROM supplier"""),
    "pizza_names": ((), """
SELECT p_partkey AS pizza_id, CASE WHEN p_partkey % 2 = 0 THEN 'Meatlovers' ELSE 'Vegetarian' END AS pizza_name
FROM part"""),
    "pizza_recipes": ((), """
SELECT p_partkey AS pizza_id,
  CASE p_partkey % 3
    WHEN 0 THEN concat_ws(', ', CAST(p_partkey % 12 + 1 AS VARCHAR), CAST((p_partkey + 5) % 12 + 1 AS VARCHAR))
    WHEN 1 THEN concat_ws(', ', CAST(p_partkey % 12 + 1 AS VARCHAR), CAST((p_partkey + 5) % 12 + 1 AS VARCHAR),
                          CAST((p_partkey + 9) % 12 + 1 AS VARCHAR))
    ELSE concat_ws(', ', CAST(p_partkey % 12 + 1 AS VARCHAR), CAST((p_partkey + 5) % 12 + 1 AS VARCHAR),
                   CAST((p_partkey + 9) % 12 + 1 AS VARCHAR), CAST((p_partkey + 2) % 12 + 1 AS VARCHAR))
  END AS toppings
FROM part"""),

    "clean_orders": (("customer_orders",), """
SELECT order_id, customer_id, pizza_id,
  CASE WHEN trim(exclusions) IN ('null', '', 'NaN') THEN NULL ELSE trim(exclusions) END AS exclusions,
  CASE WHEN trim(extras) IN ('null', '', 'NaN') THEN NULL ELSE trim(extras) END AS extras,
  order_time
FROM customer_orders"""),
    "clean_runner": (("runner_orders",), """
SELECT order_id, runner_id,
  try_strptime(CASE WHEN trim(pickup_time) IN ('null', '', 'NaN') THEN NULL ELSE trim(pickup_time) END,
               '%Y-%m-%d %H:%M:%S') AS pickup_time,
  TRY_CAST(NULLIF(regexp_extract(CASE WHEN trim(distance) IN ('null', '', 'NaN') THEN NULL ELSE trim(distance) END,
                                 '[0-9]+(\\.[0-9]+)?'), '') AS DOUBLE) AS distance,
  TRY_CAST(NULLIF(regexp_extract(CASE WHEN trim(duration) IN ('null', '', 'NaN') THEN NULL ELSE trim(duration) END,
                                 '[0-9]+'), '') AS INTEGER) AS duration,
  CASE WHEN trim(cancellation) IN ('null', '', 'NaN') THEN NULL ELSE trim(cancellation) END AS cancellation
FROM runner_orders"""),

    # ------------------------------------------------------------------ CS3
    "subscriptions": ((), """
WITH firsts AS (
  SELECT user_id, event_type, min(ts) AS first_ts FROM events GROUP BY user_id, event_type),
signup AS (SELECT user_id, first_ts AS signup_ts FROM firsts WHERE event_type = 'signup')
SELECT f.user_id AS customer_id,
  CAST(CASE f.event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2
    WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS INTEGER) AS plan_id,
  CAST(f.first_ts AS DATE) AS start_date
FROM firsts f JOIN signup s ON f.user_id = s.user_id
WHERE f.first_ts >= s.signup_ts"""),

    # ------------------------------------------------------------------ CS4
    "regions": ((), "SELECT r_regionkey AS region_id, r_name AS region_name FROM region"),
    "customer_nodes": ((), """
SELECT o.o_custkey AS customer_id, n.n_regionkey AS region_id, l.l_suppkey % 5 + 1 AS node_id,
  least(CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS start_date,
  CASE WHEN l.l_orderkey % 20 = 0 THEN DATE '9999-12-31'
    ELSE greatest(CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) END AS end_date
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey"""),
    "customer_transactions": ((), """
SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
  CASE o_orderstatus WHEN 'O' THEN 'deposit' WHEN 'P' THEN 'purchase' WHEN 'F' THEN 'withdrawal' END AS txn_type,
  CAST(o_totalprice AS DECIMAL(18,2)) AS txn_amount
FROM orders"""),

    # ------------------------------------------------------------------ CS5
    "weekly_sales": ((), """
WITH keyed AS (
  SELECT CAST(date_trunc('week', CAST(CAST(l.l_shipdate AS DATE) + INTERVAL 20 YEAR AS DATE)) AS DATE) AS week,
    r.r_name AS region,
    CASE WHEN l.l_linestatus = 'O' THEN 'Retail' ELSE 'Shopify' END AS platform,
    CASE WHEN p.p_size % 10 = 0 THEN 'null'
      ELSE CASE WHEN p.p_size % 2 = 0 THEN 'C' ELSE 'F' END || CAST(p.p_size % 4 + 1 AS VARCHAR) END AS segment,
    CASE l.l_returnflag WHEN 'N' THEN 'New' WHEN 'R' THEN 'Existing' ELSE 'Guest' END AS customer_type,
    l.l_orderkey,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT strftime(week, '%-d/%-m/%y') AS week_date, region, platform, segment, customer_type,
  CAST(count(DISTINCT l_orderkey) AS INTEGER) AS transactions,
  CAST(floor(sum(amount)) AS BIGINT) AS sales
FROM keyed GROUP BY week, region, platform, segment, customer_type"""),

    # ------------------------------------------------------------------ CS6
    "click_events": ((), """
SELECT visit_id, cookie_id, page_id, event_type,
  CAST(row_number() OVER (PARTITION BY visit_id ORDER BY event_time, event_id) AS INTEGER) AS sequence_number,
  event_time
FROM (
  SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS visit_id,
    'c' || CAST(user_id * 10 + event_id % 3 AS VARCHAR) AS cookie_id,
    CAST(regexp_extract(props, '[0-9]+') AS INTEGER) % 13 + 1 AS page_id,
    CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
      WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS INTEGER) AS event_type,
    event_id, ts AS event_time
  FROM events) e"""),
    "users": ((), """
SELECT DISTINCT user_id, 'c' || CAST(user_id * 10 + event_id % 3 AS VARCHAR) AS cookie_id FROM events"""),

    # ------------------------------------------------------------------ CS7
    "retail_sales": ((), """
SELECT l.l_partkey AS prod_id, CAST(l.l_quantity AS INTEGER) AS qty,
  CAST(p.p_retailprice AS DECIMAL(18,2)) AS price,
  CAST(round(l.l_discount * 100) AS INTEGER) AS discount,
  o.o_custkey % 2 = 0 AS member, l.l_orderkey AS txn_id, o.o_orderdate AS start_txn_time
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey"""),
    "product_details": (("part_types",), """
SELECT p.p_partkey AS product_id, p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS product_name,
  t.type_id AS category_id, t.type_id * 100 + CAST(regexp_extract(p.p_brand, '[0-9]+') AS INTEGER) AS segment_id,
  p.p_type AS category_name, p.p_type || ' ' || p.p_brand AS segment_name
FROM part p JOIN part_types t ON p.p_type = t.type_name"""),
    "product_hierarchy": (("part_types",), """
SELECT CAST(type_id AS BIGINT) AS id, CAST(NULL AS BIGINT) AS parent_id, type_name AS level_text,
  'Category' AS level_name FROM part_types
UNION ALL
SELECT DISTINCT CAST(t.type_id * 100 + CAST(regexp_extract(p.p_brand, '[0-9]+') AS INTEGER) AS BIGINT),
  CAST(t.type_id AS BIGINT), p.p_brand, 'Segment'
FROM part p JOIN part_types t ON p.p_type = t.type_name
UNION ALL
SELECT p.p_partkey + 1000000, CAST(t.type_id * 100 + CAST(regexp_extract(p.p_brand, '[0-9]+') AS INTEGER) AS BIGINT),
  p.p_name, 'Style'
FROM part p JOIN part_types t ON p.p_type = t.type_name"""),
    "part_tree": ((), """
SELECT p_partkey AS id,
  CASE WHEN p_partkey % 97 = 0 THEN p_partkey + 1000000000 WHEN p_partkey = 5 THEN 16
    WHEN p_partkey >= 3 THEN p_partkey // 3 END AS parent_id, p_name AS name
FROM part"""),
    "product_prices": ((), """
SELECT p_partkey AS id, p_partkey + 1000000 AS product_id, CAST(p_retailprice AS DECIMAL(18,2)) AS price
FROM part"""),

    # ------------------------------------------------------------------ S1
    "shop_customer": ((), """
SELECT c_custkey AS id, c_mktsegment AS first_name, c_name AS last_name,
  CAST(c_custkey % 5 + 1 AS INTEGER) AS favorite_color_id
FROM customer"""),
    "shop_category": (("part_types",), """
SELECT type_id AS id, type_name AS name, CAST(NULL AS INTEGER) AS parent_id FROM part_types
UNION ALL
SELECT DISTINCT t.type_id * 100 + CAST(regexp_extract(p.p_brand, '[0-9]+') AS INTEGER),
  p.p_type || ' ' || p.p_brand, t.type_id
FROM part p JOIN part_types t ON p.p_type = t.type_name"""),
    "clothing": (("part_types",), f"""
SELECT p.p_partkey AS id, p.p_name AS name, {_case("p.p_size % 4", SIZES)} AS size,
  CAST(p.p_retailprice AS DECIMAL(18,2)) AS price, CAST(p.p_partkey % 5 + 1 AS INTEGER) AS color_id,
  t.type_id * 100 + CAST(regexp_extract(p.p_brand, '[0-9]+') AS INTEGER) AS category_id
FROM part p JOIN part_types t ON p.p_type = t.type_name"""),
    "clothing_order": ((), """
SELECT l.l_orderkey AS id, o.o_custkey - o.o_custkey % 3 AS customer_id, l.l_partkey AS clothing_id,
  CAST(l.l_quantity AS INTEGER) AS items, CAST(o.o_orderdate AS DATE) AS order_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""),

    # ------------------------------------------------------------------ S2
    "club_runner": ((), f"""
SELECT c_custkey AS id, c_name AS name, {_case("c_custkey % 4", RUN_DISTANCES)} * 1000 AS main_distance,
  CAST(c_custkey % 50 + 16 AS INTEGER) AS age, c_custkey % 2 = 1 AS is_female
FROM customer"""),
    "club_event": ((), """
SELECT n_nationkey AS id, n_name || ' Run' AS name, DATE '2024-03-01' + n_nationkey * 7 AS start_date,
  n_name AS city
FROM nation"""),
    "runner_event": ((), """
SELECT DISTINCT o_custkey AS runner_id, CAST(o_orderkey % 20 AS INTEGER) AS event_id FROM orders"""),

    # ------------------------------------------------------------------ S3
    "store_customers": ((), "SELECT c_custkey AS customer_id, c_name AS full_name FROM customer"),
    "store_orders": ((), """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
  CAST(o_totalprice AS DECIMAL(18,2)) AS total_amount
FROM orders"""),
})


def _resolve(names, seen: list[str]) -> list[str]:
    for name in names:
        if name in seen:
            continue
        deps, _ = CTES[name]
        _resolve(deps, seen)
        seen.append(name)
    return seen


def with_tables(tables: list[str] | tuple[str, ...], body: str) -> str:
    """Prefix ``body`` with the CTEs of ``tables`` (and their dependencies).

    ``body`` may itself start with ``WITH``; its CTEs are appended after the
    table CTEs so they can refer to them.
    """
    order = _resolve(tables, [])
    ctes = [f"{name} AS (\n{CTES[name][1].strip()}\n)" for name in order]
    text = body.strip()
    if text[:14].upper() == "WITH RECURSIVE":
        return "WITH RECURSIVE " + ",\n".join([*ctes, text[14:].lstrip()])
    if text[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes) + ",\n" + text[4:].lstrip()
    if not ctes:
        return text
    return "WITH " + ",\n".join(ctes) + "\n" + text
