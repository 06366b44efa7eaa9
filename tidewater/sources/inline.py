"""Small fixed dimension tables (menus, plan lists, page maps, campaigns).

These are lookup tables of a fixed, tiny size; the facts they describe are
derived from the given tables in ``fixtures``.  Each is built once as a
Spark DataFrame and once as a SQL ``VALUES`` list for the DuckDB oracle,
from the same constants below.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values, together and in natural order.
# ---------------------------------------------------------------------------

# Restaurant menu: one item per part type; PROMO is the item with double points.
MENU = [
    (1, "ECONOMY", 10),
    (2, "LARGE", 15),
    (3, "MEDIUM", 12),
    (4, "PROMO", 10),
    (5, "SMALL", 8),
    (6, "STANDARD", 14),
]
DOUBLE_POINTS_ITEM = "PROMO"

# Category ids of the six part types (retail category_id, clothing main category).
PART_TYPES = [(product_id, name) for product_id, name, _price in MENU]

PIZZA_TOPPINGS = [
    (1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"), (6, "Mushrooms"),
    (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"), (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce"),
]
PIZZA_PRICES = {"Meatlovers": 12, "Vegetarian": 10}

PLANS = [
    (0, "trial", Decimal("0.00")),
    (1, "basic monthly", Decimal("9.90")),
    (2, "pro monthly", Decimal("19.90")),
    (3, "pro annual", Decimal("199.00")),
    (4, "churn", None),
]

EVENT_IDENTIFIER = [
    (1, "Page View"), (2, "Add to Cart"), (3, "Purchase"), (4, "Ad Impression"), (5, "Ad Click"),
]

PAGE_HIERARCHY = [
    (1, "Home Page", None, None),
    (2, "All Products", None, None),
    (3, "Trout", "Fish", 1),
    (4, "Mackerel", "Fish", 2),
    (5, "Sardine", "Fish", 3),
    (6, "Saffron", "Luxury", 4),
    (7, "Truffle Oil", "Luxury", 5),
    (8, "Mussel", "Shellfish", 6),
    (9, "Shrimp", "Shellfish", 7),
    (10, "Scallop", "Shellfish", 8),
    (11, "Clam", "Shellfish", 9),
    (12, "Checkout", None, None),
    (13, "Confirmation", None, None),
]

# Campaigns over the January 2024 click data; the first two overlap on 8-10 January, the last two
# are still running, one to a date far off and one without an end.
CAMPAIGNS = [
    (1, "1-3", "Winter Catch", dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 10, 23, 59, 59)),
    (2, "4-5", "Luxury Week", dt.datetime(2024, 1, 8, 0, 0, 0), dt.datetime(2024, 1, 15, 23, 59, 59)),
    (3, "6-9", "Shell Out", dt.datetime(2024, 1, 20, 0, 0, 0), dt.datetime(2024, 1, 31, 23, 59, 59)),
    (4, "1-9", "Evergreen", dt.datetime(2024, 1, 12, 12, 0, 0), dt.datetime(9999, 12, 31, 0, 0, 0)),
    (5, "2-3", "Open House", dt.datetime(2024, 1, 27, 6, 30, 0), None),
]

# Clothing-shop colours (id, name, extra_fee).
COLOURS = [
    (1, "Red", Decimal("0.00")),
    (2, "Green", Decimal("1.50")),
    (3, "Blue", Decimal("0.00")),
    (4, "Yellow", Decimal("2.00")),
    (5, "Black", Decimal("0.50")),
]
SIZES = ["S", "M", "L", "XL"]

# Running-club distances in km.
RUN_DISTANCES = [5, 10, 21, 42]

# ---------------------------------------------------------------------------

_TABLES: dict[str, tuple[list[tuple], T.StructType]] = {
    "menu": (MENU, T.StructType([
        T.StructField("product_id", T.IntegerType()), T.StructField("product_name", T.StringType()),
        T.StructField("price", T.IntegerType())])),
    "part_types": (PART_TYPES, T.StructType([
        T.StructField("type_id", T.IntegerType()), T.StructField("type_name", T.StringType())])),
    "pizza_toppings": (PIZZA_TOPPINGS, T.StructType([
        T.StructField("topping_id", T.IntegerType()), T.StructField("topping_name", T.StringType())])),
    "plans": (PLANS, T.StructType([
        T.StructField("plan_id", T.IntegerType()), T.StructField("plan_name", T.StringType()),
        T.StructField("price", T.DecimalType(5, 2))])),
    "event_identifier": (EVENT_IDENTIFIER, T.StructType([
        T.StructField("event_type", T.IntegerType()), T.StructField("event_name", T.StringType())])),
    "page_hierarchy": (PAGE_HIERARCHY, T.StructType([
        T.StructField("page_id", T.IntegerType()), T.StructField("page_name", T.StringType()),
        T.StructField("product_category", T.StringType()), T.StructField("product_id", T.IntegerType())])),
    "campaign_identifier": (CAMPAIGNS, T.StructType([
        T.StructField("campaign_id", T.IntegerType()), T.StructField("products", T.StringType()),
        T.StructField("campaign_name", T.StringType()), T.StructField("start_date", T.TimestampNTZType()),
        T.StructField("end_date", T.TimestampNTZType())])),
    "colour": (COLOURS, T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
        T.StructField("extra_fee", T.DecimalType(5, 2))])),
}

INLINE_NAMES = tuple(_TABLES)


def inline_df(spark: SparkSession, name: str) -> DataFrame:
    """A fixed lookup table as a DataFrame (a handful of rows; safe to broadcast)."""
    rows, schema = _TABLES[name]
    return spark.createDataFrame(rows, schema)


def _sql_literal(value, dtype: T.DataType) -> str:
    if value is None:
        return "NULL"
    if isinstance(dtype, T.StringType):
        return "'" + str(value).replace("'", "''") + "'"
    if isinstance(dtype, T.DecimalType):
        return f"CAST({value} AS DECIMAL({dtype.precision},{dtype.scale}))"
    if isinstance(dtype, T.TimestampNTZType):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S}'"
    return str(value)


def inline_sql(name: str) -> str:
    """The same table as a SQL CTE body: ``SELECT * FROM (VALUES ...) t(cols)``."""
    rows, schema = _TABLES[name]
    fields = schema.fields
    values = ",\n    ".join(
        "(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(row, fields)) + ")" for row in rows)
    cols = ", ".join(f.name for f in fields)
    casts = ", ".join(
        f"CAST({f.name} AS {_duck_type(f.dataType)}) AS {f.name}" for f in fields)
    return f"SELECT {casts} FROM (VALUES\n    {values}) AS t({cols})"


def _duck_type(dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return "VARCHAR"
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    if isinstance(dtype, T.TimestampNTZType):
        return "TIMESTAMP"
    if isinstance(dtype, T.LongType):
        return "BIGINT"
    return "INTEGER"
