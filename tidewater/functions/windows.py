"""Per-key running totals and previous values that do not put a hot key in
one task.

A plain ``sum(...) OVER (PARTITION BY customer ORDER BY date, id)`` sends
all rows of a customer to one task.  Here the work is split into units of
(key, day, id bucket), where the bucket is the ordering id shifted right by
``bucket_bits`` (so a unit holds at most 2**bucket_bits distinct ids):

* totals of days and units come from map-side partial aggregates;
* a prefix over a key's days holds at most one row per calendar day, a prefix
  over a day's units one row per bucket;
* the running sum inside a unit is a window partitioned by the unit, whose
  size the bucket width bounds;
* they meet in null-safe equi-joins, so rows with a NULL key, day or ordering
  value stay (NULL keys are one key, NULL days and values come last).

The bucket is monotone in the id, so (day, bucket, id) order equals (day, id)
order and the result equals the single-window form exactly.  A non-integral
ordering column has one bucket per (key, day): the day's rows are then one
window partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET_BITS = 20  # at most ~1M distinct ids per (key, day) unit


def _bucket(df: DataFrame, order: str, bucket_bits: int) -> Column:
    if isinstance(df.schema[order].dataType, T.IntegralType):
        return F.shiftright(F.col(order).cast("long"), bucket_bits)
    return F.lit(0).cast("long")


def _attach(rows: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on null-safe equality of ``keys``; the keys of ``extra`` are dropped."""
    other = {k: f"_join_{k}" for k in keys}
    cond = F.lit(True)
    for k, o in other.items():
        cond = cond & F.col(k).eqNullSafe(F.col(o))
    return rows.join(extra.withColumnsRenamed(other), cond, "left").drop(*other.values())


def _last(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def running_total(df: DataFrame, key: str, day: str, order: str, value: str,
                  out: str = "running_total", bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """``df`` plus ``out`` = running sum of ``value`` per ``key`` ordered by (``day``, ``order``)."""
    unit = [key, day, "_bucket"]
    rows = df.withColumn("_bucket", _bucket(df, order, bucket_bits))
    per_unit = rows.groupBy(*unit).agg(F.sum(value).alias("_total"))
    per_day = per_unit.groupBy(key, day).agg(F.sum("_total").alias("_total"))
    zero = F.lit(0).cast(per_day.schema["_total"].dataType)

    def before(w):
        return F.sum("_total").over(w.rowsBetween(Window.unboundedPreceding, -1))

    days = per_day.select(key, day, before(Window.partitionBy(key).orderBy(*_last(day))).alias("_before_day"))
    units = per_unit.select(*unit, before(Window.partitionBy(key, day).orderBy(*_last("_bucket"))).alias("_before_unit"))
    within = Window.partitionBy(*unit).orderBy(*_last(order)).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_within_unit", F.sum(value).over(within))
    rows = _attach(_attach(rows, units, unit), days, [key, day])
    parts = [F.col(c) for c in ("_before_day", "_before_unit", "_within_unit")]
    total = sum((F.coalesce(c, zero) for c in parts[1:]), F.coalesce(parts[0], zero))
    return (rows.withColumn(out, F.when(F.coalesce(*parts).isNotNull(), total))  # NULL before the first value
            .drop("_before_day", "_before_unit", "_within_unit", "_bucket"))


def previous_value(df: DataFrame, key: str, day: str, order: str, value: str,
                   out: str = "previous_value", bucket_bits: int = BUCKET_BITS) -> DataFrame:
    """``df`` plus ``out`` = ``value`` of the previous row of the same ``key``
    in (``day``, ``order``) order (NULL for a key's first row)."""
    unit = [key, day, "_bucket"]
    rows = df.withColumn("_bucket", _bucket(df, order, bucket_bits))
    place = F.struct(F.col(order).isNull(), F.col(order))  # NULL comes last
    per_unit = rows.groupBy(*unit).agg(F.max_by(F.struct(value), place).alias("_last"))
    per_day = per_unit.groupBy(key, day).agg(
        F.max_by("_last", F.struct(F.col("_bucket").isNull(), F.col("_bucket"))).alias("_last"))
    days = per_day.select(key, day, F.lag("_last").over(Window.partitionBy(key).orderBy(*_last(day))).alias("_day_before"))
    units = per_unit.select(*unit, F.lag("_last").over(Window.partitionBy(key, day).orderBy(*_last("_bucket"))).alias("_unit_before"))
    within = Window.partitionBy(*unit).orderBy(*_last(order))
    rows = rows.withColumn("_lag_in_unit", F.lag(value).over(within)) \
        .withColumn("_first_in_unit", F.row_number().over(within) == 1)
    rows = _attach(_attach(rows, units, unit), days, [key, day])
    earlier = F.coalesce("_unit_before", "_day_before").getField(value)
    return (rows.withColumn(out, F.when(F.col("_first_in_unit"), earlier).otherwise(F.col("_lag_in_unit")))
            .drop("_lag_in_unit", "_first_in_unit", "_day_before", "_unit_before", "_bucket"))
