"""Approximate distinct counts and percentiles that roll up without rereading facts (opt-in).

Exact distinct counts and percentiles cannot be added up over days.  Sketches can: one row per day
(and group) holds a sketch of bounded size, and a month, a year or any other period is the union of
its days.  The stored table grows with days and groups, not with facts.

* Distinct values: HyperLogLog, relative standard error about 1.04 / sqrt(2^lg); theta sketches also
  intersect and subtract, as for customers who came back.
* Percentiles: KLL; a wanted rank is missed by a small part of all values, whatever the distribution.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch sizes: log2 of registers or entries, and k of KLL.
LG_DISTINCT, KLL_K = 12, 400


def relative_error(lg: int = LG_DISTINCT) -> float:
    """Relative standard error of a HyperLogLog estimate with 2^lg registers."""
    return 1.04 / (1 << lg) ** 0.5


def rank_error(k: int = KLL_K) -> float:
    """Bound of the rank error of a KLL sketch at 99 % confidence, as a part of all values."""
    return 2.446 / k ** 0.9433


def daily_distinct(df: DataFrame, day: Column, value: str, by: Sequence[str] = (), lg: int = LG_DISTINCT) -> DataFrame:
    """(day, by..., sketch): a HyperLogLog sketch of the distinct values of a day and group."""
    return df.groupBy(day.alias("day"), *by).agg(F.hll_sketch_agg(value, F.lit(lg)).alias("sketch"))


def distinct_by_period(daily: DataFrame, period: Column, by: Sequence[str] = ()) -> DataFrame:
    """(period, by..., estimate): distinct values of periods, from daily sketches only."""
    return daily.groupBy(period.alias("period"), *by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def period_sets(df: DataFrame, period: Column, value: str, lg: int = LG_DISTINCT) -> DataFrame:
    """(period, sketch): a theta sketch of the distinct values of each period."""
    return df.groupBy(period.alias("period")).agg(F.theta_sketch_agg(value, F.lit(lg)).alias("sketch"))


def returning(sets: DataFrame, next_period: Column) -> DataFrame:
    """(period, estimate, back): distinct values of a period, and those of them that the next period has too."""
    ahead = sets.select(F.col("period").alias("_next"), F.col("sketch").alias("_ahead"))
    both = F.theta_sketch_estimate(F.theta_intersection("sketch", "_ahead"))
    return sets.withColumn("_next", next_period).join(ahead, "_next", "left").select(
        "period", F.theta_sketch_estimate("sketch").alias("estimate"), F.coalesce(both, F.lit(0).cast("bigint")).alias("back"))


def daily_quantiles(df: DataFrame, day: Column, value: str, by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """(day, by..., sketch): a KLL sketch of the values of a day and group."""
    return df.groupBy(day.alias("day"), *by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def quantiles_by_period(daily: DataFrame, period: Column, ps: Sequence[float], names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(period, by..., names...): approximate percentiles of periods, from daily sketches only."""
    whole = daily.groupBy(period.alias("period"), *by).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return whole.select("period", *by, *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(n) for p, n in zip(ps, names)])
