"""Joins of points with the intervals that hold them, without an equality key.

A range condition alone leaves Spark a nested loop over all pairs, and one row per step of an
interval breaks on open-ended ones.  Here every interval is covered by dyadic nodes: node n of level
l stands for the steps n * 2^l to (n + 1) * 2^l - 1, and the largest nodes inside an interval are two
a level at most, whatever its length.  A point lies in exactly one node of each level and in at most
one node of an interval's cover, so points meet intervals in an equi-join on (level, node) that the
planner may broadcast or shuffle.  Points look up only the levels that some cover uses.

Steps are days for dates and timestamps and whole numbers otherwise; the exact condition is checked
on the pairs found, so steps only decide who meets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.common import grand

_LEVEL, _NODE = "_interval_level", "_interval_node"


def _step(df: DataFrame, name: str) -> tuple[Column, int]:
    """The step of a column (non-decreasing in it), and bits that hold any step."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_date(F.to_date(col)).cast("bigint"), 24
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return col.cast("bigint"), 33
    if isinstance(kind, T.LongType):
        return col, 62
    if isinstance(kind, T.NumericType):
        return F.floor(col).cast("bigint"), 62
    raise TypeError(f"no steps for a column of type {kind.simpleString()}")


def _shift(x: Column, level: Column) -> Column:
    return F.call_function("shiftright", x, level)


def dyadic_cover(lo: Column, hi: Column, bits: int) -> Column:
    """The largest dyadic nodes inside lo..hi (both included) as an array of (level, node)."""
    def inside(level: Column) -> tuple[Column, Column]:
        return -_shift(-lo, level), _shift(hi + 1, level) - 1

    def nodes(level: Column) -> Column:
        (first, last), (above_first, above_last) = inside(level), inside(level + 1)
        # a node whose parent lies inside too belongs to the parent
        top = F.filter(F.array_distinct(F.array(first, last)), lambda n: n.between(first, last)
                       & ~_shift(n, F.lit(1)).between(above_first, above_last))
        return F.transform(top, lambda n: F.struct(level.alias(_LEVEL), n.alias(_NODE)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(bits)), nodes))


def interval_pairs(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, null_is_open: bool = True,
                   keep_points: bool = False) -> DataFrame:
    """A row with the columns of both sides for every point and interval with start <= at <= end.

    A null start or end is open with ``null_is_open`` and otherwise matches nothing, as a null point
    does.  With ``keep_points`` every point has one more row whose interval columns are null, for
    callers that aggregate the rows of a point.  Column names must differ between the sides.
    """
    (x, bits), (lo, lo_bits), (hi, hi_bits) = _step(points, at), _step(intervals, start), _step(intervals, end)
    bits = max(bits, lo_bits, hi_bits)
    least, most = -(1 << (bits - 1)), (1 << (bits - 1)) - 1
    if null_is_open:
        lo, hi = F.coalesce(lo, F.lit(least)), F.coalesce(hi, F.lit(most))
    nodes = F.explode(dyadic_cover(F.greatest(lo, F.lit(least)), F.least(hi, F.lit(most)), bits))
    known = lo.isNotNull() & hi.isNotNull()
    cover = intervals.filter(known).select("*", nodes.alias("_node")).select("*", f"_node.{_LEVEL}", f"_node.{_NODE}").drop("_node")
    used = F.coalesce(grand(cover, F.sort_array(F.collect_set(_LEVEL))), F.array().cast("array<int>"))
    levels = F.array_append(used, F.lit(None).cast("int")) if keep_points else used
    asked = points.select("*", F.explode(levels).alias("_at_level")).withColumn("_at_node", _shift(x, F.col("_at_level")))
    held = (F.col(start).isNull() | (F.col(start) <= F.col(at))) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))
    meet = (F.col("_at_level") == F.col(_LEVEL)) & (F.col("_at_node") == F.col(_NODE)) & held
    pairs = asked.join(cover, meet, "left" if keep_points else "inner")
    if keep_points:
        pairs = pairs.filter(F.col(_LEVEL).isNotNull() | F.col("_at_level").isNull())
    return pairs.drop("_at_level", "_at_node", _LEVEL, _NODE)


def interval_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, how: str = "inner",
                  key: list[str] | None = None, null_is_open: bool = True) -> DataFrame:
    """``points`` joined with the ``intervals`` that hold them (start <= at <= end).

    ``how='left'`` keeps points that no interval holds; ``key`` then names the columns that tell points
    apart (null is a value like any other).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if how == "inner":
        return interval_pairs(points, intervals, at, start, end, null_is_open)
    if not key:
        raise ValueError("a left join needs the key of the points")
    found = interval_pairs(points.select(*key, at), intervals, at, start, end, null_is_open)
    found = found.select(*[F.col(k).alias(f"_key_{k}") for k in key], *intervals.columns)
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return points.join(found, same, "left").drop(*[f"_key_{k}" for k in key])
