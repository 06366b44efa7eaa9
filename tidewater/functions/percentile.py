"""Exact interpolated percentiles (PERCENTILE_CONT), global or per group, as one lazy, distributed plan.

Spark's exact ``percentile`` aggregate keeps every distinct value of a group in one buffer.  Here a
rank is located in two steps, whatever the distribution and however large a group is:

1. *Sketch.*  A mergeable quantile sketch per group (``percentile_approx``, aggregated on the map side)
   gives for each percentile two values with ranks a little below and above the wanted one.
2. *Count.*  Values are reduced to (group, value, count), so ties are one row.  One aggregate counts
   what lies below the bracket, exactly; only the distinct values inside it, about 4 / ``accuracy`` of a
   group, are cumulated one by one.  Where the exact counts show that a bracket misses its rank, the
   bracket is the whole group, so the sketch never decides a result.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Relative rank error of the sketch is one part of this.
ACCURACY = 10_000
#: Parts of a group that meet its sketch in different tasks.
SALTS = 64


def _holds(rank: Column) -> Column:
    return (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))


def rank_candidates(df: DataFrame, col: str, ps: Sequence[float], by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """(by..., i, x, n, before, low, high, part): the distinct values of the bracket of percentile number
    ``i``, with their counts and the number of values in front; ``low`` and ``high`` are the ranks between
    which the percentile lies, ``part`` of the way."""
    keys = ["_group"]  # a struct, so that a group whose key is NULL meets itself
    group = F.struct(*by) if by else F.lit(0)
    rows = df.select(group.alias("_group"), F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    values = rows.groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("n"))
    around = [min(max(p + sign * 2 / accuracy, 0.0), 1.0) for sign in (-1, 1) for p in ps]
    sketched = rows.groupBy(*keys).agg(F.percentile_approx("x", around, accuracy).alias("q"), F.count(F.lit(1)).alias("size"))

    k = len(ps)

    def one(side: DataFrame) -> DataFrame:
        """A side that has one row, or one for each percentile, if there are no groups."""
        return side if by else F.broadcast(side)

    # a group's values meet its sketch in SALTS parts, so a group of any size is spread
    salt = F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int")
    sides = sketched.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))) if by else sketched.withColumn("_salt", F.lit(0))
    joined = values.withColumn("_salt", salt if by else F.lit(0)).join(one(sides), [*keys, "_salt"])

    def counted(where: Column) -> Column:
        return F.sum(F.when(where, F.col("n")).otherwise(F.lit(0)))

    counts = joined.groupBy(*keys).agg(
        F.any_value("size").alias("size"),
        F.array(*[counted(F.col("x") < F.col("q")[i]) for i in range(k)]).alias("below"),
        F.array(*[counted(F.col("x") <= F.col("q")[k + i]) for i in range(k)]).alias("upto"))

    def wanted(i: int, p: float) -> Column:
        at = (F.col("size") - 1).cast("decimal(20,0)") * F.lit(str(p)).cast("decimal(9,8)")
        low, high = F.floor(at).cast("bigint"), F.ceil(at).cast("bigint")
        return F.struct(F.lit(i).alias("i"), ((F.col("below")[i] <= low) & (F.col("upto")[i] > high)).alias("good"),
                        F.col("below")[i].alias("base"), low.alias("low"), high.alias("high"), (at - F.floor(at)).cast("double").alias("part"))

    ranks = counts.select(*keys, F.explode(F.array(*[wanted(i, p) for i, p in enumerate(ps)])).alias("w")).select(*keys, "w.*")
    numbers = F.array(*[F.lit(i) for i in range(k)])
    inside = joined.select(*keys, "x", "n", F.explode(F.filter(numbers, lambda i: F.col("x").between(F.col("q")[i], F.col("q")[i + k]))).alias("i"))
    found = inside.join(one(ranks.filter("good")), [*keys, "i"])
    missed = values.join(one(ranks.filter("not good").withColumn("base", F.lit(0).cast("bigint"))), keys)
    ahead = Window.partitionBy(*keys, "i").orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum("n").over(ahead), F.lit(0))
    return found.unionByName(missed).withColumn("before", before).select(
        *[F.col("_group")[b].alias(b) for b in by], "i", "x", "n", "before", "low", "high", "part")


def exact_percentiles(df: DataFrame, col: str, ps: Sequence[float], names: Sequence[str], scale: int = 4,
                      by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """The interpolated percentiles ``ps`` of ``col`` (DOUBLE, rounded to ``scale`` decimals), named
    ``names``: one row, or one per group of ``by``.  NULL values are left out; without any value there
    is one row of NULLs, or no row of the group."""
    found = rank_candidates(df, col, ps, by, accuracy)
    found = found.filter(_holds(F.col("low")) | _holds(F.col("high")))

    def value(i: int, rank: str) -> Column:
        return F.max(F.when((F.col("i") == i) & _holds(F.col(rank)), F.col("x")))

    out = []
    for i, name in enumerate(names):
        part = F.max(F.when(F.col("i") == i, F.col("part")))
        out.append(F.round(value(i, "low") + part * (value(i, "high") - value(i, "low")), scale).alias(name))
    return (found.groupBy(*by) if by else found).agg(*out)
