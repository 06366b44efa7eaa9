"""Building blocks shared by the operators: ranking, shares, percentages,
null-token cleaning and date helpers.  All are built-in Spark expressions,
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ColumnLike = str | Column

# Text that stands for "no value" in the raw order/delivery tables.
NULL_TOKENS = ("null", "", " ", "NaN")


def c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nullify_tokens(col: ColumnLike, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text, or NULL when the text is NULL or one of the null tokens."""
    t = F.trim(c(col))
    # isin() of NULL is NULL, so NULL input stays NULL; ``t`` is referenced twice only.
    return F.when(~t.isin(*sorted({s.strip() for s in tokens})), t)


_TS_TEXT = r"^\s*(\d{4})-(\d{1,2})-(\d{1,2})[ T](\d{1,2}):(\d{1,2}):(\d{1,2}(\.\d+)?)\s*$"


def parse_timestamp_ntz(col: ColumnLike) -> Column:
    """'yyyy-MM-dd HH:mm:ss' text -> TIMESTAMP_NTZ without any time-zone
    conversion; malformed text or an impossible date gives NULL."""
    part = [F.regexp_extract(c(col), _TS_TEXT, i) for i in range(1, 7)]
    return F.try_make_timestamp_ntz(*[p.try_cast("int") for p in part[:5]], part[5].try_cast("decimal(16,6)"))


def _dec(x: ColumnLike) -> Column:
    # decimal(24,4): exact for counts, cents and tenths; the quotient of two
    # such values keeps 10 decimals, so rounding it to 2 is exact half-up.
    return c(x).cast("decimal(24,4)")


def ratio(num: ColumnLike, den: ColumnLike, scale: int = 2) -> Column:
    """num / den in decimal arithmetic, rounded half-up, as DOUBLE.

    ``try_divide`` gives NULL on a zero denominator instead of failing the
    job under ANSI mode.
    """
    return F.round(F.try_divide(_dec(num), _dec(den)), scale).cast("double")


def pct(num: ColumnLike, den: ColumnLike, scale: int = 2) -> Column:
    """100 * num / den in decimal arithmetic, rounded half-up, as DOUBLE."""
    return F.round(F.try_divide(_dec(num) * 100, _dec(den)), scale).cast("double")


def avg_round(col: ColumnLike, scale: int = 2) -> Column:
    """Exact average (decimal sum / count) rounded half-up, as DOUBLE."""
    return ratio(F.sum(_dec(col)), F.count(c(col)), scale)


def rounded(col: ColumnLike, scale: int = 2) -> Column:
    """Round a (decimal or integral) value half-up and return DOUBLE."""
    return F.round(c(col).cast("decimal(38,6)"), scale).cast("double")


def ranked(df: DataFrame, partition: Iterable[ColumnLike], order: Sequence[Column],
           kind: str = "dense_rank", name: str = "rnk") -> DataFrame:
    """Add a rank column over ``partition`` ordered by ``order``."""
    fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[kind]
    w = Window.partitionBy(*[c(p) for p in partition]).orderBy(*order)
    return df.withColumn(name, fn().over(w))


def top_per_group(df: DataFrame, partition: Iterable[ColumnLike], order: Sequence[Column],
                  n: int = 1, kind: str = "dense_rank") -> DataFrame:
    """Rows ranked within the first ``n`` per group (ties kept unless row_number).

    A filter on a rank lets Catalyst insert a WindowGroupLimit on the map
    side of the shuffle, so a hot group arrives pre-trimmed.
    """
    return ranked(df, partition, order, kind, "_rnk").filter(F.col("_rnk") <= n).drop("_rnk")


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """Global top-k: sort + limit plans as TakeOrderedAndProject (k rows per task)."""
    return df.orderBy(*order).limit(k)


def grand(df: DataFrame, expr: Column) -> Column:
    """An aggregate over all of ``df`` as a scalar-subquery column.

    Planned as an uncorrelated scalar subquery that runs once (partial +
    final aggregate); no window without partition, no cross join.
    """
    return df.agg(expr).scalar()
