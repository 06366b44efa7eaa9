"""Joins that do not put a hot key in one task."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.common import grand

#: A key with more than one part in this of all rows is hot; there are fewer hot keys than that.
HOT_SHARE = 1000


def join_by_share(rows: DataFrame, side: DataFrame, keys: Sequence[str], size: str, share: int = HOT_SHARE) -> DataFrame:
    """``rows`` inner-joined on ``keys`` with ``side``, which has one row per key and in ``size`` the weight
    of that key (its number of rows, or a bound in proportion).

    The keys that hold more than 1 / ``share`` of all weight, fewer than ``share`` of them, are broadcast,
    so their rows stay where they are; all other keys are small and are shuffled.
    """
    keys = list(keys)
    bound = grand(side, F.sum(size) / share)
    hot = F.broadcast(side.filter(F.col(size) > bound))
    rest = rows.join(hot, keys, "left_anti").join(side.filter(F.col(size) <= bound), keys)
    return rows.join(hot, keys).unionByName(rest)
