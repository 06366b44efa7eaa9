"""The interval join equals a nested loop over all pairs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.functions.intervals import dyadic_cover, interval_join, interval_pairs


def _brute(points, intervals, null_is_open=True):
    out = []
    for p in points:
        for i in intervals:
            if p[1] is None or (not null_is_open and None in i[1:]):
                continue
            if (i[1] is None or i[1] <= p[1]) and (i[2] is None or p[1] <= i[2]):
                out.append((*p, *i))
    return out


def _same(df, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, df.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("lo, hi", [(0, 0), (0, 1), (1, 6), (5, 5), (3, 100), (-7, 9), (-100, -3), (0, 127), (1, 128), (9, 8), (-(1 << 23), (1 << 23) - 1)])
def test_cover_is_exact_and_short(spark, lo, hi):
    nodes = spark.range(1).select(F.explode(dyadic_cover(F.lit(lo).cast("bigint"), F.lit(hi).cast("bigint"), 24)).alias("n")).select("n.*").collect()
    spans = sorted((n << level, ((n + 1) << level) - 1) for level, n in nodes)
    assert len(spans) <= 2 * max(1, (hi - lo + 1).bit_length())
    if lo > hi:
        assert not spans
        return
    assert spans[0][0] == lo and spans[-1][1] == hi
    assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))


def _intervals(rnd, n, at):
    """Open, touching, overlapping, single-step, reversed and ordinary intervals."""
    rows = [(0, None, None), (1, at(0), None), (2, None, at(0)), (3, at(5), at(5)), (4, at(5), at(9)), (5, at(9), at(20)), (6, at(10), at(3))]
    for i in range(n):
        a, b = rnd.randint(-400, 400), rnd.randint(0, 300)
        rows.append((10 + i, at(a), at(a + b)))
    return rows


@pytest.mark.parametrize("null_is_open", [True, False])
@pytest.mark.parametrize("kind", ["bigint", "int", "date", "timestamp_ntz", "double", "decimal(10,2)"])
def test_matches_a_nested_loop(spark, kind, null_is_open):
    rnd = random.Random(kind)
    day = {"date": lambda x: dt.date(2024, 1, 1) + dt.timedelta(days=x),
           "timestamp_ntz": lambda x: dt.datetime(2024, 1, 1, 11, 30) + dt.timedelta(hours=7 * x)}
    at = day.get(kind, (lambda x: x / 4) if kind == "double" else (lambda x: x))
    points = [(i, at(rnd.randint(-500, 500))) for i in range(150)] + [(900, None), (901, at(5)), (901, at(5)), (902, at(9))]
    intervals = _intervals(rnd, 40, at)
    if kind == "date":
        intervals.append((99, dt.date(2024, 2, 1), dt.date(9999, 12, 31)))
    p = spark.createDataFrame(points, f"id int, x {kind if 'decimal' not in kind else 'int'}")
    i = spark.createDataFrame(intervals, f"iv int, s {kind if 'decimal' not in kind else 'int'}, e {kind if 'decimal' not in kind else 'int'}")
    if "decimal" in kind:
        p, i = p.withColumn("x", F.col("x").cast(kind)), i.withColumn("s", F.col("s").cast(kind)).withColumn("e", F.col("e").cast(kind))
    _same(interval_join(p, i, "x", "s", "e", null_is_open=null_is_open), _brute(points, intervals, null_is_open))


def test_left_join_and_kept_points(spark):
    points = [(1, 5), (2, 50), (3, None), (None, 7), (4, 5)]
    intervals = [(10, 0, 6), (11, 5, 7), (12, 60, None)]
    p = spark.createDataFrame(points, "id int, x bigint")
    i = spark.createDataFrame(intervals, "iv int, s bigint, e bigint")
    pairs = _brute(points, intervals)
    none = (None, None, None)
    _same(interval_join(p, i, "x", "s", "e", "left", key=["id"]), pairs + [(*q, *none) for q in points if not [r for r in pairs if r[:2] == q]])
    _same(interval_pairs(p, i, "x", "s", "e", keep_points=True), pairs + [(*q, *none) for q in points])
    _same(interval_join(p, i.limit(0), "x", "s", "e", "left", key=["id"]), [(*q, *none) for q in points])
    _same(interval_join(p, i.limit(0), "x", "s", "e"), [])
    with pytest.raises(ValueError):
        interval_join(p, i, "x", "s", "e", "left")


def test_an_open_end_costs_no_row_a_day(spark):
    i = spark.createDataFrame([(1, dt.date(2024, 1, 12), dt.date(9999, 12, 31))], "iv int, s date, e date")
    start, end = F.unix_date("s").cast("bigint"), F.unix_date("e").cast("bigint")
    assert i.select(F.size(dyadic_cover(start, end, 24))).first()[0] <= 48
