"""The most frequent triples equal an expansion of all triples, which large baskets never need."""

import random
from collections import Counter
from itertools import combinations

import pytest

from tidewater.functions.itemsets import basket_pairs, frequent_triples, smallest_triples, top_triples


def _brute(rows, k):
    baskets = {}
    for b, i in rows:
        if b is not None and i is not None:
            baskets.setdefault(b, set()).add(i)
    n = Counter(t for items in baskets.values() for t in combinations(sorted(items), 3))
    return sorted(((*t, c) for t, c in n.items()), key=lambda r: (-r[3], r[:3]))[:k]


def _rows(seed, baskets, items, skew):
    rnd = random.Random(seed)
    return [(b, min(int(rnd.expovariate(skew)), items - 1)) for b in range(baskets) for _ in range(rnd.randint(1, 9))]


@pytest.mark.parametrize("seed, baskets, items, skew, k", [(1, 60, 30, 0.2, 1), (2, 60, 30, 0.2, 7), (3, 25, 400, 0.004, 5), (4, 4, 6, 0.3, 50),
                                                           (5, 2, 3, 0.5, 3)])
def test_matches_all_triples(spark, seed, baskets, items, skew, k):
    rows = _rows(seed, baskets, items, skew) + [(0, None), (None, 1), (0, 0), (0, 0)]
    df = spark.createDataFrame(rows, "t int, p int")
    assert [tuple(r) for r in top_triples(df, "t", "p", k, block=3, step=3).collect()] == _brute(rows, k)


def test_small_baskets_are_counted_in_one_pass(spark, monkeypatch):
    """Few triples for each row: no support is tried, and both ways agree."""
    rows = _rows(5, 80, 50, 0.1) + [(0, None), (None, 1), (0, 0), (0, 0)]
    df = spark.createDataFrame(rows, "t int, p int")
    by_support = [tuple(r) for r in top_triples(df, "t", "p", 6, linear=0).collect()]
    monkeypatch.setattr("tidewater.functions.itemsets.frequent_triples", None)
    assert [tuple(r) for r in top_triples(df, "t", "p", 6).collect()] == by_support == _brute(rows, 6)


def test_no_triples(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 3)], "t int, p int")
    assert top_triples(df, "t", "p", 3).collect() == [] and top_triples(df.limit(0), "t", "p", 3).collect() == []


def test_a_basket_of_thousands_of_products(spark):
    """3000 products have 4.5 billion triples; only items, pairs and triples that two baskets hold are formed."""
    small = _rows(9, 150, 40, 0.15)
    rows = [(10_000, i) for i in range(3000)] + small
    df = spark.createDataFrame(rows, "t int, p int")
    inside = [(10_000, i) for i in range(40)] + small  # items that no other basket holds can only tie at one
    got = [tuple(r) for r in top_triples(df, "t", "p", 5).collect()]
    assert got == _brute(inside, 5) and got[-1][3] > 1
    one = df.selectExpr("t as basket", "p as item").distinct()
    assert frequent_triples(one, 4).count() == len([r for r in _brute(inside, 10 ** 9) if r[3] >= 4])
    assert [tuple(r) for r in smallest_triples(one.filter("basket = 10000"), 3).collect()] == [(0, 1, 2), (0, 1, 3), (0, 1, 4)]


def test_pairs_in_cells_are_all_pairs(spark):
    df = spark.createDataFrame([(1, i) for i in range(100)] + [(2, 5), (2, 7), (3, 1)], "basket int, item int")
    want = sorted([(1, *p) for p in combinations(range(100), 2)] + [(2, 5, 7)])
    for block in (1, 7, 256):
        assert sorted(map(tuple, basket_pairs(df, block).collect())) == want
