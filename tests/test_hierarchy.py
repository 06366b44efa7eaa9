"""Flattened hierarchies of any depth, with orphans and cycles."""

import random

import pytest

from tidewater.functions.hierarchy import flatten_hierarchy


def _brute(rows):
    parent = {}
    for i, p in rows:
        if i is not None:
            parent[i] = p if parent.get(i) is None else min(x for x in (parent[i], p) if x is not None)
    out = {}
    for i in parent:
        path, at, seen = [i], i, {i}
        while parent[at] is not None and parent[at] in parent and parent[at] not in seen:
            at = parent[at]
            path.append(at)
            seen.add(at)
        if parent[at] is not None and parent[at] in seen:
            out[i] = (parent[i], None, None, "cycle", None)
        else:
            out[i] = (parent[i], at, len(path) - 1, "ok" if parent[at] is None else "orphan", path[::-1])
    return out


def _check(spark, rows):
    df = spark.createDataFrame(rows, "id int, parent_id int")
    got = {r.id: tuple(r)[1:] for r in flatten_hierarchy(df).collect()}
    assert got == _brute(rows)


def test_depth_six_a_cycle_and_an_orphan(spark):
    chain = [(1, None), *((i, i - 1) for i in range(2, 8))]
    _check(spark, chain + [(10, 11), (11, 12), (12, 10), (13, 12), (20, 99), (21, 20), (30, 30), (None, 1), (None, None), (7, 6), (40, None), (40, 1)])


@pytest.mark.parametrize("seed", range(3))
def test_random_forests(spark, seed):
    rnd = random.Random(seed)
    _check(spark, [(i, rnd.choice([None, rnd.randrange(120), rnd.randrange(i + 1), max(0, i - 1), 500])) for i in range(100)])


def test_a_long_chain_takes_few_rounds_and_a_hot_parent_is_fine(spark):
    _check(spark, [(i, i - 1 if i else None) for i in range(70)] + [(1000 + i, 0) for i in range(2000)])


def test_empty_and_labels(spark):
    df = spark.createDataFrame([(1, None, "top"), (2, 1, "middle"), (3, 2, None)], "node int, up int, name string")
    rows = {r.node: r for r in flatten_hierarchy(df, "node", "up", "name").collect()}
    assert rows[3].labels == ["top", "middle", None] and rows[3].path == [1, 2, 3] and rows[2].depth == 1
    assert flatten_hierarchy(df.limit(0), "node", "up").collect() == []
