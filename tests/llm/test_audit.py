from fractions import Fraction
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tidewater.llm import filter_audit
from tidewater.llm.filter_audit import kernel, shapley_operator, solve

LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """Every order applied document by document."""
    texts = [(i, t or "", s or "") for i, t, s in docs]
    fails = []
    for i, t, _ in texts:
        w = t.encode().split()
        caps = sum("A" <= c <= "Z" for c in t)
        fails.append({"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * caps > 5 * len(t),
                      "D": any(c in "#$%&*|" for c in t),
                      "E": i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)})
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out, shapley = {}, {}
    for part in {s for _, _, s in texts}:
        mine = [k for k in range(len(texts)) if texts[k][2] == part]
        for order in permutations("ABCDE"):
            alive = list(mine)
            for step, f in enumerate(order, 1):
                gone = [k for k in alive if fails[k][f]]
                alive = [k for k in alive if not fails[k][f]]
                failing = [k for k in mine if fails[k][f]]
                only = [k for k in failing if sum(fails[k].values()) == 1]
                out[part, "".join(order), step] = (len(alive), len(gone), len(failing) - len(gone), len(only),
                                                   sum(texts[k][0] in good for k in gone), sum(texts[k][0] in toxic for k in gone))
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {(p, o, s, *v, shapley[p, o[s - 1]]) for (p, o, s), v in out.items()}


def test_matches_brute_force_with_traps(spark):
    long = " ".join(f"word{i}" for i in range(60))
    docs = [(1, long, "a"), (2, long, "a"), (3, long, None), (4, "same " * 70, "a"), (5, "AB cd", "b"), (6, None, "b"), (7, "", "b"),
            (8, "x # y", ""), (9, "\x0b\x0c \t", "c"), (10, "ÀÉ É x " * 30, "c"), (None, long, "a"), (None, None, "b"), (2, long, "c"),
            (2, "short", "a"), (12, "LOUD | " + long * 40, "a"), (13, "😀" * 3 + "A", "c"), (14, long.upper(), "c")]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, None, 1), (None, 1, 1), (99, 1, 1), (12, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    for extra in ("part", "mask", "good", "n", "digest"):
        df = df.withColumn(extra, F.lit("x"))
    rows = filter_audit.filter_audit(df, spark.createDataFrame(labels, LABELS).withColumn("text", F.lit(1)))
    assert rows.columns == filter_audit.NAMES
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, labels)


def test_empty_tables(spark, trap_docs):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.filter_audit(trap_docs.limit(0), none).count() == 0
    rows = filter_audit.filter_audit(trap_docs, none).collect()
    assert len(rows) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in rows)
    assert {r.kept + r.removed + r.redundant for r in rows if r.step == 1} == {trap_docs.count()}


def test_other_filters(spark, trap_docs):
    few = {"S": filter_audit.symbols}
    rows = filter_audit.filter_audit(trap_docs, spark.createDataFrame([], LABELS), filters=few, duplicate="D").collect()
    assert {(r.filter_order, r.step) for r in rows} == {("SD", 1), ("SD", 2), ("DS", 1), ("DS", 2)}


@pytest.mark.parametrize("m", [2, 3, 4, 5])
def test_least_squares_gives_the_average_over_orders(m):
    v = [0] + [(s * 7919 % 101) + 3 * s.bit_count() for s in range(1, 1 << m)]
    want = []
    for i in range(m):
        total = Fraction()
        orders = list(permutations(range(m)))
        for o in orders:
            before = sum(1 << x for x in o[:o.index(i)])
            total += v[before | 1 << i] - v[before]
        want.append(total / len(orders))
    assert [sum(x * y for x, y in zip(line, v[1:])) for line in shapley_operator(m)] == want
    assert kernel(5, 1) == kernel(5, 4) == Fraction(1, 5)


def test_solve():
    a = [[Fraction(0), Fraction(2)], [Fraction(3), Fraction(1)]]
    assert solve(a, [[Fraction(4)], [Fraction(5)]]) == [[Fraction(1)], [Fraction(2)]]
