import numpy as np

from tests.conftest import SMALL
from tidewater.llm import vector_search
from tidewater.llm.queries import QUERIES


def brute(rows, queries, k=10):
    """Exact neighbours of sound vectors."""
    rows = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids])
    out = {}
    for q in queries:
        if q in rows:
            d = np.sqrt(((x - rows[q]) ** 2).sum(axis=1))
            out[q] = [(int(ids[j]), float(d[j])) for j in np.lexsort((ids, d)) if ids[j] != q][:k]
    return out


def recall(rows, want, k=10):
    got = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(want)
    hit = total = 0
    for q, near in want.items():
        assert got[q] == sorted(got[q], key=lambda x: (x[1], x[0])) and q not in dict(got[q]) and len(got[q]) == len(near)
        exact = dict(near)
        for i, s in got[q]:
            assert i not in exact or abs(exact[i] - s) < 1e-12
        hit += len(set(dict(got[q])) & set(exact))
        total += len(near)
    return hit / total


def test_recall_over_the_whole_table(spark, duck):
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert recall(QUERIES["op8_multiprobe_lsh"](spark, SMALL).collect(), want) >= 0.9


def test_recall_and_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(vector_search, "BLOCK", 200)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + 0.3 * rng.normal(size=16)).tolist()) for i in range(3000)]
    rows += [(i, rows[5][1]) for i in range(3000, 4500)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = [i for i, _ in rows if i % 50 == 0]
    out = vector_search.nearest(df, df.filter("vec_id % 50 = 0")).collect()
    assert recall(out, brute(rows, queries)) >= 0.9
    hot = [r.vec_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == 3050]
    assert hot == [5, *range(3000, 3009)]


def test_traps(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [2.0, 0.0]), (8, [1.0]), (None, [1.0, 0.0]), (100, [1.0, 0.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rid", vector_search.F.lit(1))
    out = vector_search.nearest(df, df.filter("vec_id % 100 = 0")).collect()
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in out}
    assert got == {(0, 1): (100, 0.0), (0, 2): (6, 1.0), (0, 3): (7, 1.0), (100, 1): (0, 0.0), (100, 2): (6, 1.0), (100, 3): (7, 1.0)}
    assert vector_search.nearest(df.limit(0), df.limit(0)).count() == 0


def test_probes_come_in_order_of_success():
    x = np.random.default_rng(0).normal(size=(400, 8))
    hashing = vector_search.fit(x, 10, 400)
    probes = list(hashing._perturbed(int(hashing.keys(np.floor(hashing.cells(x)))[0, 0]), np.array([0.1, 0.5, 0.8, 0.3, 0.9, 0.4]), 6))
    assert [p[0] for p in probes] == sorted(p[0] for p in probes)
    assert len({p[1] for p in probes}) == len(probes) == 3**6


def test_queries_far_from_the_mass_are_answered_in_full(spark):
    """Some queries lie fifteen times further out, others in a small cluster of other norms."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=16) * (15 if i in (0, 1000, 2000) else 0.01 if i % 700 == 3 else 1)).tolist()) for i in range(2999)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    queries = [i for i, _ in rows if i % 100 == 0 or i % 700 == 3]
    out = vector_search.nearest(df, df.filter("vec_id % 100 = 0 or vec_id % 700 = 3")).collect()
    want = brute(rows, queries)
    assert len(out) == 10 * len(queries) and recall(out, want) >= 0.9
    for q in (0, 1000, 2000):
        assert [r.vec_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] == [i for i, _ in want[q]]


def test_few_vectors_are_searched_in_full(spark):
    rows = [(i, [float(i), 1.0, -2.0 * i]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = vector_search.nearest(df, df).collect()
    assert recall(out, brute(rows, range(12))) == 1.0


def test_far_cells_have_keys_of_their_own():
    x = np.random.default_rng(0).normal(size=(50, 8))
    hashing = vector_search.fit(x, 5)
    cells = np.floor(hashing.cells(np.concatenate([x, x * 1e6, x * 1e9])))
    assert len(np.unique(hashing.keys(cells)[:, 0])) == len(np.unique(cells[:, 0], axis=0))
    one = hashing.cells(x[:1])
    near = dict((key, score) for score, key in hashing._perturbed(int(hashing.keys(np.floor(one))[0, 1]), (one - np.floor(one))[0, 1], 6, 1))
    for f in range(6):
        moved = np.floor(one)
        moved[0, 1, f] += 1
        assert int(hashing.keys(moved)[0, 1]) in near
