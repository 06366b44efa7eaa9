import random
import re

import numpy as np
import pytest

from tests.conftest import SMALL
from tidewater.llm import near_dedup
from tidewater.llm.components import components
from tidewater.llm.queries import QUERIES


def brute(rows, percent=75):
    """Components by comparing all pairs of word-shingle sets."""
    sets = {}
    for i, t in rows:
        ws = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        k = min(5, len(ws))
        sets[i] = {tuple(ws[j:j + k]) for j in range(len(ws) - k + 1)} if ws else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for g in by.values() for a in g for b in g if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(out, rows):
    want = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


def test_query_over_the_whole_table(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    check(QUERIES["op4_hyperminhash_dedup"](spark, SMALL).collect(), rows)


def test_chains_stars_and_large_groups(spark, docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(3)
    rows = []
    for base in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(6, 120))]
        for _ in range(25):
            rows.append((len(rows), " ".join(words)))
            words = words[:]
            for _ in range(max(1, len(words) // rng.choice([12, 25, 40]))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"  # each copy drifts from the one before
    rng.shuffle(rows)
    check(near_dedup.near_dedup(docs_of(rows)).collect(), rows)


def test_short_texts_at_the_threshold(spark, docs_of):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        words = [f"v{rng.randrange(8)}" for _ in range(rng.randrange(0, 9))]
        rows.append((i, " ".join(words)))
    check(near_dedup.near_dedup(docs_of(rows)).collect(), rows)


def test_traps(trap_docs):
    out = near_dedup.near_dedup(trap_docs.withColumn("kept", trap_docs.doc_id).withColumn("n", trap_docs.doc_id)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}
    assert len(out) == trap_docs.count()
    assert got[1] == (1, 1, True) and got[4] == (1, 1, False) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[6][1:] == (5, False) and got[7] == (0, 7, True) and got[9] == (1, 9, True) and got[None][1:] == (None, False)
    assert near_dedup.near_dedup(trap_docs.limit(0)).count() == 0


def test_estimate_follows_the_similarity():
    rng = np.random.default_rng(0)
    for n in (3, 30, 300, 3000):
        errors = []
        for _ in range(60):
            pool = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64) << np.uint64(1))
            mixed = rng.permutation(pool)
            a, b = np.sort(mixed[:-(n // 3)]), np.sort(mixed[n // 3:])
            same = (near_dedup.registers(a) == near_dedup.registers(b)).mean()
            both = len(np.intersect1d(a, b))
            errors.append(near_dedup.estimate(np.array([same]), np.array([len(a)]), np.array([len(b)]))[0] - both / len(pool))
        assert abs(np.mean(errors)) < 0.04 and np.std(errors) < 0.09


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    up = {x: x for e in edges for x in e}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.node: r.comp for r in got} == {i: root(i) for i in up}


def test_every_bucket_is_read_and_no_register_twice():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) << np.uint64(1))
    full = near_dedup.registers(hashes)
    for b in range(near_dedup.BUCKETS):
        changed = near_dedup.registers(hashes[hashes >> np.uint64(58) != b]) != full
        assert set(np.flatnonzero(changed)) <= {b}
    assert (near_dedup._DONORS[:, 0] == np.arange(near_dedup.BUCKETS)).all()


def test_low_estimate_does_not_drop_a_link():
    """A pair that shares one band only is still decided by its full sets."""
    words = [f"w{i}" for i in range(60)]
    texts = np.array([" ".join(words), " ".join(words[:52])], dtype=object)
    regs = np.stack([np.arange(64), np.r_[np.arange(3), np.arange(100, 161)]]).astype(np.uint16)
    both = np.arange(2)
    args = both + 5, both, np.array([56, 48]), regs, 0, both, both, texts, 5, 75
    assert near_dedup._cell_links(*args) == [(6, 5)]


def test_the_likeliest_partners_are_verified_first(monkeypatch):
    """Every candidate gets an estimate, and those verified come in its order."""
    words = [f"w{i}" for i in range(60)]
    texts = np.array([" ".join(words), " ".join(words[:50] + ["x"] * 3), " ".join(words[:59])], dtype=object)
    regs = np.stack([np.arange(64), np.r_[np.arange(40), np.arange(100, 124)], np.r_[np.arange(62), 200, 201]]).astype(np.uint16)
    seen, real = [], near_dedup.estimate

    def watched(share, a, b):
        seen.append((share.tolist(), real(share, a, b).tolist()))
        return real(share, a, b)

    monkeypatch.setattr(near_dedup, "estimate", watched)
    three = np.arange(3)
    links = near_dedup._cell_links(three + 5, three, np.array([56, 49, 55]), regs, 0, three, three, texts, 5, 75)
    assert links[0] == (7, 5) and links[1] == (6, 5) and len(links) == 2
    assert seen[0][0] == [40 / 64, 62 / 64] and seen[0][1][0] < seen[0][1][1]


def test_a_leader_that_many_members_meet(spark, docs_of, monkeypatch):
    monkeypatch.setattr(near_dedup, "SHARE", 8)
    rng = random.Random(11)
    base = [f"w{rng.randrange(400)}" for _ in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, 260):  # each an edit of the same text, so that its bucket and its component are hot
        words = base[:]
        words[rng.randrange(90)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, f"other {i} text of its own") for i in range(40)]
    check(near_dedup.near_dedup(docs_of(rows)).collect(), rows)


def test_components_of_a_star_and_a_chain_to_it(spark):
    edges = [(5, x) for x in range(100, 4100)] + [(x, x + 1) for x in range(4099, 4130)] + [(3, 4130), (9000, 9001)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got.pop(9000) == got.pop(9001) == 9000
    assert set(got.values()) == {3} and len(got) == 4000 + 31 + 2


def test_words_that_a_worker_keeps_are_bounded():
    near_dedup._word_hash.clear()
    for i in range(300):
        near_dedup.shingles(" ".join(f"w{j}" for j in range(i * 1000, (i + 1) * 1000)))
    assert len(near_dedup._word_hash) <= (1 << 17) + 1000
    near_dedup._word_hash.clear()
