import numpy as np
import pytest

from tidewater.llm import passage_dedup as pd
from tidewater.llm.passage_dedup import FMIndex, LevelTable, WaveletTree, Words, anchors, repeated_windows, run_hashes


def brute(docs, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in docs]
    for i, w in split:
        for p in range(len(w) - window + 1):
            k = tuple(w[p:p + window])
            first[k] = min(first.get(k, 1 << 62), 1 << 62 if i is None else i)
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (1 << 62 if i is None else i):
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def check(rows, docs, window):
    got = rows.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute(docs, window)
    for r in got:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:]))


def corpus(seed, n=60):
    """Documents that share passages whole, cut and overlapping, between words of their own or of few."""
    rng = np.random.default_rng(seed)
    passages = [[f"p{k}w{j}" if k % 3 else "ab"[j % 7 % 2] for j in range(int(rng.integers(20, 70)))] for k in range(6)]
    docs = []
    for i in rng.permutation(n).tolist():
        words = []
        for _ in range(int(rng.integers(0, 6))):
            if rng.random() < 0.5:
                p = passages[int(rng.integers(len(passages)))]
                a = int(rng.integers(0, 10))
                words += p[a:a + int(rng.integers(5, 70))]
            words += [f"{'own' + str(i) if rng.random() < 0.5 else 'c'}{int(x)}" for x in rng.integers(0, 3, int(rng.integers(0, 30)))]
        docs.append((i, rng.choice([" ", "\n", " \t\x0b"]).join(words)))
    return docs


@pytest.mark.parametrize("seed, window, often, shard_words", [(0, 17, 1 << 30, 1 << 18), (1, 20, 0, 500), (2, 20, 3, 200), (3, 50, 5, 1 << 18),
                                                              (4, 17, 2, 1), (5, 31, 1 << 30, 300)])
def test_matches_brute_force(spark, docs_of, seed, window, often, shard_words):
    docs = corpus(seed)
    check(pd.passage_dedup(docs_of(docs), window, often, shard_words), docs, window)


def test_traps(docs_of, trap_docs):
    run = " ".join(f"w{i}" for i in range(60))
    docs = [(r.doc_id, r.text) for r in trap_docs.collect()]
    docs += [(20, run), (20, "x " + run), (21, run + " end"), (None, run), (None, run + " y"), (None, run), (20, run), (-5, "z " + run.replace("w59", "q")),
             (30, "é" + "a" * 300 + " " + run), (31, "same " * 300), (32, "same " * 120), (33, "w0 " * 49), (34, "w0 " * 49)]
    df = docs_of(docs).selectExpr("*", "1 as ord", "2 as t", "3 as raw", "4 as hs")
    check(pd.passage_dedup(df), docs, 50)
    check(pd.passage_dedup(df, often=1, shard_words=100), docs, 50)


def test_empty_table(trap_docs):
    assert pd.passage_dedup(trap_docs.limit(0)).count() == 0
    assert pd.passage_dedup(trap_docs.filter("doc_id < 4")).count() == 3


def test_a_passage_that_most_documents_hold(docs_of):
    passage = " ".join(f"w{i}" for i in range(80))
    docs = [(i, f"{' '.join(f'd{i}x{k}' for k in range(30))} {passage} {' '.join(f'd{i}y{k}' for k in range(30))}") for i in range(300)]
    rows = pd.passage_dedup(docs_of(docs), often=10).collect()
    assert {r.n_removed for r in rows if r.doc_id} == {80} and [r.n_removed for r in rows if r.doc_id == 0] == [0]


@pytest.mark.parametrize("seed", range(6))
def test_index_matches_scans(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 9))
    strings = [rng.integers(1, n, rng.integers(0, 30)) for _ in range(int(rng.integers(1, 30)))]
    strings[0] = np.r_[strings[0], np.arange(1, n)]  # every symbol occurs
    owner = rng.integers(0, 10, len(strings))
    text = np.concatenate([np.r_[s, 0] for s in strings])
    size = np.array([len(s) for s in strings])
    first = np.cumsum(size + 1) - size - 1
    index = FMIndex(text, np.repeat(owner, size + 1), n)
    asked = rng.integers(0, 12, len(strings))
    for most in (3, 100):
        length, least = index.statistics(text, first, size, asked, most)
        for k, s in enumerate(strings):
            for p in range(len(s)):
                want, who = 0, None
                for m in range(1, min(most, len(s) - p) + 1):
                    have = [o for t, o in zip(strings, owner) if any((t[q:q + m] == s[p:p + m]).all() for q in range(len(t) - m + 1))]
                    if min(have) >= asked[k]:
                        break
                    want, who = m, min(have)
                assert length[first[k] + p] == want and (who is None or least[first[k] + p] == who)


def test_wavelet_tree_and_table():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 200):
        seq = np.r_[np.arange(n), rng.zipf(1.5, 2000) % n].astype(np.int64)
        tree = WaveletTree(seq, n)
        s, i = rng.integers(0, n, 300), rng.integers(0, len(seq) + 1, 300)
        a, b = tree.rank(s, np.zeros(300, np.int64), i)
        assert (a == 0).all() and b.tolist() == [int((seq[:j] == x).sum()) for x, j in zip(s, i)]
    values = rng.integers(0, 5, 77)
    table = LevelTable(values)
    for at in range(77):
        for bound in range(6):
            left = max((j for j in range(at + 1) if values[j] < bound), default=-1)
            right = min((j for j in range(at, 77) if values[j] < bound), default=77)
            assert table.below_left(np.array([at]), np.array([bound]))[0] == left
            assert table.below_right(np.array([at]), np.array([bound]))[0] == right
        assert table.least(np.array([0]), np.array([at + 1]))[0] == values[:at + 1].min()


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    words = [f"w{x}" for x in rng.integers(0, 3, 400)]
    texts = [" ".join(words), "own words " + " ".join(words[100:220]), "x", "", " ".join(words[90:300]) + " y"]
    w = Words([t.encode() for t in texts])
    assert w.counts.tolist() == [len(t.split()) for t in texts]
    seen = {}
    doc, at, first, last, h = anchors(w, 50, 16)
    covered = np.zeros(len(w.hashes), int)
    for d, a, lo, hi, k in zip(doc, at, first, last, h):
        covered[lo:hi + 1] += 1
        for p in range(lo, hi + 1):
            assert seen.setdefault(w.span(p, p + 50), (a - p, k)) == (a - p, k)
    assert (covered == [int(p + 49 < len(w.doc) and w.doc[p] == w.doc[p + 49]) for p in range(len(w.doc))]).all()
    runs = run_hashes(w.hashes, 7)
    assert len({(w.span(p, p + 7), int(runs[p])) for p in range(len(runs))}) == len({w.span(p, p + 7) for p in range(len(runs))})


def test_smallest_holder_of_a_window_not_of_a_longer_match():
    run = [b"w%d" % i for i in range(60)]
    contexts = [b" ".join(run), b" ".join(run[:55] + [b"x"] * 5), b" ".join(run[:51])]
    found = list(repeated_windows(contexts, np.array([4, 5, 2]), np.array([9, 5, 2]), 50))
    assert found == [(0, 0, 1, 2), (0, 2, 10, 4), (1, 0, 1, 2), (1, 2, 5, 4)]
