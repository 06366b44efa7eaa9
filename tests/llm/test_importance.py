import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewater.llm import importance
from tidewater.llm.importance import BLOCK, PositionTable, importance_resample


@pytest.mark.parametrize("block", [1, 3, BLOCK])
def test_checksums_of_every_length(block):
    rng = np.random.default_rng(block)
    spans = [rng.integers(0, 256, n, dtype=np.uint8).tobytes() for n in [*range(0, 200), 1000, 64, 65, 128, 4097]]
    got = PositionTable(block).crc(np.frombuffer(b"".join(spans), np.uint8), np.array([len(s) for s in spans]))
    assert got.tolist() == [zlib.crc32(s) for s in spans]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="aB1 é\x00#中zZ", max_size=200), max_size=8), st.integers(1, 3), st.integers(0, 2))
def test_features_match_the_definition(texts, lo, more):
    got, words = Counter(), None
    for doc, found in importance.features([t.encode() for t in texts], lo, lo + more, 97, TABLE):
        if found is None:
            words = doc.tolist()
        else:
            got.update(zip(doc.tolist(), found.tolist()))
    want = Counter()
    split = [words_of(t) for t in texts]
    for d, w in enumerate(split):
        for n in range(lo, lo + more + 1):
            want.update((d, zlib.crc32(" ".join(w[i:i + n]).encode()) % 97) for i in range(len(w) - n + 1))
    assert got == want and words == [len(w) for w in split]


TABLE = PositionTable()


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, target, hi, buckets, percent, least, seed):
    def feats(t):
        w = words_of(t)
        return [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, hi + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(feats(x))
    for x in target:
        t.update(feats(x))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        f = feats(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words_of(x)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(fit[:len(fit) * percent // 100], 1):
        r[5] = k
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("hi, percent", [(1, 10), (2, 50), (3, 100)])
def test_matches_brute_force(spark, trap_docs, hi, percent):
    rng = np.random.default_rng(7)
    docs = [tuple(r)[:2] for r in trap_docs.collect()]
    docs += [(100 + i, " ".join(rng.choice(["Alpha", "beta", "Öl", "x9", "gamma-ray", "a" * 70], rng.integers(0, 60)))) for i in range(150)]
    docs += [(400, docs[-1][1])] * 3 + [(None, "alpha beta " * 15)] * 40
    target = ["alpha beta beta", None, "", "Öl x9"]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as score", "2 as `rank`", "3 as raw")
    rows = importance_resample(df, spark.createDataFrame([(t,) for t in target], "text string"), hi=hi, buckets=50, percent=percent)
    assert rows.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, rows.collect()), key=str) == brute(docs, target, hi, 50, percent, 20, 2024)


def test_empty_tables(spark, trap_docs):
    none = trap_docs.limit(0)
    assert importance_resample(none, trap_docs).count() == 0
    rows = importance_resample(trap_docs, none).collect()
    assert len(rows) == trap_docs.count() and all(r.weight == 0 for r in rows if r.n_features == 0)
    assert all(r["rank"] is None for r in importance_resample(trap_docs, none, least_words=10 ** 9).collect())


def test_equal_rows_are_ranked_apart(spark):
    rows = spark.range(500).selectExpr("cast(7 as bigint) doc_id", "repeat('word ', 30) text")
    got = importance_resample(rows, rows.limit(1), percent=20).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 101))
