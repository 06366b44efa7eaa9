import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SMALL
from tidewater.llm import suffix_dedup
from tidewater.llm.queries import QUERIES


def brute(rows, length=100):
    """Kept bytes, removed bytes and runs by a dictionary of every window."""
    seen, out = {}, {}
    for i, t in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if seen.setdefault(hash(raw[p:p + length]), (i, p)) != (i, p):
                gone[p:p + length] = b"\1" * length
        runs = sum(1 for k in range(len(raw)) if gone[k] and (not k or not gone[k - 1]))
        out[i] = (len(raw), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest())
    return out


def digests(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept_bytes).hexdigest()) for r in df.collect()}


def test_query_over_the_whole_table(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in QUERIES["op7_suffix_dedup"](spark, SMALL).collect()}
    assert got == brute(rows) and sum(g[1] for g in got.values()) > 0


@pytest.mark.parametrize("seed", range(4))
def test_shared_passages(spark, docs_of, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randrange(10, 90)) for _ in range(6)]
    rows = []
    for i in range(90):
        parts = [prose(rng.randrange(0, 40)) for _ in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            parts.insert(rng.randrange(len(parts) + 1), p[rng.randrange(0, 30):len(p) - rng.randrange(0, 30)])
        rows.append((i * 3, " ".join(parts)))
    rows += [(1, "x" * 700), (2, "ab" * 400), (4, "x" * 99), (5, "ab" * 30 + "x" * 120), (7, None), (8, ""), (1000, rows[5][1]), (1001, rows[5][1])]
    rng.shuffle(rows)
    assert digests(suffix_dedup.suffix_dedup(docs_of(rows).repartition(5))) == brute(rows)


def test_traps(trap_docs):
    out = suffix_dedup.suffix_dedup(trap_docs.withColumn("ord", trap_docs.doc_id).withColumn("raw", trap_docs.doc_id)).collect()
    assert len(out) == trap_docs.count()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in out}
    assert got[2] == got[3] == (0, 0, 0) and got[6][1:] == (got[6][0], 1) and got[5][1] == got[5][0] - 27
    assert got[9] == (5000, 4999, 1)
    assert suffix_dedup.suffix_dedup(trap_docs.limit(0)).count() == 0


def test_front_coding_round_trip_and_merge():
    rng = random.Random(1)
    runs = []
    for _ in range(7):
        runs.append(sorted((bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 12))), b"z" * rng.randrange(3), rng.randrange(9), k)
                           for k in range(rng.randrange(0, 40))))
    assert [[e[1:] for e in suffix_dedup.front_decode(suffix_dedup.front_code(r))] for r in runs] == runs
    merged = list(suffix_dedup.merge_runs([suffix_dedup.front_decode(suffix_dedup.front_code(r)) for r in runs]))
    assert [e[1] for e in merged] == sorted(e[0] for r in runs for e in r)
    for before, e in zip(merged, merged[1:]):
        assert e[0] == suffix_dedup.common_prefix(before[1], e[1])


def test_merge_never_compares_known_prefixes(monkeypatch):
    """Bytes looked at stay below what each entry adds to the one before it, times a small factor."""
    looked = [0]
    real = suffix_dedup.common_prefix

    def counting(a, b, start=0):
        k = real(a, b, start)
        looked[0] += k - start + 1
        return k

    runs = [suffix_dedup.front_code([(b"p" * 90 + bytes([97 + i]) * k, b"", i, k) for k in range(1, 9)]) for i in range(8)]
    monkeypatch.setattr(suffix_dedup, "common_prefix", counting)
    assert len(list(suffix_dedup.merge_runs([suffix_dedup.front_decode(r) for r in runs]))) == 64
    assert looked[0] < 90 * 8 + 64 * 8  # a plain merge would look at 64 * 3 * 90


@pytest.mark.parametrize("hot", [3, 40])
def test_line_that_most_documents_hold(docs_of, monkeypatch, hot):
    """Grams above the bound reach no group, and the result stays exact, also across batches."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    real = suffix_dedup.repeated_spans

    def bounded(group, length):
        assert len(group) <= hot
        return real(group, length)

    monkeypatch.setattr(suffix_dedup, "repeated_spans", bounded)
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line, few = prose(260), prose(150)
    rows = [(i, prose(rng.randrange(90)) + line + prose(rng.randrange(90))) for i in range(300)]
    rows += [(300 + i, prose(50) + few + prose(rng.randrange(30))) for i in range(3)]
    rows += [(400, " ".join(line + str(i) for i in range(50))), (401, "x" * 900), (402, None), (403, line[5:])]
    rng.shuffle(rows)
    assert digests(suffix_dedup.suffix_dedup(docs_of(rows).repartition(7))) == brute(rows)


def test_window_hashes_follow_the_bytes(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 64)
    monkeypatch.setattr(suffix_dedup, "_powers", [])
    buf = np.frombuffer(random.Random(2).randbytes(150) * 4, dtype=np.uint8)
    p = np.arange(len(buf) - 99)
    keys = list(zip(*(h.tolist() for h in suffix_dedup.window_hashes(buf, p, 100))))
    windows = [buf[i:i + 100].tobytes() for i in p]
    assert len(set(keys)) == len(set(windows)) == len(set(zip(keys, windows)))


@pytest.mark.parametrize("hot", [2, 1 << 15])
def test_null_and_repeated_ids_with_different_texts(docs_of, monkeypatch, hot):
    """What one row loses costs no other row of its id; equal places of one id do not match."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rng = random.Random(4)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    whole, line, head = prose(300), prose(120), prose(110)
    clean, other, own = prose(400), prose(400), prose(400)
    rows = [(1, whole), (2, "A" + line + prose(90)), (None, whole), (None, clean), (None, other[:50] + line + other[50:]),
            (7, whole), (7, own), (7, own[:200] + line + "!"), (8, head + "1" + prose(60)), (8, head + "2" + prose(60)), (None, clean), (None, None)]
    out = suffix_dedup.suffix_dedup(docs_of(rows).repartition(3)).collect()
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.kept_bytes.decode()) for r in out)
    want = [(i, t or "", t or "") for i, t in rows[:2] + rows[8:10]] + [
        (None, whole, ""), (None, clean, clean), (None, clean, clean), (None, rows[4][1], other), (None, "", ""),
        (7, whole, ""), (7, own, own), (7, rows[7][1], own[:200] + "!")]
    assert got == sorted((i or 0, len(t), len(t) - len(kept), kept) for i, t, kept in want)


def test_a_worker_needs_little_memory_beside_its_batch():
    """Workers of both cores live beside the executor's heap: anchors of 4 MB of text need some 50 MB at most."""
    import tracemalloc
    texts = [np.random.default_rng(i).integers(97, 123, 10_000, dtype=np.uint8).tobytes() for i in range(400)]
    tracemalloc.start()
    found = sum(len(h) for *_, h in suffix_dedup.anchors(texts, 100))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found > 10_000 and most < 60 << 20
