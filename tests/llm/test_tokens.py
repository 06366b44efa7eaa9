"""Token counts, encoding and packing against the library that reads the vocabulary files."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tidewater.llm import bytebpe, packing, token_counts, wordbpe
from tidewater.llm.queries import QUERIES

WORD, BYTE = wordbpe.default_tokenizer(), bytebpe.default_tokenizer()


@pytest.fixture(scope="module")
def fuzz():
    random.seed(7)
    near = "abcABC  \n\t'sté'llİΣσ1२½<|endoftext|>.,!?_-中文ǅ\x1c\x85\xa0 😀ﬀ²ª"
    out = ["".join(random.choice(near) for _ in range(random.randint(0, 60))) for _ in range(1500)]
    far = [random.choice([(32, 126), (0x80, 0x2fff), (0, 0x1ffff)]) for _ in range(40_000)]
    chars = "".join(chr(random.randint(*r)) for r in far).encode("utf-8", "ignore").decode()
    return out + [chars[i:i + 40] for i in range(0, len(chars), 40)] + ["ab" * 3000, " " * 300 + "x"]


def test_counts_equal_the_library(fuzz):
    count = wordbpe.WordCounter(WORD).count
    want = [len(e.ids) for e in Tokenizer.from_file(WORD).encode_batch(fuzz, add_special_tokens=False)]
    assert [count(t) for t in fuzz] == want


def test_word_ids_equal_the_library(fuzz):
    encode = wordbpe.WordEncoder(WORD).encode
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in Tokenizer.from_file(WORD).encode_batch(fuzz, add_special_tokens=False)]
    assert [encode(t) for t in fuzz] == want


def test_trie_equals_the_library(fuzz):
    lib = Tokenizer.from_file(BYTE)
    want = [e.ids for e in lib.encode_batch(fuzz, add_special_tokens=False)]
    ids, texts = bytebpe.TrieEncoder(BYTE).round_trip(fuzz)
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in ids] == want
    assert texts == [lib.decode(w, skip_special_tokens=False) for w in want]


def test_merging_takes_the_lowest_rank_first():
    pairs = {(1, 2): (1, 12), (2, 3): (0, 23), (1, 23): (2, 123)}
    assert wordbpe.count_after_merges([1, 2, 3], pairs) == 1
    assert wordbpe.count_after_merges([1, 2, 1, 2, 3], pairs) == 2
    assert wordbpe.count_after_merges([], pairs) == 0
    same = {(1, 1): (0, 2), (2, 1): (1, 3)}
    assert wordbpe.count_after_merges([1, 1, 1], same) == 1  # leftmost of equals: (11)1


def test_count_query_over_the_whole_table(spark, duck):
    rows = QUERIES["op1_token_counts"](spark, SMALL).collect()
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    lib = Tokenizer.from_file(WORD)
    assert len(rows) == len(texts)
    for r in rows:
        n = len(lib.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 2048)


def test_count_traps(trap_docs):
    out = token_counts.token_counts(trap_docs.withColumn("n_tokens", trap_docs.doc_id)).collect()
    assert len(out) == trap_docs.count()
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in out}
    assert got[2] == got[3] == (0, 0) and got[7] == (3, 0) and got[5][1] > 30_000
    assert token_counts.token_counts(trap_docs.limit(0)).count() == 0


def test_encode_query_over_the_whole_table(spark, duck):
    lib = Tokenizer.from_file(BYTE)
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    for r in QUERIES["op5_byte_bpe"](spark, SMALL).collect():
        ids = np.array(lib.encode(texts[r.doc_id], add_special_tokens=False).ids, dtype="<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_encode_traps(trap_docs):
    out = bytebpe.encode_decode(trap_docs).collect()
    text = {r.doc_id: r.text or "" for r in trap_docs.collect()}
    assert len(out) == trap_docs.count() and all(r.decoded == text[r.doc_id] and len(r.ids) == r.n_tokens for r in out)
    assert bytebpe.encode_decode(trap_docs.limit(0)).count() == 0


def packed_right(rows, texts, seq_len=4096):
    lib = Tokenizer.from_file(WORD)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc, pieces in by_doc.items():
        ids = np.array(lib.encode(texts[doc] or "", add_special_tokens=False).ids + [1], dtype="<u4")
        starts = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces)
        want = [(p, a, len(ids[a:a + seq_len]), zlib.crc32(ids[a:a + seq_len].tobytes()))
                for p, a in enumerate(range(0, len(ids), seq_len))]
        assert sorted(set(starts)) == want
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= seq_len
    return len(by_seq)


def test_pack_query_over_the_whole_table(spark, duck):
    rows = QUERIES["op6_best_fit_packing"](spark, SMALL).collect()
    texts = dict(duck.execute("SELECT doc_id, text FROM documents").fetchall())
    assert {r.doc_id for r in rows} == set(texts)
    n = packed_right(rows, texts)
    assert n <= -(-sum(r.length for r in rows) // 4096) * 1.03 + 1


def test_pack_traps(trap_docs):
    rows = packing.pack(trap_docs.withColumn("offset", trap_docs.doc_id)).collect()
    packed_right(rows, {r.doc_id: r.text for r in trap_docs.collect()})
    assert packing.pack(trap_docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_plan_places_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    lengths = {0: rng.integers(1, 65, 500), 1: rng.integers(20, 40, 300), 2: np.full(77, 33), 3: np.full(5, 64),
               4: rng.integers(33, 65, 100), 5: np.array([1]), 6: rng.geometric(0.05, 2000).clip(1, 64),
               7: rng.choice([22, 21, 43, 64], 400)}[seed]
    histogram = {int(x): int(n) for x, n in zip(*np.unique(lengths, return_counts=True))}
    plan = packing.pack_histogram(histogram, capacity=64, groups=8)
    x = np.repeat(list(histogram), list(histogram.values()))
    rank = np.concatenate([np.arange(n) for n in histogram.values()])
    seq, offset = plan.place(x, rank)
    fill = {}
    for s, o, n in sorted(zip(seq.tolist(), offset.tolist(), x.tolist())):
        assert o == fill.get(s, 0)
        fill[s] = o + n
    assert max(fill.values()) <= 64 and len(fill) == plan.sequences
    decreasing = []  # first-fit decreasing for comparison
    for n in sorted(x.tolist(), reverse=True):
        fits = [i for i, left in enumerate(decreasing) if left >= n]
        if fits:
            decreasing[fits[0]] -= n
        else:
            decreasing.append(64 - n)
    assert len(fill) <= len(decreasing) * 1.02 + 1


def best_fit_decreasing(lengths, capacity):
    """Sequences of the plain method: the longest piece first, into the fullest sequence with room."""
    from bisect import bisect_left, insort
    room = []
    made = 0
    for n in sorted(lengths.tolist(), reverse=True):
        k = bisect_left(room, n)
        left = room.pop(k) if k < len(room) else capacity
        made += left == capacity
        if left > n:
            insort(room, left - n)
    return made


@pytest.mark.parametrize("name", ["uniform", "thirds", "halves", "1000-1900", "1100-3000", "small"])
def test_never_worse_than_best_fit_decreasing(name):
    rng = np.random.default_rng(3)
    lengths = {"uniform": rng.integers(1, 4097, 8000), "thirds": np.clip(rng.normal(1365, 120, 9000).astype(int), 1, 4096),
               "halves": np.clip(rng.normal(2048, 200, 6000).astype(int), 1, 4096), "1000-1900": rng.integers(1000, 1901, 8000),
               "1100-3000": rng.integers(1100, 3001, 6000), "small": rng.geometric(0.002, 20000).clip(1, 4096)}[name]
    histogram = {int(x): int(n) for x, n in zip(*np.unique(lengths, return_counts=True))}
    plan = packing.pack_histogram(histogram)
    assert -(-int(lengths.sum()) // 4096) <= plan.sequences <= best_fit_decreasing(lengths, 4096) * 1.005
    rank = np.concatenate([np.arange(n) for n in histogram.values()])
    x = np.repeat(list(histogram), list(histogram.values()))
    seq, offset = plan.place(x, rank)
    order = np.lexsort((offset, seq))
    fill = {}
    for s, o, n in zip(seq[order].tolist(), offset[order].tolist(), x[order].tolist()):
        assert o == fill.get(s, 0)
        fill[s] = o + n
    assert len(fill) == plan.sequences and max(fill.values()) <= 4096
