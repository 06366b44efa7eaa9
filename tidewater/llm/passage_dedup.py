"""Passages repeated across documents, by matching statistics over compressed FM-indexes (operator 12).

A word goes if a window of ``window`` words that covers it also starts in a document with a smaller
id.  Streaming every document past the index of every shard would cost the square of the corpus, so
words that can match are brought to the same shard first, and each shard's index is asked only by
what it holds:

1. *Anchors.*  In every window the place of the smallest hash of ``GRAM`` consecutive words (the
   leftmost of equals) is the window's anchor.  Equal windows have equal anchors, so only anchors
   whose gram occurs in two documents matter; their grams are counted by an aggregate.
2. *Contexts.*  The words that the windows of such an anchor cover are its context.  Equal contexts
   become one, with the smallest id.  A gram with more than ``OFTEN`` occurrences, as at the border of
   a passage that many documents hold, would bring contexts without bound into one shard; there a
   context is a single window, dealt by its own hash, if that occurs in two documents as well.
3. *Shards.*  Contexts are dealt by hash to shards of bounded size.  A shard's distinct words are its
   alphabet; its contexts are one text, whose Burrows-Wheeler transform is kept as a Huffman-shaped
   wavelet tree of packed bit vectors with rank counts (its size follows the entropy of the words).
4. *Search.*  All contexts of a shard are streamed right to left through backward search at once.  A
   match is extended by one word where the interval of the extension holds a smaller id (the
   smallest id of an interval comes from a sparse table), and otherwise shortened to the parent
   interval; the longest match at a place is its matching statistic.  Places whose statistic reaches
   the window are reported, as intervals with the smallest id that holds them.
5. The intervals go back to the documents that hold the context and are cut out there.

Documents that repeat the words of a whole document with a smaller id are settled by their digest.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, parallelism, pick, split_join, written

WINDOW, GRAM = 50, 16
#: Bytes of text worked on at once.
CHUNK_BYTES = 1 << 20
#: Occurrences of a gram beyond which its contexts are single windows.
OFTEN = 2048
#: Words of the contexts of one shard, on average.
SHARD_WORDS = 1 << 18
_NULL_ID = (1 << 63) - 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)


# --- words and anchors -----------------------------------------------------------------------------

def _scramble(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of a list of texts: their places in one buffer, and 64-bit hashes of each."""

    _powers: list[np.ndarray] = []

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join(texts) + b" "
        buf = np.frombuffer(self.raw, np.uint8)
        inside = (buf != 0x20) & ((buf < 0x09) | (buf > 0x0D))
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        self.starts, self.ends = edge[::2], edge[1::2]
        borders = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(borders, self.starts, side="right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))  # first word of each text
        self.counts = np.diff(self.first)
        self.hashes = self._hash(buf) if len(self.starts) else np.zeros(0, np.uint64)

    def _hash(self, buf: np.ndarray) -> np.ndarray:
        """Polynomials of the words' bytes modulo 2^64; powers count from a word's end, so equal words
        have equal hashes wherever they stand.  Worked out for about CHUNK_BYTES at once."""
        size = self.ends - self.starts
        base = np.uint64(0x9E3779B97F4A7C15)
        if not self._powers or len(self._powers[0]) < size.max():
            self._powers[:] = [np.cumprod(np.r_[np.uint64(1), np.full(int(size.max()), base)])]
        upto = np.cumsum(size)
        cuts = np.searchsorted(upto, np.arange(0, upto[-1] + CHUNK_BYTES, CHUNK_BYTES))
        out = np.empty(len(size), np.uint64)
        for lo, hi in zip(cuts[:-1], np.r_[cuts[1:-1], len(size)]):
            if lo < hi:
                n = size[lo:hi]
                place = np.repeat(self.starts[lo:hi] - np.cumsum(n) + n, n) + np.arange(n.sum())
                up = self._powers[0][np.repeat(self.ends[lo:hi], n) - 1 - place]
                out[lo:hi] = np.add.reduceat((buf[place].astype(np.uint64) + np.uint64(1)) * up, np.cumsum(n) - n)
        return _scramble(out * np.uint64(31) + size.astype(np.uint64))

    def span(self, lo: int, hi: int) -> bytes:
        """Words ``lo`` to ``hi`` (excluded), joined by one space."""
        return b" ".join(self.raw[self.starts[lo]:self.ends[hi - 1]].split())


def run_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive hashes, by doubling."""
    out, done, power, base = np.zeros(max(0, len(h) - n + 1), np.uint64), 0, h, np.uint64(0xC2B2AE3D27D4EB4F)
    if not len(out):
        return out
    k, left = 1, n
    while left:
        if left & 1:
            out = _scramble(out * base + power[done:done + len(out)])
            done += k
        left >>= 1
        if left:
            power = _scramble(power[:-k] * base + power[k:])
            k *= 2
    return out


def anchors(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor, first and last window, gram hash) of every anchor; places count words."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64))
    w = window - gram + 1
    if len(words.hashes) < window:
        return none
    h = run_hashes(words.hashes, gram)
    p = np.arange(len(words.hashes) - window + 1)
    p = p[words.doc[p] == words.doc[p + window - 1]]
    if not len(p):
        return none
    # smallest of w grams from any place: blocks of w, smallest from either side; the place in the low bits
    full = np.full(-(-len(h) // w) * w, ~np.uint64(0))
    full[:len(h)] = (h & ~np.uint64(127)) | (np.arange(len(h)) % w).astype(np.uint64)
    rows = full.reshape(-1, w)
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    left = np.minimum.accumulate(rows, axis=1).reshape(-1)
    a, b = right[p], left[p + w - 1]
    front = (a >> np.uint64(7)) <= (b >> np.uint64(7))
    at = np.where(front, p // w * w + (a & np.uint64(127)).astype(np.int64), (p + w - 1) // w * w + (b & np.uint64(127)).astype(np.int64))
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (words.doc[p[1:]] != words.doc[p[:-1]])])
    last = np.r_[new[1:], len(p)] - 1
    return words.doc[p[new]], at[new], p[new], p[last], h[at[new]]


def _pieces(texts: list[bytes]) -> Iterator[tuple[int, Words]]:
    """(first text, words) of runs of whole texts of about CHUNK_BYTES."""
    at = 0
    while at < len(texts):
        take, size = at, 0
        while take < len(texts) and (take == at or size + len(texts[take]) <= CHUNK_BYTES):
            size += len(texts[take])
            take += 1
        yield at, Words(texts[at:take])
        at = take


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


# --- the index of a shard --------------------------------------------------------------------------

class Bits:
    """A packed bit vector with rank counts per 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.r_[bits, np.zeros(64 - len(bits) % 64, bool)], bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words))[:-1]].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones in front of place ``i``."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman code lengths of symbols with these counts (one symbol: one bit)."""
    if len(counts) == 1:
        return np.array([1])
    heap = [(int(n), i) for i, n in enumerate(counts)]
    heapq.heapify(heap)
    parent, nxt = {}, len(counts)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]] = parent[b[1]] = nxt
        heapq.heappush(heap, (a[0] + b[0], nxt))
        nxt += 1
    depth = np.zeros(nxt, np.int64)
    for node in range(nxt - 2, -1, -1):
        depth[node] = depth[parent[node]] + 1
    return depth[:len(counts)]


class WaveletTree:
    """Rank queries on a sequence of symbols 0 .. n-1, all occurring: a Huffman-shaped wavelet tree.

    Codes are canonical: symbols in order of code length have codes in ascending order.  The bits of
    one depth lie in one vector, node after node; a node's place in it is the number of symbols, in the
    sequence, whose codes are smaller and longer than the depth.
    """

    def __init__(self, sequence: np.ndarray, n: int):
        counts = np.bincount(sequence, minlength=n)
        length = code_lengths(counts)
        order = np.lexsort((np.arange(n), length))
        code, last = np.zeros(n, np.int64), 0
        value = -1
        for s in order.tolist():
            value = (value + 1) << (int(length[s]) - last)
            last = int(length[s])
            code[s] = value
        self.length, self.code = length, code
        self.levels: list[Bits] = []
        self.base: list[np.ndarray] = []  # per depth and symbol: place of its node in the depth's vector
        held = sequence
        depth = 0
        while len(held):
            reach = length[held] > depth
            held = held[reach]
            if not len(held):
                break
            prefix = code >> np.maximum(length - depth, 0)  # codes cut at this depth
            alive = length > depth
            held = held[np.argsort(prefix[held], kind="stable")] if depth else held
            bit = (code[held] >> (length[held] - depth - 1)) & 1
            self.levels.append(Bits(bit.astype(bool)))
            nodes, node = np.unique(prefix[alive], return_inverse=True)
            size = np.bincount(node, weights=counts[alive], minlength=len(nodes)).astype(np.int64)
            place = np.zeros(n, np.int64)
            place[alive] = (np.cumsum(size) - size)[node]
            self.base.append(place)
            depth += 1

    def rank(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol in front of ``lo`` and in front of ``hi``."""
        lo, hi = lo.copy(), hi.copy()
        live = np.arange(len(symbol))
        for depth, (bits, place) in enumerate(zip(self.levels, self.base)):
            s = symbol[live]
            base = place[s]
            zero = bits.rank(base)
            a = bits.rank(base + lo[live]) - zero
            b = bits.rank(base + hi[live]) - zero
            one = (self.code[s] >> (self.length[s] - depth - 1)) & 1 == 1
            lo[live] = np.where(one, a, lo[live] - a)
            hi[live] = np.where(one, b, hi[live] - b)
            live = live[self.length[s] > depth + 1]
            if not len(live):
                break
        return lo, hi


class LevelTable:
    """Smallest value of any interval of an array, from smallest values of runs of powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        k = 1
        while 2 * k <= len(values):
            self.rows.append(np.minimum(self.rows[-1][:-k], self.rows[-1][k:]))
            k *= 2

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Of values lo .. hi - 1 (not empty)."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.rows[0].dtype)
        for k in np.unique(level).tolist():
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << k)])
        return out

    def below_left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The nearest place at or left of ``at`` whose value is below ``bound``, or -1."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            fits = at - (1 << k) + 1 >= 0
            skip = fits & (self.rows[k][np.maximum(at - (1 << k) + 1, 0)] >= bound)
            at[skip] -= 1 << k
        return at

    def below_right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The nearest place at or right of ``at`` whose value is below ``bound``, or the length."""
        at, n = at.copy(), len(self.rows[0])
        for k in range(len(self.rows) - 1, -1, -1):
            fits = at + (1 << k) <= n
            row = self.rows[k]
            skip = fits & (row[np.minimum(at, len(row) - 1)] >= bound)
            at[skip] += 1 << k
        return at


class FMIndex:
    """The index of several strings of symbols 1 .. n-1, each with the id of its document.

    ``text`` holds the strings one after the other, each ended by 0; ``owner`` has an id for every
    place.  Suffixes end with their string; equal ones are in the order of their places, which the
    backward steps preserve.
    """

    def __init__(self, text: np.ndarray, owner: np.ndarray, n: int):
        size = len(text)
        end = np.flatnonzero(text == 0)
        left = end[np.searchsorted(end, np.arange(size))] - np.arange(size)  # words up to the string's end
        rank, k, ranks = text.astype(np.int64), 1, [text.astype(np.int32)]
        while k <= left.max():
            follow = np.zeros(size, np.int64)
            more = np.flatnonzero(left >= k)
            follow[more] = rank[more + k] + 1
            pair = rank * (size + n + 2) + follow
            order = np.argsort(pair, kind="stable")
            rank = np.empty(size, np.int64)
            rank[order] = np.cumsum(np.r_[0, pair[order][1:] != pair[order][:-1]])
            ranks.append(rank.astype(np.int32))
            k *= 2
        order = np.argsort(rank, kind="stable")
        # words that neighbours in the order share, by the ranks of ever shorter runs
        a, b = order[:-1].copy(), order[1:].copy()
        shared, most = np.zeros(size - 1, np.int64), np.minimum(left[a], left[b])
        for level in range(len(ranks) - 1, -1, -1):
            step = 1 << level
            fits = np.flatnonzero(shared + step <= most)
            same = fits[ranks[level][a[fits]] == ranks[level][b[fits]]]
            a[same] += step
            b[same] += step
            shared[same] += step
        self.shared = LevelTable(np.r_[0, shared, 0].astype(np.int16 if left.max() < 30000 else np.int32))  # with a border on either side
        self.owner = LevelTable(owner[order])
        before = np.r_[0, text[:-1]]
        self.tree = WaveletTree(before[order], n)
        self.start = np.r_[0, np.cumsum(np.bincount(text, minlength=n))]
        self.size = size

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + string from those of the strings."""
        a, b = self.tree.rank(symbol, lo, hi)
        return self.start[symbol] + a, self.start[symbol] + b

    def widen(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first ``depth`` words of the strings of these intervals."""
        return np.maximum(self.shared.below_left(lo, depth), 0), np.minimum(self.shared.below_right(hi, depth), self.size)

    def parent_depth(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The longest length at which a string's interval grows."""
        return np.maximum(self.shared.rows[0][lo], self.shared.rows[0][hi])

    def statistics(self, texts: np.ndarray, first: np.ndarray, size: np.ndarray, owner: np.ndarray,
                   most: int) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of the strings texts[first : first + size], streamed right to left, all
        at once: for every place of ``texts`` the length, up to ``most``, of the longest match at it in a
        string of an id smaller than ``owner``, and the smallest id that holds this match."""
        length, least = np.zeros(len(texts), np.int64), np.full(len(texts), _NULL_ID)
        at = first + size - 1
        lo, hi, depth = np.zeros(len(first), np.int64), np.full(len(first), self.size), np.zeros(len(first), np.int64)
        live = np.flatnonzero(size)
        while len(live):
            full = live[depth[live] == most]  # a longer match is not asked for
            depth[full] -= 1
            lo[full], hi[full] = self.widen(lo[full], hi[full], depth[full])
            a, b = self.extend(texts[at[live]], lo[live], hi[live])
            found = np.full(len(live), _NULL_ID)
            some = b > a
            found[some] = self.owner.least(a[some], b[some])
            good = found < owner[live]
            go, stuck = live[good], live[~good]
            lo[go], hi[go] = a[good], b[good]
            depth[go] += 1
            length[at[go]], least[at[go]] = depth[go], found[good]
            # no longer match: on with a shorter one, or with none at this place
            short, bare = stuck[depth[stuck] > 0], stuck[depth[stuck] == 0]
            depth[short] = self.parent_depth(lo[short], hi[short])
            lo[short], hi[short] = self.widen(lo[short], hi[short], depth[short])
            at[go] -= 1
            at[bare] -= 1
            live = live[at[live] >= first[live]]
        return length, least


def repeated_windows(contexts: list[bytes], least: np.ndarray, largest: np.ndarray, window: int) -> Iterator[tuple[int, int, int, int]]:
    """(context, first window, last window, smallest id that holds them) for the windows of contexts,
    the words of documents of which ``least`` and ``largest`` are the smallest and largest ids, that
    occur in a document with an id smaller than the largest."""
    split = [c.split() for c in contexts]
    size = np.array([len(w) for w in split])
    flat = pa.array([w for ws in split for w in ws], pa.large_binary()).dictionary_encode()
    first = np.cumsum(size + 1) - size - 1
    text = np.zeros(int(size.sum()) + len(size), np.int64)
    text[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = flat.indices.to_numpy().astype(np.int64) + 1
    index = FMIndex(text, np.repeat(least, size + 1), len(flat.dictionary) + 1)
    length, found = index.statistics(text, first, size, largest, window)
    hit = np.flatnonzero(length == window)
    if len(hit):
        context, found = np.repeat(np.arange(len(size)), size + 1)[hit], found[hit]
        at = hit - first[context]
        new = np.flatnonzero(np.r_[True, (context[1:] != context[:-1]) | (at[1:] != at[:-1] + 1) | (found[1:] != found[:-1])])
        last = np.r_[new[1:], len(at)] - 1
        yield from zip(context[new].tolist(), at[new].tolist(), at[last].tolist(), found[new].tolist())


# --- the job ---------------------------------------------------------------------------------------

def shared_hashes(rows: DataFrame, label: str) -> DataFrame:
    """(ord, t, h, n): hashes of the lists ``hs`` of documents that occur in a second document, and
    how often they occur."""
    hashes = rows.select("ord", F.explode("hs").alias("h")).groupBy("h")
    found = hashes.agg(F.min("ord").alias("lo"), F.max("ord").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    return split_join(rows.select("ord", "t", F.explode(F.array_distinct("hs")).alias("h")), written(found.select("h", "n"), label), ["h"])


def _wanted(column: pa.Array) -> np.ndarray:
    return np.unique(column.flatten().to_numpy()).view(np.uint64)


def gram_lists(src: DataFrame, window: int) -> DataFrame:
    """(ord, t, digest, hs): every row with the hashes of its anchors' grams."""
    def profile(batches):
        for batch in batches:
            raws = _texts(batch.column(2))
            hs, borders = [], [np.zeros(1, np.int64)]
            for at, words in _pieces(raws):
                doc, _, _, _, h = anchors(words, window, GRAM)
                hs.append(h.view(np.int64))
                borders.append(borders[-1][-1] + np.cumsum(np.bincount(doc, minlength=len(words.counts))))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(borders), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *hs])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([hashlib.sha256(r).digest() for r in raws], pa.binary()), lists],
                                             names=["ord", "t", "digest", "hs"])

    return map_batches(src.select("ord", "t", "raw"), profile, "ord bigint, t bigint, digest binary, hs array<bigint>")


def _windows_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, window) for all windows of anchors."""
    many = last - first + 1
    of = np.repeat(np.arange(len(many)), many)
    return of, first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)


def window_lists(texts: DataFrame, window: int) -> DataFrame:
    """(ord, t, hs): hashes of the windows whose anchor's gram occurs often (column ``often``)."""
    def hashes(batches):
        for batch in batches:
            wanted = _wanted(batch.column(3))
            for at, words in _pieces(_texts(batch.column(2))):
                doc, _, first, last, h = anchors(words, window, GRAM)
                mine = np.isin(h, wanted)
                of, p = _windows_of(first[mine], last[mine])
                size = np.bincount(doc[mine][of], minlength=len(words.counts))
                hs = run_hashes(words.hashes, window)[p].view(np.int64) if len(p) else np.zeros(0, np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(size)], pa.int32()), pa.array(hs))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(at, len(size)) for i in (0, 1)), lists], names=["ord", "t", "hs"])

    return map_batches(texts.select("ord", "t", "raw", "often"), hashes, "ord bigint, t bigint, hs array<bigint>")


def find_contexts(texts: DataFrame, window: int) -> DataFrame:
    """One row per batch and distinct context: the hash ``h`` it is dealt by (of its anchor's gram, or of
    the whole window), ``words`` and their number ``size``, its identity ``c`` among those of ``h``, and
    where it stands.  ``texts`` has (ord, t, raw, few, windows), the hashes of grams and of windows."""
    def contexts(batches):
        for batch in batches:
            ords, ts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            grams, whole = _wanted(batch.column(3)), _wanted(batch.column(4))
            held: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
            for at, words in _pieces(_texts(batch.column(2))):
                doc, _, first, last, h = anchors(words, window, GRAM)
                mine = np.isin(h, grams)
                found = [(doc[mine], first[mine], last[mine], h[mine])]
                if len(whole) and len(words.hashes) >= window:
                    p = np.flatnonzero(np.isin(run := run_hashes(words.hashes, window), whole))
                    p = p[words.doc[p] == words.doc[p + window - 1]]
                    found.append((words.doc[p], p, p, run[p]))
                for d, lo, hi, k in zip(*(np.concatenate(x).tolist() for x in zip(*((a, b, c, e.view(np.int64)) for a, b, c, e in found)))):
                    held.setdefault((k, words.span(lo, hi + window)), []).append((at + d, lo - int(words.first[d])))
            keys = list(held)
            where = [[[ords[d] for d, _ in held[k]], [ts[d] for d, _ in held[k]], [p for _, p in held[k]]] for k in keys]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int64()), pa.array([w for _, w in keys], pa.binary()),
                 pa.array([w.count(b" ") + 1 for _, w in keys], pa.int64()), pa.array([min(x[0]) for x in where], pa.int64()),
                 pa.array([max(x[0]) for x in where], pa.int64()), *(pa.array([x[i] for x in where], pa.list_(pa.int64())) for i in range(3))],
                names=["h", "words", "size", "least", "largest", "ords", "ts", "places"])

    found = map_batches(texts.select("ord", "t", "raw", "few", "windows"), contexts, "h bigint, words binary, size bigint, least bigint, "
                        "largest bigint, ords array<bigint>, ts array<bigint>, places array<bigint>")
    return found.withColumn("c", F.xxhash64("words"))


def search(contexts: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(h, c, n, spans): the contexts with windows that a smaller id holds; ``n`` rows have the context."""
    spark = contexts.sparkSession
    one = contexts.groupBy("h", "c", "words").agg(F.min("least").alias("least"), F.max("largest").alias("largest"), F.count("*").alias("n"))
    shards = 1 + (contexts.agg(F.sum("size").alias("n")).first()["n"] or 0) // shard_words
    parts = max(parallelism(spark), shards // 16)
    dealt = one.withColumn("shard", F.pmod("h", F.lit(shards))).repartition(parts, "shard").sortWithinPartitions("shard")

    def report(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        least, largest = t["least"].to_numpy(), t["largest"].to_numpy()
        spans: dict[int, list[dict]] = {}
        for context, first, last, found in repeated_windows(t["words"].to_pylist(), least, largest, window):
            spans.setdefault(context, []).append({"first": first, "last": last, "least": found})
        hit = t.take(pa.array(list(spans), pa.int64())).combine_chunks()
        place = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("least", pa.int64())]))
        columns = [(c.chunk(0) if c.num_chunks else pa.array([], pa.int64())) for c in (hit["h"], hit["c"], hit["n"])]
        return pa.RecordBatch.from_arrays([*columns, pa.array(list(spans.values()), place)], names=["h", "c", "n", "spans"])

    def match(batches):
        rows, now = [], None
        for batch in batches:
            at = batch.column(6).to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo < hi and at[lo] != now:
                    if rows:
                        yield report(rows)
                    rows, now = [], at[lo]
                if lo < hi:
                    rows.append(batch.slice(lo, hi - lo))
        if rows:
            yield report(rows)

    return map_batches(dealt.select("h", "c", "words", "least", "largest", "n", "shard"), match,
                       "h bigint, c bigint, n bigint, spans array<struct<first:bigint,last:bigint,least:bigint>>")


def passage_dedup(docs: DataFrame, window: int = WINDOW, often: int = OFTEN, shard_words: int = SHARD_WORDS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``spans`` (first and last + 1 of the
    maximal runs of removed words) and ``kept_text`` (the words that remain, joined by one space).

    Words are parted by ASCII white space.  Ids are integers and give the order of documents; a match
    within a document, or among rows of one id, removes nothing.  A null text has no words; rows with a
    null id come after all others and remove nothing from each other; an empty table gives an empty
    result; other columns are ignored.  ``often`` and ``shard_words`` bound the work of a shard and do
    not change the result.
    """
    if not GRAM < window <= GRAM + 127:
        raise ValueError(f"window must lie between {GRAM + 1} and {GRAM + 127}")
    kind = docs.schema[id_col].dataType
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    src = pick(docs, id_col, text_col).select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL_ID)).alias("ord"),
                                              F.xxhash64(raw).alias("t"), raw.alias("raw"))
    key = ["ord", "t"]
    profile = written(gram_lists(src, window), "passage-profile")
    firsts = profile.groupBy("digest").agg(F.min("ord").alias("ord")).withColumn("lead", F.lit(True))
    marked = written(profile.join(firsts, ["digest", "ord"], "left").select(*key, "hs", F.coalesce("lead", F.lit(False)).alias("lead")), "passage-leads")
    grams = shared_hashes(marked.filter("lead"), "passage-grams").groupBy(*key)
    few = F.col("n") <= often
    lists = grams.agg(F.collect_list(F.when(few, F.col("h"))).alias("few"), F.collect_list(F.when(~few, F.col("h"))).alias("often"))
    texts = written(src.join(lists, key), "passage-texts")

    crowded = texts.filter("size(often) > 0")
    windows = shared_hashes(written(window_lists(crowded, window), "passage-windows"), "passage-repeats")
    none = F.lit(None).cast("array<bigint>")
    both = texts.withColumn("windows", none).unionByName(
        crowded.join(windows.groupBy(*key).agg(F.collect_list("h").alias("windows")), key).withColumn("few", none))
    contexts = written(find_contexts(both, window), "passage-contexts")
    found = written(search(contexts, window, shard_words), "passage-spans")

    hits = split_join(contexts.select("h", "c", F.arrays_zip("ords", "ts", "places").alias("at")), found, ["h", "c"])
    hits = hits.select(F.explode("at").alias("at"), "spans").select(
        F.col("at.ords").alias("ord"), F.col("at.ts").alias("t"), F.col("at.places").alias("place"), F.explode("spans").alias("span"))
    hits = hits.filter(F.col("span.least") < F.col("ord")).groupBy(*key).agg(F.collect_list(F.struct(
        (F.col("place") + F.col("span.first")).alias("start"), (F.col("place") + F.col("span.last") + window).alias("end"))).alias("cut"))
    copies = marked.filter("not lead").select(*key, F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("cut"))
    decided = written(hits.unionByName(copies).dropDuplicates(key).withColumn("hit", F.lit(True)), "passage-cuts")
    full = src.join(decided, key, "left").select("ord", "raw", "cut", F.coalesce("hit", F.lit(False)).alias("hit"))

    def cut(batches):
        for batch in batches:
            n, removed, spans, kept = [], [], [], []
            for raw, found, hit in zip(_texts(batch.column(1)), batch.column(2), batch.column(3).to_pylist()):
                words, out = raw.split(), []
                if hit and not found.is_valid:  # the text of a smaller id
                    out = [(0, len(words))] if len(words) >= window else []
                elif hit:
                    for s, e in sorted(zip(found.values.field(0).to_pylist(), found.values.field(1).to_pylist())):
                        if out and s <= out[-1][1]:
                            out[-1] = (out[-1][0], max(out[-1][1], e))
                        else:
                            out.append((s, e))
                edges = [0, *(x for span in out for x in span), len(words)]
                n.append(len(words)), removed.append(sum(e - s for s, e in out)), spans.append([{"start": s, "end": e} for s, e in out])
                kept.append(b" ".join(w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]))
            place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(place)),
                                              pa.array(kept, pa.binary()).cast(pa.string())], names=["ord", "n_words", "n_removed", "spans", "kept_text"])

    out = map_batches(full, cut, "ord bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_text string")
    name = F.when(F.col("ord") < _NULL_ID, F.col("ord")).cast(kind).alias(id_col)
    return out.select(name, "n_words", "n_removed", "spans", "kept_text")
