"""Repeated byte strings by a common-prefix-aware distributed merge sort of suffixes (operator 7).

A byte goes if a ``length``-byte string that covers it also starts earlier.  Sorting every suffix
of a corpus would move a hundred times its size, so suffixes are sorted where it matters only:

1. *Anchors.*  In every window of ``length`` bytes the place of the smallest hash of a GRAM-byte
   string (the leftmost of equals) is the window's anchor.  Equal windows have their anchors at
   the same place, so only anchors whose gram occurs in two places can lie in repeated windows.
   Each task settles what its batch repeats; one hash for each gram of a batch is exchanged.
2. *Runs.*  The suffixes at such anchors, with the bytes before them as far as windows of this
   anchor reach, are sorted per batch, equal contexts collapse to the earliest, and the run is
   cut at splitters and exchanged front-coded: shared prefix length, then the rest.
3. *Merge.*  A loser tree merges the runs of a key range.  Every candidate knows its common
   prefix with the last output; candidates with unequal common prefixes are ordered without
   looking at bytes, and equal ones are compared from there on.
4. Suffixes whose common prefix reaches the gram form a group; in it, equal windows are found
   from the common prefixes to the right and the bytes to the left, and all but the earliest go.
5. A gram with more than HOT occurrences, as at the border of a passage that many documents hold,
   would form a group without bound.  It is extended to the whole window: those of its windows that
   occur twice are suffixes of their own, equal ones are one per batch, and they take the same way
   through runs and merge, where only the earliest of equal windows is carried along.

Copies of a whole text need none of this: they are removed by their digest.  Hashes decide what meets;
what goes is decided by comparing bytes.
"""

from __future__ import annotations

import pickle
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, parallelism, pick, written

LENGTH, GRAM = 100, 32
LONGEST = 127 + GRAM
#: Bytes of text worked on at once, and documents and places that the splitters are taken from
#: (they balance the ranges; the result does not depend on them).
CHUNK_BYTES, SPLIT_DOCS, SPLIT_PLACES = 1 << 18, 512, 32
#: Groups up to this size are compared by pairs.
FEW = 5
#: Grams that occur more often are extended to whole windows.
HOT = 1 << 12
#: Windows whose bytes are compared at once, and bytes of text for each partition of the exchanges.
COMPARED, PART_BYTES = 1 << 13, 1 << 28
_NULL_ID = (1 << 63) - 1
#: What names a text, as rows with a null or repeated id share their id; and the found spans.
ROW = ("ord", "t", "t2")
SPANS = "ord bigint, t bigint, t2 bigint, start bigint, end bigint"


# --- anchors -------------------------------------------------------------------------------

def gram_hashes(buf: np.ndarray) -> np.ndarray:
    """64-bit hashes of all GRAM-byte strings (GRAM is a power of two)."""
    h, k = buf.astype(np.uint64) + np.uint64(1), 1
    base = 0x9E3779B97F4A7C15
    while k < GRAM:
        h = h[:-k] * np.uint64(base) + h[k:]
        base = base * base % (1 << 64)
        k *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def anchors(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For chunks of whole texts: (buffer, document, document's start, anchor, first and last
    window of the anchor, gram hash), one entry per anchor, places in the buffer."""
    w = length - GRAM + 1
    at = 0
    while at < len(texts):
        n, take = 0, at
        while take < len(texts) and (take == at or n + len(texts[take]) <= CHUNK_BYTES):
            n += len(texts[take])
            take += 1
        docs = [i for i in range(at, take) if len(texts[i]) >= length]
        at = take
        if not docs:
            continue
        buf = np.frombuffer(b"".join(texts[i] for i in docs), dtype=np.uint8)
        sizes = np.array([len(texts[i]) for i in docs])
        starts = np.cumsum(sizes) - sizes
        h = gram_hashes(buf)
        # sliding minimum over w grams: blocks of w, smallest from either side, place in the low bits
        full = -(-len(h) // w) * w
        key = np.full(full, ~np.uint64(0))
        key[:len(h)] = (h & ~np.uint64(127)) | (np.arange(len(h)) % w).astype(np.uint64)
        key = key.reshape(-1, w)
        left = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        right = np.minimum.accumulate(key, axis=1).reshape(-1)
        p = np.arange(len(buf) - length + 1)
        a, b = left[p], right[p + w - 1]
        block = p // w
        use_left = (a >> np.uint64(7)) <= (b >> np.uint64(7))
        anchor = np.where(use_left, block * w + (a & np.uint64(127)).astype(np.int64),
                          (p + w - 1) // w * w + (b & np.uint64(127)).astype(np.int64))
        doc = np.searchsorted(starts, p, side="right") - 1
        ok = p + length <= starts[doc] + sizes[doc]
        p, anchor, doc = p[ok], anchor[ok], doc[ok]
        first = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])])
        last = np.r_[first[1:], len(p)] - 1
        yield buf, np.array(docs)[doc[first]], starts[doc[first]], anchor[first], p[first], p[last], h[anchor[first]]


def _texts(column) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def gram_lists(texts: DataFrame, length: int) -> DataFrame:
    """(ord, t, t2, n, hs): every row with its number of bytes and the hashes of its anchors' grams."""
    def profile(batches):
        for batch in batches:
            raws = _texts(batch.column(3))
            hs, sizes = [np.zeros(0, np.int64)], np.zeros(len(raws), np.int64)
            for _, doc, _, _, _, _, h in anchors(raws, length):
                hs.append(h.view(np.int64))
                sizes += np.bincount(doc, minlength=len(raws))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(np.concatenate(hs)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array([len(r) for r in raws], pa.int64()), lists],
                                             names=[*ROW, "n", "hs"])

    return map_batches(texts.select(*ROW, "raw"), profile, "ord bigint, t bigint, t2 bigint, n bigint, hs array<bigint>")


def repeated_grams(docs: DataFrame, parts: int) -> DataFrame:
    """(t, h): hashes of the lists ``hs`` of texts that occur at two places at least, for each text digest
    ``t`` that holds them, and a row with a null t for each that occurs at more than HOT."""
    def gather(batches):
        for nth, batch in enumerate(batches):
            h = batch.column(1).flatten().to_numpy().view(np.uint64)
            d = np.repeat(batch.column(0).to_numpy(), np.diff(batch.column(1).offsets.to_numpy()))
            if not len(h):
                continue
            order = np.lexsort((d, h))
            h, d = h[order], d[order]
            new = np.r_[True, h[1:] != h[:-1]]
            group = np.cumsum(new) - 1
            # settled here: a gram at two places of a text or in two texts
            times = np.bincount(group)
            same_text = np.r_[False, (h[1:] == h[:-1]) & (d[1:] == d[:-1])]
            known = (times > 1)[group] & ~same_text
            own = (TaskContext.get().partitionId() * 31 + nth) % parts
            rows = [(own, h[known].tobytes(), d[known].tobytes(), b"")] if known.any() else []
            one_h, one_d, one_times = h[new], d[new], times.astype(np.int64)
            to = (one_h % np.uint64(parts)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(parts + 1))
            for r in range(parts):
                pickd = order[cuts[r]:cuts[r + 1]]
                if len(pickd):
                    rows.append((r, one_h[pickd].tobytes(), one_d[pickd].tobytes(), one_times[pickd].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), *(
                pa.array([x[i] for x in rows], pa.binary()) for i in (1, 2, 3))], names=["part", "h", "t", "times"])

    def meet(batches):
        hs, ts, ks = [], [], []
        for batch in batches:
            for h, t, k in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
                h, t = np.frombuffer(h, np.uint64), np.frombuffer(t, np.int64)
                if k:
                    hs.append(h), ts.append(t), ks.append(np.frombuffer(k, np.int64))
                else:  # settled where it was found
                    yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(h.view(np.int64))], names=["t", "h"])
        if hs:
            h, t, k = map(np.concatenate, (hs, ts, ks))
            names, group = np.unique(h, return_inverse=True)
            lo, hi = np.full(group.max() + 1, np.iinfo(np.int64).max), np.full(group.max() + 1, np.iinfo(np.int64).min)
            np.minimum.at(lo, group, t)
            np.maximum.at(hi, group, t)
            known = np.bincount(group, weights=k > 1) > 0
            out = ((lo != hi) | known)[group] & (k == 1)
            # a text whose gram is settled in another batch only
            yield pa.RecordBatch.from_arrays([pa.array(t[out]), pa.array(h[out].view(np.int64))], names=["t", "h"])
            total = np.zeros(len(names), np.int64)
            np.add.at(total, group, k)
            often = names[total > HOT].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(often), pa.int64()), pa.array(often)], names=["t", "h"])

    sent = map_batches(docs.select("t", "hs"), gather, "part int, h binary, t binary, times binary")
    return map_batches(sent.repartition(parts, "part"), meet, "t bigint, h bigint")


# --- front-coded runs ------------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be ``start`` at least."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[start:n], "big") ^ int.from_bytes(b[start:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(entries: list[tuple]) -> bytes:
    """A sorted run of (suffix, bytes before, id, place, further integers): each suffix as the
    length of the prefix shared with the one before, and the rest."""
    shared, rest, last = bytearray(), [], b""
    for s, *_ in entries:
        k = common_prefix(last, s)
        shared.append(k)
        rest.append(s[k:])
        last = s
    return pickle.dumps((
        bytes(shared), bytes(map(len, rest)), b"".join(rest), bytes(len(e[1]) for e in entries), b"".join(e[1] for e in entries),
        [np.array(c, np.int64).tobytes() for c in zip(*(e[2:] for e in entries))]))


def front_decode(blob: bytes) -> Iterator[tuple]:
    """(common prefix with the suffix before, suffix, bytes before, id, place, further integers) in
    order."""
    shared, rests, rest, befores, before, numbers = pickle.loads(blob)
    last, r, b = b"", 0, 0
    for k, n, m, *at in zip(shared, rests, befores, *(np.frombuffer(c, np.int64).tolist() for c in numbers)):
        last = last[:k] + rest[r:r + n]
        yield k, last, before[b:b + m], *at
        r, b = r + n, b + m


def merge_runs(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs of (common prefix with the entry before, suffix, ...) into one, with the
    common prefixes of the merged order, by a loser tree.

    Every waiting entry keeps its common prefix with the last output.  Of two entries the one
    with the longer common prefix is smaller, unseen; with equal ones the comparison starts
    behind it, and the loser keeps the common prefix with the winner.  All prefixes on the way
    from the last winner's leaf refer to that winner, so nothing known is compared again.
    """
    k = len(runs)
    if not k:
        return
    heads = [next(r, None) for r in runs]
    known = [0] * k  # common prefix of each head with the last output

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser's prefix is set against the winner."""
        if heads[x] is None:
            return y, x
        if heads[y] is None:
            return x, y
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        a, b = heads[x][1], heads[y][1]
        c = common_prefix(a, b, known[x])
        if len(a) == c or (len(b) > c and a[c] < b[c]):
            known[y] = c
            return x, y
        known[x] = c
        return y, x

    size = 1
    while size < k:
        size *= 2
    losers = [-1] * size
    winners = [-1] * size + [i if i < k else -1 for i in range(size)]
    for node in range(size - 1, 0, -1):
        x, y = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (x, y) if y < 0 else (y, x) if x < 0 else play(x, y)
    best = winners[1] if size > 1 else 0
    while heads[best] is not None:
        yield (known[best], *heads[best][1:])
        heads[best] = next(runs[best], None)
        known[best] = heads[best][0] if heads[best] is not None else 0
        node = (best + size) // 2
        while node:
            if losers[node] >= 0:
                best, losers[node] = play(best, losers[node])
            node //= 2


# --- equal windows in a group --------------------------------------------------------------------

def repeated_spans(group: list[tuple], length: int) -> Iterator[tuple[int, ...]]:
    """(id, two digests, start, end) of windows that also start earlier, for suffixes (common prefix
    with the one before, suffix, bytes before, id, place, two digests) in sorted order that share
    the anchor's gram."""
    g = len(group)
    if g < 2:
        return
    if g <= FEW:
        for j in range(1, g):
            right = length
            for i in range(j - 1, -1, -1):  # common prefix of i and j: smallest between them
                right = min(right, group[i + 1][0])
                a, b = group[i], group[j]
                if (a[3], a[4]) == (b[3], b[4]):
                    continue
                left = common_prefix(a[2][::-1], b[2][::-1])
                lo = max(length - right, length - len(a[1]), length - len(b[1]), 0)
                if lo <= left:
                    late = max(a, b, key=lambda e: (e[3], e[4]))
                    yield late[3], late[5], late[6], late[4] - left, late[4] - lo + length
        return
    reach = length - GRAM + 1  # offsets of the anchor in its windows: 0 .. reach - 1
    d = np.arange(reach)
    lens = np.array([len(e[2]) for e in group])
    # numbers of equal strings: to the right for offset d, from the common prefixes of the sorted suffixes,
    # and to the left for the nearest d bytes, from those of the sorted reversed bytes
    shared = np.array([e[0] for e in group])
    shared[0] = 0
    right = np.cumsum(shared[:, None] < length - d[None, :], axis=0)
    back = [e[2][::-1] for e in group]
    order = sorted(range(g), key=back.__getitem__)
    near = np.array([0, *(common_prefix(back[i], back[j]) for i, j in zip(order, order[1:]))])
    left = np.empty((g, reach), dtype=np.int64)
    left[order] = np.cumsum(near[:, None] < d[None, :], axis=0)
    key = (left * (g + 1) + right) * reach + d
    has = (d[None, :] <= lens[:, None]) & (d[None, :] >= length - np.array([len(e[1]) for e in group])[:, None])
    ids, places = np.array([e[3] for e in group]), np.array([e[4] for e in group])
    rank = np.lexsort((places, ids))
    row, off = np.nonzero(has[rank])
    keys = key[rank][row, off]
    order = np.argsort(keys, kind="stable")  # equal windows together, earliest first
    new = np.r_[True, keys[order][1:] != keys[order][:-1]]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    member = rank[row[order]], rank[row[head]]
    gone = ~new & ((ids[member[0]] != ids[member[1]]) | (places[member[0]] != places[member[1]]))
    gone_at = np.sort(member[0][gone] * reach + off[order][gone])
    if len(gone_at):
        breaks = np.flatnonzero((np.diff(gone_at) != 1) | (gone_at[1:] % reach == 0)) + 1
        for part in np.split(gone_at, breaks):
            e, lo, hi = part[0] // reach, part[0] % reach, part[-1] % reach
            yield int(ids[e]), *group[e][5:7], int(places[e] - hi), int(places[e] - lo + length)


# --- grams that occur very often: whole windows -----------------------------------------------------

_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def window_hashes(buf: np.ndarray, p: np.ndarray, length: int) -> list[np.ndarray]:
    """Two independent 64-bit hashes of the windows that start at ``p`` (rising): polynomials modulo
    2^64 in odd bases, as differences of sums over a piece of the buffer, shifted back by inverse
    powers."""
    size = CHUNK_BYTES + LONGEST
    if not _powers:
        _powers.extend(tuple(np.cumprod(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)]) for x in (b, pow(b, -1, 1 << 64))) for b in _BASES)
    out = [np.empty(len(p), np.uint64) for _ in _powers]
    cuts = np.searchsorted(p, np.arange(0, len(buf) + CHUNK_BYTES, CHUNK_BYTES))
    for nth, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])):
        if lo == hi:
            continue
        values = buf[nth * CHUNK_BYTES:nth * CHUNK_BYTES + size].astype(np.uint64) + np.uint64(1)
        at = p[lo:hi] - nth * CHUNK_BYTES
        for h, (up, down) in zip(out, _powers):
            sums = np.r_[np.uint64(0), np.cumsum(values * up[:len(values)])]
            h[lo:hi] = (sums[at + length] - sums[at]) * down[at]
    for h in out:
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return [h.view(np.int64) for h in out]


def _windows_of(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, window) for all windows of anchors."""
    many = last - first + 1
    of = np.repeat(np.arange(len(many)), many)
    return of, first[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)


def _wanted(column: pa.Array) -> np.ndarray:
    return np.unique(column.flatten().to_numpy()).view(np.uint64)


def window_lists(texts: DataFrame, length: int) -> DataFrame:
    """(t, hs): hashes of the windows whose anchor's gram occurs very often (column ``hot``)."""
    def hashes(batches):
        for batch in batches:
            raws, wanted = _texts(batch.column(1)), _wanted(batch.column(2))
            ws, sizes = [np.zeros(0, np.int64)], np.zeros(len(raws), np.int64)
            for buf, doc, _, _, first, last, h in anchors(raws, length):
                mine = np.isin(h, wanted)
                of, p = _windows_of(first[mine], last[mine])
                ws.append(window_hashes(buf, p, length)[0])
                sizes += np.bincount(doc[mine][of], minlength=len(raws))
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(np.concatenate(ws)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["t", "hs"])

    return map_batches(texts.select("t", "raw", "hot"), hashes, "t bigint, hs array<bigint>")


def earliest_windows(buf: np.ndarray, p: np.ndarray, h: np.ndarray, place: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows at ``p`` (hashes ``h``) that stay, the earliest by ``place`` (id, place, ...) of
    equal ones, and of those that equal one of them, byte for byte, at another id or place."""
    by = np.lexsort((*place[::-1], h))
    new = np.r_[True, h[by][1:] != h[by][:-1]][:len(by)]
    head = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    same = np.empty(len(by), bool)
    byte = np.arange(length)
    for a in range(0, len(by), COMPARED):
        x, y = p[by[a:a + COMPARED]], p[head[a:a + COMPARED]]
        same[a:a + COMPARED] = (buf[x[:, None] + byte] == buf[y[:, None] + byte]).all(axis=1)
    same &= (place[0][by] != place[0][head]) | (place[1][by] != place[1][head])
    return by[~same], by[same]


# --- the distributed sort ------------------------------------------------------------------------

def _splitters(docs: DataFrame, parts: int) -> list[bytes]:
    """Keys that cut the suffixes into ranges, from places spread over a bounded sample of texts."""
    rows = docs.select("t", "raw").filter(F.length("raw") >= LENGTH).limit(SPLIT_DOCS)
    places = F.expr(f"transform(sequence(0, {SPLIT_PLACES - 1}), i -> substring(raw, cast(1 + i * (length(raw) - 8) / {SPLIT_PLACES} as int), 8))")
    keys = sorted(k for r in rows.select(places.alias("k")).collect() for k in map(bytes, r.k))
    return [keys[i * len(keys) // parts] for i in range(1, parts)] if keys else []


def removed_spans(texts: DataFrame, profile: DataFrame, leads: DataFrame, length: int) -> DataFrame:
    """(ord, t, t2, start, end): covered byte ranges of repeated windows; they may overlap.  ``texts`` has
    (ord, t, t2, raw), ``profile`` their gram hashes, ``leads`` the (ord, t, t2, n) of the first of every text."""
    parts = max(parallelism(texts.sparkSession), (leads.agg(F.sum("n").alias("n")).first()["n"] or 0) // PART_BYTES)
    grams = written(repeated_grams(profile.join(leads, list(ROW), "left_semi"), parts), "suffix-grams")
    often = written(grams.filter("t is null").select("h", F.lit(True).alias("often")), "suffix-hot")
    # at most a text's own anchors
    lists = (grams.filter("t is not null").join(often, "h", "left").groupBy("t")
             .agg(F.collect_set(F.when(F.col("often").isNull(), F.col("h"))).alias("hs"),
                  F.collect_set(F.when(F.col("often"), F.col("h"))).alias("hot")))
    docs = written(texts.join(leads.select(*ROW).join(lists, "t"), list(ROW)).select(*ROW, "raw", "hs", "hot"), "suffix-texts")
    splits = _splitters(docs, parts)
    crowded, none = docs.filter("size(hot) > 0"), F.lit(None).cast("array<bigint>")
    twice = repeated_grams(written(window_lists(crowded, length), "suffix-window-lists"), parts).filter("t is not null")
    windows = written(twice.groupBy("t").agg(F.collect_set("h").alias("windows")), "suffix-windows")
    full = docs.withColumn("windows", none).withColumn("hot", none).unionByName(crowded.join(windows, "t").withColumn("hs", none))

    def sort(batches):
        for nth, batch in enumerate(batches):
            row, raws = list(zip(*(batch.column(i).to_pylist() for i in range(3)))), _texts(batch.column(3))
            wanted, hot, windows = (_wanted(batch.column(i)) for i in (4, 5, 6))
            by_gram, by_window = (batch.column(i).is_valid().to_numpy(zero_copy_only=False) for i in (4, 5))
            context: dict[tuple[bytes, bytes], dict[tuple[int, ...], None]] = {}
            spans, single = [], []
            numbers = np.array(row, dtype=np.int64).reshape(-1, 3)
            for buf, doc, start, anchor, first, last, h in anchors(raws, length):
                whole = buf.tobytes()
                if len(windows):
                    mine = np.isin(h, hot) & by_window[doc]
                    of, p = _windows_of(first[mine], last[mine])
                    k = window_hashes(buf, p, length)[0].view(np.uint64)
                    twice = np.isin(k, windows)
                    of, p, k = of[twice], p[twice], k[twice]
                    who, place = numbers[doc[mine][of]], p - start[mine][of]
                    stay, go = earliest_windows(buf, p, k, [who[:, 0], place, who[:, 1], who[:, 2]], length)
                    single.extend((int(k[i]) % parts, whole[p[i]:p[i] + length], *who[i, :1].tolist(), int(place[i]), *who[i, 1:].tolist())
                                  for i in stay.tolist())
                    spans.extend(_joined(who[go], place[go], length))
                for i in np.flatnonzero(np.isin(h, wanted) & by_gram[doc]).tolist():
                    a, lo, hi = int(anchor[i]), int(first[i]), int(last[i])
                    order, t, t2 = row[doc[i]]
                    here = order, a - int(start[i]), t, t2
                    held = context.setdefault((whole[a:hi + length], whole[lo:a]), {})
                    there = next(iter(held), here)
                    if here[:2] == there[:2]:  # texts of one id may share a place
                        held[here] = None
                        continue
                    late = [here]  # the whole context occurs twice in the batch
                    if here < there:
                        late = list(held)
                        held.clear()
                        held[here] = None
                    spans.extend((o, t, t2, p - (a - lo), p + hi - a + length) for o, p, t, t2 in late)
            rows = [((TaskContext.get().partitionId() * 31 + nth) % parts, None, pickle.dumps(spans))] if spans else []
            run = sorted((s, b, *at) for (s, b), held in context.items() for at in held)
            for part, some in groupby(run, key=lambda e: bisect_right(splits, e[0][:8])):
                rows.append((part, front_code(list(some)), None))
            for part, some in groupby(sorted(single), key=lambda e: e[0]):
                rows.append((parts + part, front_code([(s, b"", *at) for _, s, *at in some]), None))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["part", "run", "spans"])

    def merge(batches):
        runs: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, run, spans in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if run is not None:
                    runs.setdefault(part, []).append(run)
                else:
                    yield table(pickle.loads(spans))
        for part, blobs in runs.items():
            group, out = [], []
            if part >= parts:  # windows: the earliest of equal ones is carried along
                first = None
                for same, _, _, *at in merge_runs([front_decode(b) for b in blobs]):
                    if first is None or same < length:
                        first = at
                        continue
                    first, late = min(first, at), max(first, at)
                    if first[:2] != late[:2]:
                        out.append((late[0], late[2], late[3], late[1], late[1] + length))
                    if len(out) > 50_000:
                        yield table(out)
                        out = []
                yield table(out)
                continue
            for e in merge_runs([front_decode(b) for b in blobs]):
                if e[0] < GRAM and group:
                    out.extend(repeated_spans(group, length))
                    group = []
                    if len(out) > 50_000:
                        yield table(out)
                        out = []
                group.append(e)
            out.extend(repeated_spans(group, length))
            yield table(out)

    def table(spans):
        return pa.RecordBatch.from_arrays([pa.array([s[i] for s in spans], pa.int64()) for i in range(5)], names=[*ROW, "start", "end"])

    sent = map_batches(full.select(*ROW, "raw", "hs", "hot", "windows"), sort, "part int, run binary, spans binary")
    return map_batches(sent.repartition(parts, "part"), merge, SPANS)


def _joined(who: np.ndarray, place: np.ndarray, length: int) -> list[tuple[int, ...]]:
    """(ord, t, t2, start, end) of windows, those of a text that follow one another as one."""
    if not len(place):
        return []
    by = np.lexsort((place, who[:, 2], who[:, 1], who[:, 0]))
    who, place = who[by], place[by]
    first = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]).any(axis=1) | (place[1:] > place[:-1] + 1)])
    last = np.r_[first[1:], len(place)] - 1
    return [(*w, a, b + length) for w, a, b in zip(who[first].tolist(), place[first].tolist(), place[last].tolist())]


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                 carry: tuple[str, ...] = (), as_text: bool = False) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (start and
    end of the maximal removed byte runs) and ``kept_bytes`` (what remains, concatenated) or, with
    ``as_text``, ``kept_text`` (the same without what a cut leaves of a character).  Columns named in
    ``carry`` come along with their row.

    Ids are integers and give the order of documents.  A null or short text loses nothing; rows
    with a null id come after all others and, like rows that repeat an id, do not match each
    other at the same place; an empty table gives an empty result; other columns are ignored.
    """
    if not GRAM < length <= LONGEST:
        raise ValueError(f"length must lie between {GRAM + 1} and {LONGEST}")
    kind = docs.schema[id_col].dataType
    left = "kept_text" if as_text else "kept_bytes"
    along = pick(docs, id_col, text_col, *(c for c in carry if c not in (id_col, text_col)))
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    src = along.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(_NULL_ID)).alias("ord"), raw.alias("raw"),
                       F.struct(*carry).alias("carried") if carry else F.lit(None).cast("int").alias("carried"))
    digest = [F.xxhash64("raw").alias("t"), F.xxhash64(F.lit(1), "raw").alias("t2")]
    texts = src.select("ord", *digest, "raw")
    whole = src.select("ord", *digest, "raw", "carried")
    profile = written(gram_lists(texts, length), "suffix-profile")
    firsts = profile.groupBy("t", "t2").agg(F.min("ord").alias("ord")).withColumn("lead", F.lit(True))
    marked = written(profile.select(*ROW, "n").distinct().join(firsts, ["t", "t2", "ord"], "left")
                     .select(*ROW, "n", F.coalesce("lead", F.lit(False)).alias("lead")), "suffix-leads")
    copies = marked.filter((~F.col("lead")) & (F.col("n") >= length)).select(*ROW)
    spans = written(removed_spans(texts, profile, marked.filter("lead"), length), "suffix-spans")
    lists = spans.groupBy(*ROW).agg(F.collect_list(F.struct("start", "end")).alias("cut")).unionByName(
        copies.select(*ROW, F.expr("cast(null as array<struct<start:bigint,end:bigint>>)").alias("cut")))
    full = whole.join(lists.withColumn("hit", F.lit(True)), list(ROW), "left").select(
        "ord", "raw", "cut", F.coalesce("hit", F.lit(False)).alias("hit"), "carried")

    def cut(batches):
        for batch in batches:
            n, removed, spans, kept = [], [], [], []
            for raw, found, hit in zip(_texts(batch.column(1)), batch.column(2), batch.column(3).to_pylist()):
                out = []
                if hit and not found.is_valid:  # a copy of an earlier whole text
                    out = [(0, len(raw))]
                elif hit:
                    flat = found.values
                    for s, e in sorted(zip(flat.field(0).to_pylist(), flat.field(1).to_pylist())):
                        if out and s <= out[-1][1]:
                            out[-1] = (out[-1][0], max(out[-1][1], e))
                        else:
                            out.append((s, e))
                n.append(len(raw)), spans.append([{"start": s, "end": e} for s, e in out]), removed.append(sum(e - s for s, e in out))
                edges = [0, *(x for span in out for x in span), len(raw)]
                pieces = [raw[a:b] for a, b in zip(edges[::2], edges[1::2])]
                if not as_text:
                    kept.append(b"".join(pieces))
                elif out:  # a cut may part the bytes of a character; elsewhere the text is sound
                    kept.append("".join(p.decode("utf-8", "ignore") for p in pieces))
                else:
                    kept.append(raw.decode("utf-8", "replace"))
            place = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array([len(s) for s in spans], pa.int64()),
                 pa.array(spans, pa.list_(place)), pa.array(kept, pa.string() if as_text else pa.binary()),
                 batch.column(4)], names=["ord", "n_bytes", "n_removed", "n_spans", "spans", left, "carried"])

    out = map_batches(full, cut, "ord bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                 f"spans array<struct<start:bigint,end:bigint>>, {left} {'string' if as_text else 'binary'}, "
                                 f"carried {whole.schema['carried'].dataType.simpleString()}")
    name = F.when(F.col("ord") < _NULL_ID, F.col("ord")).cast(kind).alias(id_col)
    along = [F.col("carried")[c].alias(c) for c in carry if c != id_col]
    return out.select(name, "n_bytes", "n_removed", "n_spans", "spans", left, *along)
