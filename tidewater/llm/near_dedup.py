"""Near-duplicate documents by HyperMinHash (operator 4).

A set's 64-bit hashes are dealt into buckets by their top bits; a bucket's register holds the
leading-zero count and a few mantissa bits of its smallest hash.  Registers of empty buckets are
borrowed along a fixed random order.  Bands of registers give candidates, and the full sets of
the texts decide on each whose set sizes allow a link.  The share of equal registers, corrected for
accidental collisions, estimates the Jaccard similarity of every candidate; the likeliest are verified
first, so that most others find their components already joined.  No pair is dropped by its estimate.

Equal sets are one class from the start.  Candidates are first compared with the most widely
shared class of each band bucket (a star, never all pairs); only buckets that still hold several components
are searched further, in blocks that emit links instead of pairs, so a large group of near copies is not
expanded into pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, parallelism, pick, split_join, written
from tidewater.llm.components import components

WORDS = 5
#: Buckets, mantissa bits, registers of a band; 21 bands find a pair of similarity 0.75 with
#: probability 1 - (1 - 0.75^3)^21 > 0.99998.
BUCKETS, MANTISSA, ROWS = 64, 10, 3
BANDS = BUCKETS // ROWS
#: About so many classes, and shingles, make up a block.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
#: A leader's text is sent once for about so many members that meet it.
SHARE = 256

_M = np.uint64(0x9E3779B97F4A7C15)
#: Register i reads bucket i, and others in a fixed random order only if that is empty.
_DONORS = np.stack([np.r_[i, (p := np.random.default_rng(1000 + i).permutation(BUCKETS))[p != i]] for i in range(BUCKETS)])
#: Words whose hashes a worker keeps: some 20 MB, which later stages find still held.
WORD_CACHE = 1 << 17
_word_hash: dict[bytes, int] = {}


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a whole text."""
    ws = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not ws:
        return np.array([], dtype=np.uint64)
    if len(_word_hash) > WORD_CACHE:
        _word_hash.clear()
    for w in set(ws).difference(_word_hash):
        _word_hash[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_word_hash.__getitem__, ws), dtype=np.uint64, count=len(ws))
    k = min(words, len(ws))
    out = np.full(len(ws) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = (out ^ h[j:len(ws) - k + 1 + j]) * _M
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    out.sort()
    return out[np.r_[True, out[1:] != out[:-1]]]


_STARTS = (np.arange(BUCKETS, dtype=np.uint64) << np.uint64(58))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers (uint16) of a set given as sorted distinct hashes."""
    at = np.searchsorted(hashes, _STARTS)
    ends = np.r_[at[1:], len(hashes)]
    held = at < ends
    v = (hashes[np.minimum(at, len(hashes) - 1)] << np.uint64(6)) >> np.uint64(11)  # 53 bits
    zeros = (53 - np.frexp(v.astype(np.float64))[1]).astype(np.uint64)
    mantissa = ((v << zeros) >> np.uint64(52 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    out = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    return out[_DONORS[np.arange(BUCKETS), held[_DONORS].argmax(axis=1)]]


def estimate(equal: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, corrected for registers of different
    hashes that collide: their minima fall into one cell of 2^-mantissa of an octave."""
    n_a, n_b = n_a.astype(float), n_b.astype(float)
    chance = 0.7213 * 2.0**-MANTISSA * n_a * n_b / (n_a + n_b) ** 2
    return (equal - chance) / (1 - chance)


def sketch(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(id, n, key, regs) of (id, text): set size, 128-bit digest of the set, registers."""
    def run(batches):
        for batch in batches:
            n, key, regs = [], [], []
            for t in batch.column(1).to_pylist():
                h = shingles(t, words) if t else np.array([], dtype=np.uint64)
                n.append(len(h))
                key.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
                regs.append(registers(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                                              pa.array(regs, pa.binary())], names=["id", "n", "key", "regs"])
    return map_batches(docs, run, "id bigint, n bigint, key binary, regs binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)


def _bands(classes: DataFrame) -> DataFrame:
    """(bucket, rep): a band's number and its registers in one integer, exactly."""
    def run(batches):
        for batch in batches:
            m = _matrix(batch.column(1)).astype(np.int64)
            keys = np.stack([(b << 48) | (m[:, ROWS * b] << 32) | (m[:, ROWS * b + 1] << 16) | m[:, ROWS * b + 2]
                             for b in range(BANDS)], axis=1).reshape(-1)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))],
                                             names=["bucket", "rep"])
    return map_batches(classes.select("rep", "regs"), run, "bucket bigint, rep bigint")


def _possible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, parts): the pairs (a, b) whose set sizes allow the similarity; ``parts`` follows the number of
    pairs of b, among which a large share of all may be."""
    leaders = pairs.groupBy("b").agg(F.count("*").alias("n")).join(classes.select(F.col("rep").alias("b"), F.col("n").alias("n_b")), "b")
    full = split_join(pairs.join(classes.select(F.col("rep").alias("a"), F.col("n").alias("n_a")), "a"), written(leaders, "near-leaders"), ["b"])
    full = full.filter(F.least("n_a", "n_b") * 100 >= percent * F.greatest("n_a", "n_b"))
    return full.select("a", "b", F.ceil(F.col("n") / SHARE).cast("int").alias("parts"))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough.  The pairs of one b are dealt to ``parts``
    places, each of which gets b's text."""
    leaders = (pairs.select("b", "parts").distinct().join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
                    .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("b", "part", "text_b"))
    full = (pairs.withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
                 .join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
                 .join(leaders, ["b", "part"]).select("a", "b", "text_a", "text_b"))

    def run(batches):
        last = (None, None)
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if b != last[0]:  # rows of one b come together
                    last = (b, shingles(b, words))
                x, y = shingles(a, words), last[1]
                if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                    ok.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok, pa.bool_())),
                                              batch.column(1).filter(pa.array(ok, pa.bool_()))], names=["a", "b"])
    return map_batches(full, run, "a bigint, b bigint")


def _cell_links(rep, comp, n, regs, band, left, right, texts, words, percent):
    """Links between different components of one cell: members ``left`` against ``right``.

    A pair is looked at in its first common band only, the likeliest partners of a member first, not at
    all once its two components have met here, and by its full sets if the sizes allow a link.
    """
    sets = [shingles(t, words) for t in texts]
    vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
    ids = np.split(ids, np.cumsum([len(x) for x in sets])[:-1])
    mark = np.zeros(len(vocabulary), dtype=bool)
    comp, out = comp.copy(), []
    for x in left:
        other = right[(right > x) if left is right else slice(None)]
        other = other[(comp[other] != comp[x]) & (100 * np.minimum(n[other], n[x]) >= percent * np.maximum(n[other], n[x]))]
        if not len(other):
            continue
        same = regs[other] == regs[x]
        ok = same[:, :BANDS * ROWS].reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        other, share = other[ok], same[ok].mean(axis=1)
        likely = estimate(share, n[other], np.full(len(other), n[x]))
        mark[ids[x]] = True
        for y in other[np.argsort(-likely, kind="stable")].tolist():
            if comp[y] != comp[x]:
                both = np.count_nonzero(mark[ids[y]])
                if 100 * both >= percent * (len(ids[x]) + len(ids[y]) - both):
                    out.append((max(rep[x], rep[y]), min(rep[x], rep[y])))
                    comp[comp == comp[y]] = comp[x]
        mark[ids[x]] = False
    return out


def _across(members: DataFrame, classes: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between different components inside band buckets.  The (bucket, rep, comp) rows are
    split into blocks of bounded size, every two blocks of a bucket meet in one cell, and a cell
    gives its links, not its pairs."""
    sized = members.join(classes.select("rep", "n"), "rep")
    blocks = sized.groupBy("bucket").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks"),
                                         F.count("*").alias("n"))
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    cells = (split_join(members, written(blocks, "near-blocks"), ["bucket"]).withColumn("mine", mine)
                    .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                    .select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "comp"))
    rows = (cells.join(classes.select("rep", "n", "regs"), "rep").join(texts.select(F.col("id").alias("rep"), "text"), "rep")
                 .repartition(parallelism(members.sparkSession), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "rep")
                 .select("bucket", "i", "j", "mine", "rep", "comp", "n", "regs", "text"))

    def run(batches):
        cell, held = None, []

        def done():
            if not held:
                return
            mine, rep, comp, n, regs, texts = (np.concatenate(x) for x in zip(*held))
            left = np.flatnonzero(mine == cell[1])
            right = left if cell[1] == cell[2] else np.flatnonzero(mine == cell[2])
            links = _cell_links(rep, comp, n, regs, cell[0] >> 48, left, right, texts, words, percent)
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy() for c in range(7)]
            regs, texts = _matrix(batch.column(7)), np.array(batch.column(8).to_pylist(), dtype=object)
            key = np.stack(cols[:3], axis=1)
            cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, len(key)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                if cell != (now := tuple(key[s].tolist())):
                    yield from done()
                    cell, held = now, []
                held.append((*(c[s:e] for c in cols[3:7]), regs[s:e], texts[s:e]))
        yield from done()

    return map_batches(rows, run, "a bigint, b bigint")


def near_dedup(docs: DataFrame, words: int = WORDS, percent: int = 75, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (smallest id reachable over
    links of similarity >= ``percent``/100) and ``kept`` (the row is its component's smallest).

    Ids are integers.  Null, empty and white-space texts have an empty set and are linked with
    nothing; a text of fewer words is one shingle; rows with a null id take no part (null
    component, not kept); repeated rows share their component.  An empty table gives an empty
    result; other columns are ignored.  A pair of similarity s shares no band, and is not found on its
    own, with probability (1 - s^3)^21: about 1 in 100,000 at 0.75.
    """
    spark = docs.sparkSession
    src = pick(docs, id_col, text_col).select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sketches = written(sketch(src, words), "near-sketches")
    classes = written(sketches.filter("id is not null and n > 0").groupBy("key")
                      .agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("regs").alias("regs")), "near-classes")
    buckets = _bands(classes)
    shared = written(buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), "near-shared")
    members = written(split_join(buckets, shared, ["bucket"]).withColumnRenamed("n", "held"), "near-buckets")
    # the leader of a bucket is the member that shares most places with others: in a group of
    # edited copies that is the text they were copied from, to which more of them are close
    fame = members.groupBy("rep").agg(F.sum("held").alias("fame"))
    ranked = members.join(fame, "rep")
    leaders = ranked.groupBy("bucket").agg(F.max(F.struct("fame", (-F.col("rep")).alias("neg"))).alias("top"), F.first("held").alias("n"))
    leaders = written(leaders.select("bucket", (-F.col("top.neg")).alias("leader"), "n"), "near-tops")
    members = written(split_join(members.drop("held"), leaders, ["bucket"]).drop("n"), "near-members")

    star = written(members.filter("rep <> leader").select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct(), "near-pairs")
    star = written(_possible(star, classes, percent), "near-star")
    reps = members.select(F.col("rep").alias("id")).distinct()
    texts = written(src.join(reps, "id", "left_semi"), "near-texts")
    links = written(_verified(star, texts, words, percent), "near-links")
    labels = components(links)

    named = members.join(labels, members["rep"] == labels["node"], "left").select("bucket", "rep", F.coalesce("comp", "rep").alias("comp"))
    named = written(named, "near-named")
    mixed = named.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n")).filter("lo <> hi")
    open_ = written(split_join(named, written(mixed.select("bucket", "n"), "near-mixed"), ["bucket"]).drop("n"), "near-open")
    found = _across(open_, classes, texts, words, percent)
    name = lambda s: labels.select(F.col("node").alias(s), F.col("comp").alias(f"comp_{s}"))
    merged = components(written(found.join(name("a"), "a", "left").join(name("b"), "b", "left")
                                .select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
                                .filter("a <> b").distinct(), "near-merges"))

    final = (classes.select("key", "rep").join(labels, F.col("rep") == F.col("node"), "left")
             .select("key", F.coalesce("comp", "rep").alias("first"))
             .join(merged, F.col("first") == F.col("node"), "left").select("key", F.coalesce("comp", "first").alias("comp")))
    kind = docs.schema[id_col].dataType
    return (sketches.select("id", "n", "key").join(final, "key", "left")
            .select(F.col("id").cast(kind).alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("comp", "id")).cast(kind).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
