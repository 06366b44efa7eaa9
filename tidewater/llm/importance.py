"""Target-distribution importance resampling over hashed word features (operator 13).

A document's features are its runs of ``lo`` to ``hi`` consecutive words, and a feature's bucket is
its CRC-32 modulo ``buckets``.  The CRC is linear over XOR, so no byte is fed through a register:

1. *Position table.*  What a byte adds to the register of a span that ends ``d`` bytes after it is
   looked up in a table of (distance from the end, byte).
2. *Spans.*  All features of a chunk of words are spans of one buffer; their looked-up entries are
   joined by ``bitwise_xor.reduceat``, and a constant for each length puts in the start value.
3. *Long spans* are cut into blocks from the end; the register moves on by a whole block of zero
   bytes (four more tables) and takes in the next block.

The counts of the buckets over all documents and over the target texts, at most ``buckets`` rows
each, give the gains.  Scores are ranked by a range-partitioned sort: a rank is the number of rows
of the ranges in front, and the place in its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, parallelism, pick, written

#: Bytes of a block of the position table, and feature bytes worked on at once.
BLOCK, CHUNK_BYTES = 64, 1 << 20
#: Rows of one range of the ranking sort.
RANGE_ROWS = 1 << 22
ONES = np.uint32(0xFFFFFFFF)


# --- the checksum --------------------------------------------------------------------------------

def _byte_steps() -> np.ndarray:
    """The register after one byte, from zero, for the reflected polynomial of CRC-32."""
    r = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        r = np.where(r & np.uint32(1), (r >> np.uint32(1)) ^ np.uint32(0xEDB88320), r >> np.uint32(1)).astype(np.uint32)
    return r


class PositionTable:
    """CRC-32 of many spans at once, by tables for blocks of ``block`` bytes."""

    def __init__(self, block: int = BLOCK):
        step = _byte_steps()

        def zero_byte(r: np.ndarray) -> np.ndarray:
            return step[r & np.uint32(255)] ^ (r >> np.uint32(8))

        rows = [step]  # rows[d][b]: byte b with d bytes behind it
        for _ in range(block - 1):
            rows.append(zero_byte(rows[-1]))
        start = [np.array([ONES])]  # the start value with n bytes behind it
        for _ in range(block):
            start.append(zero_byte(start[-1]))
        shift = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        for _ in range(block):  # a register with a whole block behind it, by its four bytes
            shift = [zero_byte(s) for s in shift]
        self.block, self.flat, self.start, self.shift = block, np.concatenate(rows), np.concatenate(start), shift

    def past_block(self, r: np.ndarray) -> np.ndarray:
        out = self.shift[0][r & np.uint32(255)]
        for k in range(1, 4):
            out = out ^ self.shift[k][(r >> np.uint32(8 * k)) & np.uint32(255)]
        return out

    def crc(self, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The checksums (uint32) of the spans of these lengths that lie one behind the other in ``data``."""
        out = np.zeros(len(lengths), np.uint32)
        full = np.flatnonzero(lengths)  # an empty span has checksum 0
        n = lengths[full]
        if not len(n):
            return out
        blocks = -(-n // self.block)
        head = n - (blocks - 1) * self.block
        span = np.repeat(np.arange(len(n)), blocks)
        nth = np.arange(len(span)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        size = np.where(nth == 0, head[span], self.block)
        ends = np.cumsum(size)
        distance = np.repeat(ends - 1, size) - np.arange(len(data))
        parts = np.bitwise_xor.reduceat(self.flat[distance * 256 + data], ends - size)
        first = np.cumsum(blocks) - blocks
        register = self.start[head] ^ parts[first]
        longer, k = np.flatnonzero(blocks > 1), 1
        while len(longer):
            register[longer] = self.past_block(register[longer]) ^ parts[first[longer] + k]
            k += 1
            longer = longer[blocks[longer] > k]
        out[full] = register ^ ONES
        return out


# --- features ------------------------------------------------------------------------------------

def _word_bytes() -> np.ndarray:
    """0 for a byte outside words, else the byte with A-Z in lower case."""
    at = np.arange(256, dtype=np.uint8)
    word = (at >= 0x80) | ((at >= 0x30) & (at <= 0x39)) | ((at >= 0x61) & (at <= 0x7A))
    upper = (at >= 0x41) & (at <= 0x5A)
    return np.where(upper, at + 32, np.where(word, at, 0)).astype(np.uint8)


def features(texts: list[bytes], lo: int, hi: int, buckets: int, table: PositionTable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of all features, in pieces of bounded size; then one last piece (texts' word
    counts, None)."""
    kinds = _word_bytes()
    counts = np.zeros(len(texts), np.int64)
    at = 0
    while at < len(texts):
        take, size = at, 0
        while take < len(texts) and (take == at or size + len(texts[take]) < CHUNK_BYTES):
            size += len(texts[take]) + 1
            take += 1
        raw = kinds[np.frombuffer(b"\0".join(texts[at:take]) + b"\0", np.uint8)]
        inside = raw != 0
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = edge[::2], edge[1::2]
        borders = np.cumsum([len(t) + 1 for t in texts[at:take]])
        doc = np.searchsorted(borders, starts, side="right")
        counts[at:take] += np.bincount(doc, minlength=take - at)
        inside[ends] = True  # one space behind each word
        raw[ends] = 0x20
        joined = raw[inside]
        sizes = ends - starts
        begin = np.cumsum(sizes + 1) - sizes - 1
        for n in range(lo, hi + 1):
            first = np.arange(max(0, len(starts) - n + 1))
            first = first[doc[first] == doc[first + n - 1]]
            length = begin[first + n - 1] + sizes[first + n - 1] - begin[first]
            cuts = np.searchsorted(np.cumsum(length), np.arange(CHUNK_BYTES, length.sum() + CHUNK_BYTES, CHUNK_BYTES), side="left") + 1
            for a, b in zip(np.r_[0, cuts[:-1]], cuts):
                some = first[a:b]
                if len(some):
                    m = length[a:b]
                    place = np.repeat(begin[some] - np.cumsum(m) + m, m) + np.arange(m.sum())
                    yield at + doc[some], (table.crc(joined[place], m) % np.uint32(buckets)).astype(np.int64)
        at = take
    yield counts, None


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def bucket_counts(texts: DataFrame, lo: int, hi: int, buckets: int) -> dict[int, int]:
    """How many features of all texts (column ``raw``) lie in each bucket; at most ``buckets`` entries."""
    def count(batches):
        table, total = PositionTable(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in features(_texts(batch.column(0)), lo, hi, buckets, table):
                if found is not None:
                    total += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    found = map_batches(texts.select("raw"), count, "bucket bigint, n bigint")
    return {r.bucket: r.n for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int) -> np.ndarray:
    """floor(1000 * log ratio) of the target's share of a bucket to the documents', both plus one."""
    s, t = float(sum(source.values())), float(sum(target.values()))
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1.0) * (s + buckets) / ((source.get(b, 0) + 1.0) * (t + buckets))))
                     for b in range(buckets)], np.int64)


def chance(doc_id: int | None, seed: int) -> int:
    """The Gumbel draw of an id, times 1000, from its digest; an id that is null has no digits."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


# --- the draw ------------------------------------------------------------------------------------

def score(docs: DataFrame, target: DataFrame, lo: int, hi: int, buckets: int, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of ``docs`` (doc_id, raw) against ``target`` (raw)."""
    gains = bucket_gains(bucket_counts(docs, lo, hi, buckets), bucket_counts(target, lo, hi, buckets), buckets)

    def weigh(batches):
        table = PositionTable()
        for batch in batches:
            ids, raws = batch.column(0).to_pylist(), _texts(batch.column(1))
            n, weight = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
            for doc, found in features(raws, lo, hi, buckets, table):
                if found is None:
                    words = doc
                    continue
                n += np.bincount(doc, minlength=len(ids))
                np.add.at(weight, doc, gains[found])
            drawn = weight + np.array([chance(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(x) for x in (words, n, weight, drawn))],
                                             names=["doc_id", "n_words", "n_features", "weight", "score"])

    return map_batches(docs, weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def drawn_ranks(scored: DataFrame, percent: int, least_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3 ... for the share drawn, null for all others.  ``scored`` is a
    written table with ``row``, a number of its own for each row, so equal rows can be dealt apart."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"), F.asc("row")]
    fit = scored.filter(F.col("n_words") >= least_words)
    n = fit.count()
    draw = n * percent // 100
    parts = max(parallelism(scored.sparkSession), -(-n // RANGE_ROWS))
    ranged = written(fit.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "importance-ranges")
    before, ahead = {}, 0
    for r in ranged.groupBy("range").count().orderBy("range").collect():  # one row a range
        if ahead < draw:
            before[r["range"]] = ahead
        ahead += r["count"]
    spark = scored.sparkSession
    fronts = F.broadcast(spark.createDataFrame(list(before.items()), "`range` int, ahead bigint"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) + F.col("ahead")
    ranked = ranged.join(fronts, "range").repartition(parts, "range").withColumn("rank", place).drop("ahead")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    others = ranged.join(fronts, "range", "left_anti").unionByName(scored.filter(F.col("n_words") < least_words), allowMissingColumns=True)
    return ranked.unionByName(others.withColumn("rank", F.lit(None).cast("bigint")))


def importance_resample(docs: DataFrame, target: DataFrame, lo: int = 1, hi: int = 1, buckets: int = 10000, percent: int = 10,
                        least_words: int = 20, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``
    (null unless drawn).

    Words are runs of ASCII digits and letters (A-Z lower-cased) and of all characters beyond ASCII.
    ``floor(percent * N / 100)`` of the N documents with ``least_words`` words are drawn, by score, ties
    to the smaller id; a null id comes last among ties and draws its chance without digits, rows that
    repeat an id draw the same chance.  A null text counts as empty; without features the weight is
    0; an empty table, or an empty target, gives no error; other columns are ignored.
    """
    if not 1 <= lo <= hi or buckets < 1:
        raise ValueError("1 <= lo <= hi and buckets >= 1 expected")
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw")
    rows = pick(docs, id_col, text_col).select(F.col(id_col).cast("bigint").alias("doc_id"), raw)
    scored = score(rows, pick(target, text_col).select(raw), lo, hi, buckets, seed)
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), "importance-scores")
    return drawn_ranks(scored, percent, least_words).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
