"""Nearest neighbours by multiprobe p-stable hashing (operator 8).

A table's functions project a vector on Gaussian directions and cut each projection into cells;
the cells together name a bucket.  A query visits its own buckets and then perturbed ones, each
one cell off in some functions, in the order of their estimated success: the sum of squared
distances to the crossed cell borders, merged over the tables.  All candidates are ranked by their
exact distances.

Equal vectors are one entry with their smallest ids, so a vector that a third of all rows share
costs one comparison, and buckets larger than BLOCK are split, so no task holds more than its
share.  A query whose buckets hold fewer than k others, far from the mass or in a table of few
vectors, is compared with all rows, part by part.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, parallelism, pick, written

TABLES, FUNCTIONS, WIDTH = 3, 6, 1.5
#: Distinct vectors and queries that the cell width and the number of probes are fitted on, and
#: the recall aimed at there (neighbours in a sample are further away, so all rows reach more).
SAMPLE, SAMPLE_QUERIES, RECALL = 2048, 64, 0.96
BLOCK = 20_000
#: Entries of a part: a query's results are gathered from every part that it visits, so parts are
#: not made smaller than the first, nor larger than the second.
PART_LEAST, PART_MOST = 5_000, 100_000


@dataclass
class Hashing:
    """Directions (tables x functions x dimension), shifts, cell width and probes a query."""
    directions: np.ndarray
    shifts: np.ndarray
    width: float
    probes: int
    names: np.ndarray  # tables x functions: odd 64-bit numbers; a bucket's key is their sum weighted by its cells

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Real-valued cells (rows x tables x functions)."""
        return np.einsum("nd,tfd->ntf", x, self.directions) / self.width + self.shifts

    def keys(self, cells: np.ndarray) -> np.ndarray:
        """Bucket keys (rows x tables) of whole cells, modulo 2^64: cells of any size have a key, and
        one cell further in a function adds that function's number."""
        table = np.arange(cells.shape[1], dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        return ((cells.astype(np.int64).view(np.uint64) * self.names).sum(axis=2, dtype=np.uint64) + table).view(np.int64)

    def probe_keys(self, x: np.ndarray, most: int) -> list[list[int]]:
        """For each row the keys of the buckets to visit, in estimated order of success."""
        real = self.cells(x)
        base = np.floor(real)
        own, at = self.keys(base), real - base
        functions = real.shape[2]
        out = []
        for n in range(len(x)):
            sequences = [self._perturbed(int(own[n, t]), at[n, t], functions, t) for t in range(real.shape[1])]
            merged = heapq.merge(*sequences)
            out.append([key for _, (_, key) in zip(range(most), merged)])
        return out

    def _perturbed(self, own: int, at: np.ndarray, functions: int, table: int = 0):
        """(score, key) in rising order: sets of border crossings, grown from the cheapest one by
        exchanging the last crossing for the next dearer or adding that."""
        yield 0.0, own
        add = self.names[table].astype(object)
        moves = sorted([(float(at[f]) ** 2, f, -1) for f in range(functions)]
                       + [((1 - float(at[f])) ** 2, f, 1) for f in range(functions)])
        heap = [(moves[0][0], (0,))] if moves else []
        while heap:
            score, chosen = heapq.heappop(heap)
            z = chosen[-1]
            if z + 1 < len(moves):
                heapq.heappush(heap, (score - moves[z][0] + moves[z + 1][0], chosen[:-1] + (z + 1,)))
                heapq.heappush(heap, (score + moves[z + 1][0], chosen + (z + 1,)))
            crossed = [moves[c][1] for c in chosen]
            if len(set(crossed)) == len(crossed):
                key = (own + sum(moves[c][2] * add[moves[c][1]] for c in chosen)) % (1 << 64)
                yield score, key - ((key >> 63) << 64)


def fit(sample: np.ndarray, k: int, seed: int = 7) -> Hashing:
    """Directions, cell width and number of probes from a bounded sample of distinct vectors."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    width = WIDTH * float(np.sqrt(sample.var(axis=0).sum())) or 1.0
    every = TABLES * 3**FUNCTIONS  # all buckets one cell off
    names = rng.integers(0, 1 << 63, (TABLES, FUNCTIONS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    hashing = Hashing(rng.normal(size=(TABLES, FUNCTIONS, dim)), rng.uniform(size=(TABLES, FUNCTIONS)), width, every, names)
    keys = hashing.keys(np.floor(hashing.cells(sample)))
    queries = sample[:SAMPLE_QUERIES]
    needed = []
    for q, (x, probes) in enumerate(zip(queries, hashing.probe_keys(queries, every))):
        near = np.argsort(((sample - x) ** 2).sum(axis=1), kind="stable")
        when = {key: i for i, key in reversed(list(enumerate(probes)))}
        for c in [c for c in near if c != q][:k]:
            needed.append(min(when.get(int(key), every) for key in keys[c]))
    needed.sort()
    if needed:
        hashing.probes = min(every, needed[int(len(needed) * RECALL)] + 1)
    return hashing


def _matrix(column) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), id and ``score`` (Euclidean distance in double precision)
    of each query's ``k`` nearest found rows other than itself, ties to the smaller id.

    ``queries`` has the columns of ``vectors`` and must be a part of it.  Null vectors, zero
    vectors, and those holding null or non-finite components take no part, nor do rows with a
    null id; of vectors of several lengths the most frequent length is searched.  Repeated rows
    count once; an empty table gives an empty result; other columns are ignored.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    v_type = vectors.schema[vector_col].dataType.simpleString()

    def sound(df):
        df = pick(df, id_col, vector_col).select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
        finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite
                         & F.exists("v", lambda x: x != 0))

    rows = sound(vectors)
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    result = f"query_id {id_type}, rank int, {id_col} {id_type}, score double"
    if not lengths:
        return spark.createDataFrame([], result)
    dim = lengths[0].d
    rows = rows.filter(F.size("v") == dim).distinct()
    nth = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    distinct = written(rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
                           .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # k + 1 at most
                           .select(F.col("ids")[0].alias("rid"), "v", "ids"), "vector-distinct")
    n = distinct.count()
    sample = distinct.select("v").orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).collect()
    hashing = fit(np.array([r.v for r in sample], dtype=np.float64), k)
    asked = written(sound(queries).filter(F.size("v") == dim).distinct(), "vector-queries")
    searched = asked.select("v").distinct().join(distinct.select("v", F.col("rid").alias("qid")), "v")

    def index(batches):
        for batch in batches:
            keys = hashing.keys(np.floor(hashing.cells(_matrix(batch.column(1)))))
            at = pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1]))
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), batch.column(0).take(at), batch.column(1).take(at)],
                                             names=["bucket", "rid", "v"])

    def probe(batches):
        for batch in batches:
            visits = hashing.probe_keys(_matrix(batch.column(1)), hashing.probes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(visits, pa.list_(pa.int64()))], names=["qid", "buckets"])

    entries = map_batches(distinct.select("rid", "v"), index, f"bucket bigint, rid {id_type}, v {v_type}")
    held = written(entries.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "vector-buckets")
    parts = max(1, min(max(parallelism(spark), n * TABLES // PART_MOST), n * TABLES // PART_LEAST))
    # a block of a bucket lies in one part; a query goes to each part that holds one of its blocks
    part = lambda block: F.pmod(F.xxhash64("bucket", block), F.lit(parts)).cast("int").alias("part")
    stored = entries.join(held, "bucket").select(part(F.pmod(F.xxhash64("rid"), "blocks").cast("int")), "bucket", "rid", "v")
    visits = (map_batches(searched.select("qid", "v"), probe, f"qid {id_type}, buckets array<bigint>")
              .select("qid", F.explode("buckets").alias("bucket")).join(held, "bucket")
              .select("qid", "bucket", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
              .select("qid", "bucket", part(F.col("block"))).groupBy("qid", "part").agg(F.collect_set("bucket").alias("buckets")))
    asking = visits.join(searched, "qid").select("part", "buckets", F.col("qid").alias("rid"), "v")

    def met(stored: DataFrame, asking: DataFrame, parts: int) -> DataFrame:
        """Entries (part, bucket, rid, v) and queries (part, buckets, rid, v), brought together by part."""
        both = (stored.select("part", F.array("bucket").alias("buckets"), "rid", "v", F.lit(0).alias("kind"))
                      .unionByName(asking.withColumn("kind", F.lit(1)))
                      .repartition(parts, "part").sortWithinPartitions("part", "kind", "buckets", "rid"))
        return map_batches(both, search, f"qid {id_type}, rid {id_type}, score double")

    def search(batches):
        now, store, made = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            part, kind = batch.column(0).to_numpy(), batch.column(4).to_numpy()
            cuts = np.r_[0, np.flatnonzero((part[1:] != part[:-1]) | (kind[1:] != kind[:-1])) + 1, len(part)]
            for s, e in zip(cuts[:-1], cuts[1:]):
                piece = batch.slice(s, e - s)
                if part[s] != now:
                    now, store, made = part[s], [], None
                if not kind[s]:
                    store.append((piece.column(1).flatten().to_numpy(), piece.column(2), _matrix(piece.column(3))))
                    continue
                if made is None and store:
                    keys, x = np.concatenate([p[0] for p in store]), np.concatenate([p[2] for p in store])
                    rids = pa.concat_arrays([p[1] for p in store])
                    made = keys, rids, x, np.unique(rids.to_numpy(zero_copy_only=False), return_inverse=True)[1]
                    store = []
                if made is None:
                    continue
                keys, rids, x, codes = made
                out_q, out_r, out_d = [], [], []
                for i, (q, wanted) in enumerate(zip(_matrix(piece.column(3)), piece.column(1).to_pylist())):
                    if wanted is None:  # every entry of the part
                        at = np.arange(len(keys))
                    else:
                        wanted = np.array(wanted)
                        lo, hi = np.searchsorted(keys, wanted, "left"), np.searchsorted(keys, wanted, "right")
                        at = np.concatenate([np.arange(a, b) for a, b in zip(lo, hi)] or [np.array([], int)])
                    if not len(at):
                        continue
                    at = at[np.unique(codes[at], return_index=True)[1]]  # once, if found in several tables
                    d = np.sqrt(((x[at] - q) ** 2).sum(axis=1))
                    best = np.lexsort((codes[at], d))[:k + 1]  # codes follow the ids
                    at, d = at[best], d[best]
                    out_q.append(np.full(len(at), i)), out_r.append(at), out_d.append(d)
                if out_q:
                    yield pa.RecordBatch.from_arrays([piece.column(2).take(pa.array(np.concatenate(out_q))), rids.take(pa.array(np.concatenate(out_r))),
                                                      pa.array(np.concatenate(out_d))], names=["qid", "rid", "score"])

    hashed = written(met(stored, asking, parts), "vector-hashed")
    enough = hashed.groupBy("qid").agg(F.count_distinct("rid").alias("n")).filter(F.col("n") > k).select("qid")
    short = written(searched.join(enough, "qid", "left_anti"), "vector-short")
    found = hashed
    if not short.isEmpty():  # too few found: against all rows, each part of which sees these queries
        whole = max(1, min(max(parallelism(spark), n // PART_MOST), n // PART_LEAST))
        rows_of = distinct.select(F.pmod(F.xxhash64("rid"), F.lit(whole)).cast("int").alias("part"), F.lit(0).cast("bigint").alias("bucket"), "rid", "v")
        asks = short.select(F.explode(F.sequence(F.lit(0), F.lit(whole - 1))).alias("part"), F.lit(None).cast("array<bigint>").alias("buckets"),
                            F.col("qid").alias("rid"), "v")
        found = hashed.unionByName(met(rows_of, asks, whole))
    found = found.groupBy("qid", "rid").agg(F.min("score").alias("score"))
    best = lambda by, *order: F.row_number().over(Window.partitionBy(by).orderBy(*order))
    found = found.withColumn("nth", best("qid", "score", "rid")).filter(F.col("nth") <= k + 1).drop("nth")
    listed = (found.join(distinct.select("rid", "ids"), "rid").select("qid", "score", F.explode("ids").alias("id"))
                   .withColumn("nth", best("qid", "score", "id")).filter(F.col("nth") <= k + 1)
                   .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near")))  # k + 1 at most
    answers = asked.join(searched, "v").select("id", "qid").join(listed, "qid")
    near = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    return (answers.select(F.col("id").alias("query_id"), F.posexplode(near).alias("pos", "hit"))
                   .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.id").alias(id_col), F.col("hit.score").alias("score")))
