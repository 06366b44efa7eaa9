"""Shards along a Hilbert curve over several metadata dimensions (operator 10)."""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import map_batches, parallelism, pick, written

BITS = 5
DIMENSIONS = ("source", "lang", "n_chars")


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (n x d, unsigned, below 2**bits).

    From the highest bit down, each axis' bit either flips the lower bits of the first axis or
    exchanges them with its own, which turns every sub-cube the way the curve enters it; the Gray
    code of the turned bits, read across the axes, is the index.
    """
    x = cells.astype(np.uint64).copy()
    n, d = x.shape
    for b in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for i in range(d):
            up = (x[:, i] & bit) != 0
            swap = np.where(up, np.uint64(0), (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(up, low, swap)
            x[:, i] ^= swap
    for i in range(1, d):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(n, dtype=np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, d - 1] & np.uint64(1 << b), np.uint64((1 << b) - 1), np.uint64(0))
    x ^= turn[:, None]
    out = np.zeros(n, dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << np.uint64(1)) | ((x[:, i] >> np.uint64(b)) & np.uint64(1))
    return out.astype(np.int64)


def _is_text(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StringType, T.BinaryType))


def text_cuts(meta: DataFrame, dims: list[str], cells: int) -> list[list[str]]:
    """Quantiles of text dimensions (whole values) over all rows.  Values are counted, ranged in order and
    numbered by position; the driver gets the values at the ``cells`` - 1 cuts."""
    out = []
    for x in dims:
        counts = meta.filter(F.col(x).isNotNull()).groupBy(x).agg(F.count(F.lit(1)).alias("n"))
        ranged = counts.repartitionByRange(parallelism(meta.sparkSession), x).withColumn("part", F.spark_partition_id())
        ranged = written(ranged, "shard-values")
        # one row per task of the ranging
        held = ranged.groupBy("part").agg(F.sum("n").alias("held"))
        held = held.select("part", F.coalesce(F.sum("held").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                           F.sum("held").over(Window.partitionBy()).alias("total"))
        upto = F.col("before") + F.sum("n").over(Window.partitionBy("part").orderBy(x).rowsBetween(Window.unboundedPreceding, 0))
        placed = ranged.join(F.broadcast(held), "part").withColumn("upto", upto)
        # cut i is the value at position i * total div cells
        spans = placed.select(x, F.expr(f"greatest(1, ((upto - n) * {cells} + total - 1) div total)").alias("first"),
                              F.expr(f"least({cells - 1}, (upto * {cells} + total - 1) div total - 1)").alias("last"))
        found = sorted((r["first"], r["last"], r[x]) for r in spans.filter("first <= last").collect())
        out.append([value for first, last, value in found for _ in range(first, last + 1)])
    return out


def hilbert_shards(docs: DataFrame, n_shards: int = 16, law: str = "rows",
                   dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``size`` (UTF-8 bytes plus 1), ``text_crc32``, ``law``,
    ``shard``, ``slot`` (place in the shard, from 0), ``grown_shard`` (null under these laws) and
    ``curve`` (the Hilbert index).

    Each dimension is cut at its quantiles into 2**bits cells; the rows are range-partitioned by
    (curve, crc32, id), so rows of one cell can lie in several tasks however many there are, and
    runs are cut by position (law ``rows``: counts at most one apart) or by bytes before the row
    (law ``bytes``).  The driver sees the quantiles only; one row per task gives the offsets.

    Null text has no bytes; a null dimension lies in cell 0; null ids and repeated rows each
    get a slot of their own; an empty table gives an empty result; other columns are ignored.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law {law!r}: rows or bytes")
    spark = docs.sparkSession
    src = pick(docs, id_col, text_col, *dimensions)
    dims = [f"x{i}" for i in range(len(dimensions))]
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    meta = written(src.select(
        F.col(id_col).alias("id"), (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("crc"),
        *[F.col(c).cast("string" if _is_text(src.schema[c].dataType) else "double").alias(x) for c, x in zip(dimensions, dims)]), "shard-meta")
    texts = [x for c, x in zip(dimensions, dims) if _is_text(src.schema[c].dataType)]
    numbers = [x for x in dims if x not in texts]
    found = meta.agg(F.lit(0).alias("none"), *[F.percentile_approx(x, [i / 2**bits for i in range(1, 2**bits)], 1000).alias(x) for x in numbers]).first()
    known = dict(zip(texts, text_cuts(meta, texts, 2**bits))) | {x: found[x] or [] for x in numbers}
    cuts = [known[x] for x in dims]  # equal cuts spread frequent values over the axis

    def curve(batches):
        for batch in batches:
            cells = np.zeros((batch.num_rows, len(cuts)), dtype=np.uint64)
            for i, cut in enumerate(cuts):
                column = batch.column(3 + i)
                if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
                    column = column.dictionary_encode()
                    cell = np.array([bisect_right(cut, x) for x in column.dictionary.to_pylist()] + [0])
                    cells[:, i] = cell[column.indices.fill_null(len(cell) - 1).to_numpy()]
                else:
                    x = column.to_numpy(zero_copy_only=False).astype(float)
                    cells[:, i] = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.searchsorted(np.array(cut, float), x, side="right"), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(hilbert_index(cells, bits), pa.int64())],
                                             names=["id", "size", "crc", "curve"])

    def number(batches):
        part, n, held = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            before = held + np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int32()),
                 pa.array(np.arange(n, n + batch.num_rows), pa.int64()), pa.array(before, pa.int64())],
                names=["id", "size", "crc", "curve", "part", "nth", "bytes"])
            n, held = n + batch.num_rows, held + int(sizes.sum())

    id_type = src.schema[id_col].dataType.simpleString()
    on_curve = map_batches(meta, curve, f"id {id_type}, size bigint, crc bigint, curve bigint")
    ordered = on_curve.repartitionByRange(parallelism(spark), "curve", "crc", "id").sortWithinPartitions("curve", "crc", "id")
    ordered = written(map_batches(
        ordered, number, f"id {id_type}, size bigint, crc bigint, curve bigint, part int, nth bigint, bytes bigint"), "shard-order")

    # one row per task of the sort
    parts = ordered.groupBy("part").agg(F.count("*").alias("n"), F.sum("size").alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                         F.coalesce(F.sum("held").over(before), F.lit(0)).alias("held0"),
                         F.sum("n").over(every).alias("n_all"), F.sum("held").over(every).alias("held_all"))
    placed = (ordered.join(F.broadcast(parts), "part")
              .withColumn("pos", F.col("n0") + F.col("nth")).withColumn("at", F.col("held0") + F.col("bytes")))
    if law == "rows":
        placed = (placed.withColumn("shard", F.expr(f"cast(pos * {n_shards} div n_all as int)"))
                        .withColumn("slot", F.expr(f"pos - (shard * n_all + {n_shards - 1}) div {n_shards}")))
    else:
        placed = placed.withColumn("shard", F.expr(f"cast(at * {n_shards} div held_all as int)"))
        first = placed.groupBy("shard").agg(F.min("pos").alias("first_pos"))  # n_shards rows
        placed = placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("pos") - F.col("first_pos"))
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit(law).alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, placement: DataFrame, path: str, id_col: str = "doc_id",
                 files_per_shard: int = 8) -> None:
    """Write the documents as Parquet, a folder per shard and rows in curve order inside each
    file, so that a file's column statistics bound every dimension.  ``id_col`` must be unique."""
    at = placement.select(F.col(id_col).alias("__id"), "shard", "slot", "curve")
    rows = docs.join(at, docs[id_col] == at["__id"]).drop("__id")
    n = placement.select("shard").distinct().count() * files_per_shard
    (rows.repartitionByRange(max(1, n), "shard", "slot").sortWithinPartitions("shard", "slot")
         .write.partitionBy("shard").parquet(path))
