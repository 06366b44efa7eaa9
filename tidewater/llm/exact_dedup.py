"""Exact deduplication over an extendible-hash index on shared files (operator 9).

DataFrame functions only.  The index is built in four steps:

1. rows are combined on (64-bit hash, whole text): equal texts meet byte for byte, copies
   collapse on the map side, so a text that a third of all rows share is one entry a task;
2. the directory starts with one bucket and doubles wherever a bucket holds more than
   ``capacity`` entries: the counts of the hash prefixes of all depths give every bucket's
   local depth at once;
3. owner tasks take ranges of (bucket, hash) and chain the entries whose hash collides;
4. directory and index go to the shared folder; every row finds its bucket in the directory by
   the first bits of its hash, and its entry in that bucket by hash and text digest.

Texts and cells that hold more than a thousandth of all rows, fewer than a thousand of them, are
broadcast in both look-ups, so a text that a third of all rows share never meets in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.llm.common import parallelism, pick, split_join, written

CAPACITY = 1 << 16


def cell_of(depth: int) -> Column:
    """The cell of the directory that hash ``h`` points into: its first ``depth`` bits."""
    return F.shiftrightunsigned("h", 64 - depth).alias("cell")


def directory(entries: DataFrame, depth: int, capacity: int) -> DataFrame:
    """(cell, bucket, local_depth) for every hash prefix of ``depth`` bits in use: the shortest
    prefix whose bucket is not overfull, or the whole cell.  At most 2**depth rows."""
    cells = entries.groupBy(cell_of(depth)).agg(F.count("*").alias("n"))
    at = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"))
    # a prefix of d bits, written as the first cell of its range
    prefix = F.expr(f"shiftleft(shiftright(cell, {depth} - d), {depth} - d)")
    at = at.withColumn("bucket", prefix)
    sums = at.groupBy("d", "bucket").agg(F.sum("n").alias("held"))
    fits = F.when((F.col("held") <= capacity) | (F.col("d") == depth), F.struct("d", "bucket"))
    return (at.drop("n").join(sums, ["d", "bucket"]).groupBy("cell").agg(F.min(fits).alias("b"))
              .select("cell", F.col("b.bucket").alias("bucket"), F.col("b.d").alias("local_depth")))


def build_index(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id",
                text_col: str = "text") -> tuple[int, DataFrame, DataFrame]:
    """The directory's depth, the directory and the index, both read back from the shared folder.

    The directory has ``cell``, ``bucket``, ``local_depth`` and the number ``n`` of rows in the cell; the index
    one row per distinct text with ``bucket``, ``h``, ``chain`` (place among texts of equal hash),
    ``text_sha256``, ``keep_id`` and the number ``n`` of rows with that text."""
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    entries = written(
        keyed.groupBy("h", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))
             .select("h", F.sha2("text", 256).alias("text_sha256"), "keep_id", "n"), "exact-entries")
    # twice the depth that even buckets need, so that uneven ones can split further
    depth = max(1, min(40, 4 + math.ceil(math.log2(max(1, entries.count()) / capacity + 1))))
    held = entries.groupBy(cell_of(depth)).agg(F.sum("n").alias("n"))
    cells = written(directory(entries, depth, capacity).join(held, "cell"), "exact-directory")
    owned = (entries.select("*", cell_of(depth)).join(cells.select("cell", "bucket"), "cell").drop("cell")
                    .repartitionByRange(parallelism(spark), "bucket", "h"))
    chain = F.row_number().over(Window.partitionBy("bucket", "h").orderBy("text_sha256"))
    return depth, cells, written(owned.withColumn("chain", chain), "exact-index")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (pick(docs, id_col, text_col).select(F.col(id_col).alias("doc_id"), text.alias("text"))
            .withColumn("h", F.xxhash64("text")))


def exact_dedup(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id`` (largest id among equal texts),
    ``group_size``, ``kept``, ``text_sha256``, and the entry's ``bucket`` and ``chain``.

    A null text counts as empty; a null id never stays while its group has another id, and stays
    if the whole group has none; repeated rows (same id and text) get the same decision.  An
    empty table gives an empty result; other columns are ignored.
    """
    depth, cells, index = build_index(docs, capacity, id_col, text_col)
    rows = written(_keyed(docs, id_col, text_col).select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"), cell_of(depth)), "exact-rows")
    found = split_join(rows, cells.select("cell", "bucket", "n"), ["cell"]).drop("n")
    return (split_join(found, index, ["bucket", "h", "text_sha256"])
            .select("doc_id", "keep_id", F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256", "bucket", "chain"))
