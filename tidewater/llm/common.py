"""Helpers shared by the operators: column picking, Arrow-batch mapping, scratch folders."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Most records and bytes of one Arrow batch handed to a Python task, so a task's memory does
#: not follow the lengths of the texts.
BATCH_RECORDS = 1000
BATCH_BYTES = 16 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, by exact name; other columns, also ones whose names clash or
    differ by case alone, are dropped (the first exact match counts)."""
    at = {}
    for i, c in enumerate(df.columns):
        at.setdefault(c, i)
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"_c{at[n]}").alias(n) for n in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """The fold kept out of training: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def lowest_ids(rows: DataFrame, by: str, limit: int) -> DataFrame:
    """(id, ``by``): per value of ``by`` the ``limit`` distinct ids that hash lowest.

    Only ids whose hash lies in the share of the hash range that holds about twice ``limit`` of
    them reach the ranking, so a value with a third of all rows sends it no more than others.
    """
    ids = rows.select("id", by).distinct()
    held = ids.groupBy(by).agg(F.count("*").alias("held"))
    place = F.shiftrightunsigned(F.xxhash64("id"), 11) / F.lit(float(1 << 53))
    low = ids.join(held, by).withColumn("place", place).filter(F.col("place") * F.col("held") < 2 * limit + 100)
    nth = F.row_number().over(Window.partitionBy(by).orderBy("place", "id"))
    return low.withColumn("nth", nth).filter(F.col("nth") <= limit).select("id", by)


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch limits to the bounds above (never raise them)."""
    def lower(key: str, most: int) -> None:
        now = spark.conf.get(key, None)
        if now is None or not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))
    lower("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_RECORDS)
    lower("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once per application, so that their workers
    can import it wherever it lies on the driver."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="tidewater-code-"), "tidewater_code.zip")
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(name)
    _shipped.add(sc.applicationId)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str) -> DataFrame:
    small_batches(df.sparkSession)
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidewater-llm-")  # a local session, as in tests
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Spark drops the shuffle files of a query when it ends; else they stay until the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back: lineage is cut by files
    that every executor can read, so a lost executor costs nothing that was written.  What was
    shuffled for it goes when it is written, so no more than one step's shuffles lie on the disks."""
    spark = df.sparkSession
    path, before = shared_dir(spark, label), spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def split_join(rows: DataFrame, side: DataFrame, keys: list[str], total: int | None = None) -> DataFrame:
    """``rows`` joined with ``side``, which has for each key its number of rows ``n``.  Keys with over a
    thousandth of all rows (``total``, else the sum of ``n``), at most a thousand, are broadcast, so that no
    task gets one of them whole."""
    if total is None:
        total = side.agg(F.sum("n").alias("n")).first()["n"] or 0
    bound = total // 1000
    heavy = F.broadcast(side.filter(F.col("n") > bound))
    return rows.join(heavy, keys).unionByName(rows.join(heavy, keys, "left_anti").join(side.filter(F.col("n") <= bound), keys))


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
