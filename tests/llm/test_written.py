import glob
import os
import random
import time

import corpus_pipeline as cp
from pyspark.sql import functions as F
from tests.conftest import SMALL
from tests.llm.test_suffix import brute
from tidewater.llm import common


def shuffled(spark):
    """{file: bytes} of the shuffles that lie on this session's disks."""
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = [f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")]
    return {f: os.path.getsize(f) for f in files if os.path.exists(f)}


def left_of(spark, run, most):
    """What ``run`` returns, and the bytes that its shuffles still hold after it, if over ``most`` after 10 seconds:
    Spark drops files in the background."""
    before = set(shuffled(spark))
    out = run()
    for _ in range(50):
        left = sum(n for f, n in shuffled(spark).items() if f not in before)
        if left <= most:
            break
        time.sleep(0.2)
    return out, left


def test_what_is_written_leaves_no_shuffle(spark):
    """The result of a query that shuffles is read from its files, its shuffles are gone; the session is as before."""
    rows = spark.range(200_000).select((F.col("id") % 50_000).alias("k"), F.xxhash64("id").alias("v"))
    _, held = left_of(spark, lambda: rows.repartition(4, "v").write.format("noop").mode("overwrite").save(), most=1 << 40)
    assert held > 1_000_000  # else nothing is shown below
    out, left = left_of(spark, lambda: common.written(rows.repartition(4, "v").groupBy("k").agg(F.sum(F.lit(1)).alias("n")), "test"), most=0)
    assert left == 0 and out.count() == 50_000 and out.agg(F.sum("n")).first()[0] == 200_000
    assert spark.conf.get(common.DROP_SHUFFLES, None) is None
    spark.conf.set(common.DROP_SHUFFLES, "false")
    common.written(rows.limit(1), "test")
    assert spark.conf.get(common.DROP_SHUFFLES) == "false"
    spark.conf.unset(common.DROP_SHUFFLES)


def test_steps_of_suffix_dedup_leave_no_shuffles(spark, docs_of):
    """Only the last step's shuffles, of the query that reads the result, are held to the end."""
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = prose(400)
    rows = [(i, prose(2000) + line + prose(500)) for i in range(300)]
    docs = common.written(docs_of(rows), "test")
    cut, left = left_of(spark, lambda: cp.cut_repeats(spark, docs, SMALL), most=10_000)
    assert left <= 10_000
    want = brute(rows)
    assert {r.doc_id: r.n_chars for r in cut.collect()} == {i: n - gone for i, (n, gone, *_) in want.items()}
    assert sum(gone for _, gone, *_ in want.values()) >= 299 * 400
