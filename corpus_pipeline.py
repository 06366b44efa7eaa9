"""The corpus pipeline: documents pass the stages in order, each written and read again.

``STAGES`` names the stages, ``run`` applies them to the table ``documents``.  Every stage takes
``(spark, docs, sf_dir)``; all but the last return the columns of ``documents``.  Every row is decided on its
own: rows travel through an operator whole, or are known by id and text, so rows without an id, or
that repeat one, do not share each other's fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.common import pick, table, written
from tidewater.llm.exact_dedup import exact_dedup
from tidewater.llm.language_crf import UNKNOWN, predict, train, training_segments
from tidewater.llm.near_dedup import near_dedup
from tidewater.llm.packing import pack
from tidewater.llm.suffix_dedup import suffix_dedup

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose language is less probable than this is rejected.
LEAST_SCORE = 0.5
#: Repeated ids that are broadcast at most.
MOST_BROADCAST = 100_000


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents without a letter, or whose words agree on no language, go."""
    docs = _keyed(pick(docs, *COLUMNS))
    segments = training_segments(docs, "doc_id", "text", "lang")
    found = predict(docs.withColumn("_key", F.struct(*KEY)), train(segments) if segments else None, "_key", "text")
    kept = found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("_key.*").distinct()
    return docs.join(kept, KEY, "left_semi").select(*COLUMNS)


#: What a row is known by: its id, whether it has one, and two hashes of its text.
KEY = ["_id", "_none", "_t", "_t2"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("*", F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"),
                       F.xxhash64(text).alias("_t"), F.xxhash64(F.lit(1), text).alias("_t2"))


def _one_each(docs: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """The documents whose ``keys`` are among ``kept``; of rows with the same keys, one."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("n_chars", "lang", "source"))
    return docs.join(kept.distinct(), keys).withColumn("_nth", nth).filter("_nth = 1").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of equal texts the row with the largest id stays, of rows that repeat it one; a row
    without an id stays only if all rows of its text have none."""
    docs = _keyed(pick(docs, *COLUMNS))
    found = exact_dedup(docs.select(F.struct("doc_id", *KEY).alias("id"), "text"), id_col="id")
    return _one_each(docs, found.filter("kept").select(*[F.col(f"doc_id.{k}").alias(k) for k in KEY]), KEY)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of every group of near copies the row with the smallest id stays; documents without
    an id take no part and stay."""
    docs = pick(docs, *COLUMNS)
    named = docs.filter("doc_id is not null")
    twice = written(named.groupBy("doc_id").count().filter("count > 1").select("doc_id", F.lit(True).alias("_twice")), "pipeline-twice")
    if (n := twice.count()) == 0:
        named = named.withColumn("_row", F.col("doc_id"))
    else:  # rows that share an id are known by a number from their text, above all ids
        own = F.shiftrightunsigned(F.xxhash64("doc_id", F.coalesce("text", F.lit(""))), 2).bitwiseOR(1 << 61)
        named = named.join(F.broadcast(twice) if n <= MOST_BROADCAST else twice, "doc_id", "left")
        named = named.withColumn("_row", F.when(F.col("_twice"), own).otherwise(F.col("doc_id"))).drop("_twice")
    found = near_dedup(named.select("_row", "text"), id_col="_row").select("_row", "component_id")
    first = found.join(named.select("_row", "doc_id"), "_row").groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("first"))
    kept = _one_each(named, first.select("first._row"), ["_row"])
    return kept.unionByName(docs.filter("doc_id is null").select(*COLUMNS))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: repeated byte strings are cut out of the texts and ``n_chars`` follows; bytes of
    a character cut in two go with it.  Every document stays, if only with an empty text."""
    docs = pick(docs, *COLUMNS).withColumn("_none", F.col("text").isNull())
    cut = suffix_dedup(docs, carry=("lang", "source", "n_chars", "_none"), as_text=True)
    length = F.when(F.col("n_removed") > 0, F.char_length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", F.when(~F.col("_none"), F.col("kept_text")).alias("text"), "lang", "source", length.alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the places of the remaining documents' pieces in sequences."""
    return pack(docs)


STAGES = [("language_id", keep_languages), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
          ("suffix_dedup", cut_repeats), ("best_fit_packing", pack_sequences)]

#: Language models, suffix sorting and packing cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
