"""Token counts by heap-and-linked-list byte-pair merging (operator 1)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import map_batches, pick
from tidewater.llm.wordbpe import counter, default_tokenizer

LIMIT = 2048


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    One narrow pass, no shuffle: whole texts are cut into chunks, each chunk's tokens are counted
    by merging (:func:`wordbpe.count_after_merges`), repeated chunks are looked up.  A null text
    counts as empty (0 bytes, 0 tokens), a null id stays null, repeated rows are counted each for
    itself, an empty table gives an empty result, and other columns are ignored.
    """
    path = tokenizer or default_tokenizer()
    source = pick(docs, id_col, text_col)
    id_type = source.schema[id_col].dataType.simpleString()

    def run(batches):
        count = counter(path).count
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens = [count(t) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    sized = source.withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("bigint"))
    return map_batches(sized, run, f"`{id_col}` {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
