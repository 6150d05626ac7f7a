"""Token counts of whole texts (10)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from headway.llm.common import pick, slices, table, texts_of
from headway.llm.tokens import encoder, vocabulary

LIMIT = 512


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    limit: int = LIMIT,
) -> DataFrame:
    """Bytes and tokens of each row's whole text: `id_col`, n_bytes, n_tokens, over_limit.

    Texts cross to Arrow functions in batches of about equal size, long ones are cut at safe places,
    and only lengths come back. A null text counts as empty: 0 bytes, 0 tokens. Rows with equal or
    null ids stay separate rows; other columns of the input are ignored; no rows give no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = encoder(vocabulary(tokenizer))
        for batch in slices(batches, "c1"):
            n = counter.count(texts_of(batch.column("c1")))
            size = pc.fill_null(pc.binary_length(batch.column("c1")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("c0"), size, pa.array(n), pa.array(np.greater(n, limit))],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{id_col}` {kind}, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN"
    return pick(docs, id_col, text_col).mapInArrow(count, schema)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
