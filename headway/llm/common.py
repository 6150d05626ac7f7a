"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts handled together inside a task hold about this many characters.
BATCH_CHARS = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, under positional names that no other column can clash with."""
    return df.select(*(F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(columns)))


def release() -> None:
    """Give memory that earlier tasks of this worker no longer use back to the system.

    Workers live on between the stages of a job, and an executor's limit counts all of them.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a column; null counts as empty."""
    return ["" if text is None else text for text in column.to_pylist()]


def by_chars(texts: Iterable[str], limit: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Consecutive texts in lists of about `limit` characters."""
    batch: list[str] = []
    size = 0
    for text in texts:
        if batch and size + len(text) > limit:
            yield batch
            batch, size = [], 0
        batch.append(text)
        size += len(text)
    if batch:
        yield batch


def slices(
    batches: Iterable[pa.RecordBatch], column: str, limit: int = BATCH_CHARS
) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose `column` of texts holds about `limit` characters."""
    release()
    for batch in batches:
        start = 0
        for texts in by_chars(texts_of(batch.column(column)), limit):
            yield batch.slice(start, len(texts))
            start += len(texts)
