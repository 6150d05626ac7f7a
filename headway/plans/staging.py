"""Stage tables: written once to the shared checkpoint folder, then read as plain Parquet.

A stage cuts lineage in a way that survives lost executors. It also gives the optimizer an exact
table size: Spark broadcasts a staged table only while its files stay under
`spark.sql.autoBroadcastJoinThreshold`, and falls back to a sort-merge join (with adaptive skew
splitting) beyond it. The library therefore needs no broadcast hints on data of unknown size.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_roots: dict[str, str] = {}

#: Bytes of a row group of stage tables, and of what one task reads inside `small_splits`.
GROUP_BYTES = 16 << 20
_SPLIT = "spark.sql.files.maxPartitionBytes"
#: Bytes of code beyond which the JVM leaves a method uncompiled.
METHOD_BYTES = 8000
_METHOD = "spark.sql.codegen.hugeMethodLimit"


def stage_root(spark: SparkSession) -> str:
    """A folder of this application below the cluster's checkpoint folder."""
    app = spark.sparkContext.applicationId
    if app not in _roots:
        shared = spark.conf.get(_SETTING, None)
        if not shared:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
            shared = tempfile.mkdtemp(prefix="headway-")
        _roots[app] = f"{shared.rstrip('/')}/headway-{app}-{uuid.uuid4().hex[:8]}"
    return _roots[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def stage(df: DataFrame, name: str, month_of: str | None = None, group: int = GROUP_BYTES) -> DataFrame:
    """Write `df` to a new stage table, in row groups of `group` bytes, and read it back.

    With `month_of` the table is partitioned by that date column's month. The rebalance hint sizes
    the files and lets adaptive execution split a month that holds far more rows than the others.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if month_of is None:
        df.write.option("parquet.block.size", group).parquet(path)
    else:
        by_month = df.selectExpr("*", f"date_format({month_of}, 'yyyy-MM') AS {month_of}_month")
        key = f"{month_of}_month"
        by_month.hint("rebalance", key).write.partitionBy(key).parquet(path)
    return spark.read.parquet(path)


@contextmanager
def small_splits(spark: SparkSession, size: int = GROUP_BYTES) -> Iterator[None]:
    """Jobs that run inside read files in parts of `size` bytes.

    Stage tables are compressed and dictionary-coded, so a usual part holds many times its bytes of
    rows. Tasks that sort or keep what they read take smaller ones, at any size of the table.
    """
    with _held(spark, _SPLIT, size):
        yield


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside handle a row of very many columns in several small methods.

    Spark otherwise makes one method of them, which the JVM only interprets if it is a large one.
    """
    with _held(spark, _METHOD, METHOD_BYTES):
        yield


@contextmanager
def _held(spark: SparkSession, setting: str, value: int) -> Iterator[None]:
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(value))
    try:
        yield
    finally:
        spark.conf.set(setting, before)
