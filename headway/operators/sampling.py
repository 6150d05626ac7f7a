"""Seeded samples and train/test splits that do not depend on how the data is partitioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from headway.functions.core import HASH_RANGE, flag, portable_hash

BUCKETS = 65536


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """`n` rows in seeded hash order of the key. Each task keeps only its own first `n`."""
    return df.orderBy(portable_hash(F.col(key), seed), F.col(key)).limit(n)


def split_random(df: DataFrame, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `is_test`, decided row by row from the key's hash: no shuffle."""
    return df.withColumn("is_test", flag(portable_hash(F.col(key), seed) < share * HASH_RANGE))


def _lookup(table: DataFrame, by: str, *columns: str) -> Column:
    """A table of one row per class as a map from class to its columns, read as a scalar subquery.

    Joining on a class label would send half of the rows to one task; a map needs no join.
    """
    entries = F.collect_list(F.struct(F.col(by), F.struct(*columns)))
    return table.where(F.col(by).isNotNull()).agg(F.map_from_entries(entries)).scalar()


def hash_cuts(df: DataFrame, by: str, key: str, wanted: Column, seed: int = 42) -> DataFrame:
    """Per class, the (hash, key) of the row at position `wanted` in that order.

    `wanted` is an expression over the class's row count, named `total`. A class may hold most of
    the table, so it is never sorted as a whole: its hashes are counted in buckets, the bucket that
    holds the position is found from the running counts, and only that bucket's rows are ranked.
    """
    hashed = df.select(by, key).withColumn("h", portable_hash(F.col(key), seed))
    bucketed = hashed.withColumn("bucket", F.floor(F.col("h") / (HASH_RANGE // BUCKETS)))
    counts = bucketed.groupBy(by, "bucket").agg(F.count("*").alias("n"))
    upto = W.partitionBy(by).orderBy("bucket")
    places = (
        counts.withColumn("total", F.sum("n").over(W.partitionBy(by)))
        .withColumn("below", F.sum("n").over(upto) - F.col("n"))
        .withColumn("wanted", wanted)
        .where("below < wanted AND wanted <= below + n")
    )
    place = F.element_at(_lookup(places, by, "bucket", "below", "wanted"), F.col(by))
    boundary = bucketed.withColumn("place", place).where("bucket = place.bucket")
    rank = F.row_number().over(W.partitionBy(by).orderBy("h", key))
    return (
        boundary.withColumn("position", F.col("place.below") + rank)
        .where("position = place.wanted")
        .select(by, F.col("h").alias("cut_hash"), F.col(key).alias("cut_key"))
    )


def mark_first(df: DataFrame, by: str, key: str, wanted: Column, name: str, seed: int = 42) -> DataFrame:
    """Adds 0/1 column `name`: the row is among the first `wanted` of its class in hash order.

    The rows themselves are not shuffled: each is compared with the cut of its class.
    """
    h = portable_hash(F.col(key), seed)
    cuts = _lookup(hash_cuts(df, by, key, wanted, seed), by, "cut_hash", "cut_key")
    cut = F.element_at(cuts, F.col(by))
    before = (h < cut["cut_hash"]) | ((h == cut["cut_hash"]) & (F.col(key) <= cut["cut_key"]))
    return df.withColumn(name, flag(before))


def split_stratified(df: DataFrame, label: str, key: str, share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `is_test`: exactly the given share (rounded up) of each class, in hash order."""
    wanted = F.ceil(F.col("total") * share).cast("bigint")
    return mark_first(df, label, key, wanted, "is_test", seed)
