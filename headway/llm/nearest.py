"""Approximate nearest neighbours by multi-index hashing (3).

Vectors get binary codes from rotations learned on a bounded sample. A code is split into
substrings, each with an index of its own. By the pigeonhole principle two codes within a Hamming
radius agree within a share of it in at least one substring, so probing every substring index up to
its share finds every code within the radius; those are reranked on the original vectors in double
precision. The radius is the one that holds a given share of the sample's true neighbours. Vectors
lie in shards of bounded size that are searched for blocks of queries, and only the best of each
shard are merged. Equal vectors are searched once: as ties go to the smaller id, their k + 1
smallest ids are all that any result can hold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import pick, table
from headway.plans.staging import stage

K = 20
BITS = 256
SUBSTRING_BITS = 16
#: The rotations and the radius are learned on so many vectors at most.
SAMPLE = 16384
SAMPLE_QUERIES = 512
#: Share of the sample's true neighbours that the radius must hold.
WITHIN = 0.97
SHARD_ROWS = 16384
QUERY_ROWS = 1024
_CHUNK = 64


@dataclass(frozen=True)
class Codes:
    """One projection per bit. Vectors are scaled by the longest and given the coordinate that
    completes them to length 1, so that the angle to a query follows the inner product."""

    projections: np.ndarray
    longest: float
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        bits = completed(vectors, self.longest) @ self.projections > 0
        return np.packbits(bits, axis=1)

    def of_queries(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return np.packbits(unit @ self.projections[:-1] > 0, axis=1)


def completed(vectors: np.ndarray, longest: float) -> np.ndarray:
    scaled = vectors / longest
    rest = np.sqrt(np.clip(1 - (scaled**2).sum(axis=1), 0, None))
    return np.column_stack([scaled, rest])


def _rotation(data: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """An orthogonal rotation that brings the data close to the corners of a cube."""
    rotation = np.linalg.qr(rng.normal(size=(data.shape[1], data.shape[1])))[0]
    for _ in range(rounds):
        corners = np.sign(data @ rotation)
        left, _, right = np.linalg.svd(data.T @ corners)
        rotation = left @ right
    return rotation


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows of `a` and of `b`."""
    x, y = a.view(np.uint64), b.view(np.uint64)
    return sum(
        np.bitwise_count(x[:, None, i] ^ y[None, :, i]).astype(np.uint16) for i in range(x.shape[1])
    )


def learn(sample: np.ndarray, longest: float, k: int = K, bits: int = BITS) -> Codes:
    """Rotations from the sample, and the radius that holds `WITHIN` of its true neighbours."""
    rng = np.random.default_rng(7)
    data = completed(sample, longest)
    turns = [_rotation(data[: 4096], rng) for _ in range(math.ceil(bits / data.shape[1]))]
    projections = np.concatenate(turns, axis=1)[:, :bits]
    codes = Codes(projections, longest, 0)
    queries = sample[:SAMPLE_QUERIES]
    scores = queries @ sample.T
    scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    near = min(k, len(sample) - 1)
    if near < 1:
        return Codes(projections, longest, bits)
    best = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    found = hamming(codes.of_queries(queries), codes.of(sample))
    distances = np.sort(np.take_along_axis(found, best, axis=1).ravel())
    return Codes(projections, longest, int(distances[math.ceil(WITHIN * len(distances)) - 1]))


def shares(radius: int, parts: int) -> list[int]:
    """Radius of each substring: codes within `radius` agree within its share in at least one."""
    whole, rest = divmod(radius, parts)
    return [whole if i <= rest else whole - 1 for i in range(parts)]


class SubstringIndex:
    """The codes of one shard: for every substring, its values and the codes that have each."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        parts = codes.view(np.uint16)
        self.tables = [np.unique(parts[:, i], return_inverse=True) for i in range(parts.shape[1])]

    def probe(self, queries: np.ndarray, radius: int) -> np.ndarray:
        """Which codes lie within the radius of each query."""
        parts = queries.view(np.uint16)
        hit = np.zeros((len(queries), len(self.codes)), dtype=bool)
        for i, reach in enumerate(shares(radius, parts.shape[1])):
            if reach >= 0:
                values, owner = self.tables[i]
                close = np.bitwise_count(parts[:, i, None] ^ values[None, :]) <= reach
                hit |= close[:, owner]
        rows, columns = np.nonzero(hit)
        a, b = queries.view(np.uint64), self.codes.view(np.uint64)
        distance = sum(np.bitwise_count(a[rows, j] ^ b[columns, j]).astype(np.uint16) for j in range(a.shape[1]))
        hit[rows, columns] = distance <= radius
        return hit


def _search(shard: pd.DataFrame, queries: pd.DataFrame, codes: Codes, k: int) -> pd.DataFrame:
    """The k + 1 best of a shard for each query, equal vectors expanded to their ids."""
    vectors = np.array(shard["vector"].tolist(), dtype=np.float64)
    wanted = np.array(queries["vector"].tolist(), dtype=np.float64)
    index = SubstringIndex(codes.of(vectors))
    probes = codes.of_queries(wanted)
    sizes = shard["ids"].map(len).to_numpy()
    out: list[tuple[int, int, float]] = []
    owners = queries["owner"].tolist()
    ids = shard["ids"].tolist()
    for start in range(0, len(wanted), _CHUNK):
        chunk = slice(start, start + _CHUNK)
        hits = index.probe(probes[chunk], codes.radius)
        for i, hit in enumerate(hits):
            radius = codes.radius
            while sizes[hit].sum() <= k and radius < codes.projections.shape[1]:
                radius = min(codes.projections.shape[1], radius + SUBSTRING_BITS)
                hit = index.probe(probes[start + i : start + i + 1], radius)[0]
            found = np.flatnonzero(hit)
            scores = vectors[found] @ wanted[start + i]
            if len(found) > k + 1:
                floor = np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                found, scores = found[scores >= floor], scores[scores >= floor]
            pairs = sorted((-score, vec) for score, j in zip(scores.tolist(), found) for vec in ids[j])
            out += [(owners[start + i], vec, -score) for score, vec in pairs[: k + 1]]
    return pd.DataFrame(out, columns=["owner", "vec_id", "score"])


def nearest(
    vectors: DataFrame,
    queries: str = "id % 20 = 0",
    k: int = K,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest found by inner product: query_id, rank, vec_id, score.

    `queries` is a condition on the column `id`; every row it holds for is searched against all
    other rows. Null and zero vectors, and those with null or non-finite components or of another
    length than most, take no part. Rows without an id are ignored, rows with an equal id and vector
    count once; fewer than k candidates are all returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, id_col, vector_col).select(
        F.col("c0").cast("bigint").alias("id"), F.col("c1").cast("array<double>").alias("vector")
    )
    rows = rows.where(
        "id IS NOT NULL AND exists(vector, x -> x <> 0)"
        " AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    first = widths.orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not first:
        return spark.createDataFrame([], "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE")
    rows = rows.where(F.size("vector") == first[0]["width"])

    of_vector = Window.partitionBy("vector").orderBy("id")
    smallest = rows.distinct().withColumn("n", F.row_number().over(of_vector)).where(F.col("n") <= k + 1)
    classes = smallest.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = stage(classes.withColumn("owner", F.col("ids")[0]), "nearest_classes")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    size = classes.agg(F.count("*").alias("n"), F.max(length).alias("longest")).first()

    sample = classes.orderBy(F.xxhash64("owner"), "owner").limit(SAMPLE).select("vector").toArrow()
    width = first[0]["width"]
    data = np.asarray(sample["vector"].combine_chunks().flatten()).reshape(-1, width)
    codes = learn(data, size["longest"], k)

    asked = rows.where(queries).select("id", "vector").distinct()
    asked = stage(
        asked.join(classes.select("vector", "owner"), "vector").select("id", "owner"), "nearest_queries"
    )
    sought = classes.join(asked.select("owner").distinct(), "owner", "left_semi")
    sought = stage(sought.select("owner", "vector"), "nearest_sought")
    shards = max(1, math.ceil(size["n"] / SHARD_ROWS))
    blocks = max(1, math.ceil(asked.count() / QUERY_ROWS))

    def dealt(df: DataFrame, own: str, n: int, other: str, times: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
        return df.select("*", F.pmod(F.xxhash64("owner"), F.lit(n)).cast("int").alias(own)).select(
            "*", every.alias(other)
        )

    left = dealt(classes, "shard", shards, "block", blocks).groupBy("shard", "block")
    right = dealt(sought, "block", blocks, "shard", shards).groupBy("shard", "block")

    def search(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if shard.empty or block.empty:
            return pd.DataFrame({"owner": [], "vec_id": [], "score": []})
        return _search(shard, block, codes, k)

    found = left.cogroup(right).applyInPandas(search, "owner BIGINT, vec_id BIGINT, score DOUBLE")
    best = Window.partitionBy("owner").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    of_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    pairs = asked.join(found, "owner").where("id <> vec_id").select(F.col("id").alias("query_id"), "vec_id", "score")
    ranked = pairs.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), "id % 20 = 0")
