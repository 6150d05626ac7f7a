"""Hard negatives by Kronecker-packed products (12).

Components are whole numbers. Those of several candidates, shifted to be positive, lie side by side
in fields of one wide integer, wide enough that no sum of products overflows its field. One
multiplication per anchor component then scores all candidates of the integer, and the fields of the
sum are their exact scores once the shifts are taken off. Integers of up to 53 bits live in doubles,
whose matrix product is exact there; components too large for that go through Python's integers.

Two passes over shards of bounded size, each against blocks of anchors. The first multiplies an
anchor with its own label only and finds its positives; the second multiplies it with all others and
finds the best rows of each positive's window. Each pass keeps a few rows per shard, merged later.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import pick, table
from headway.plans.staging import stage

POSITIVES = 5
NEGATIVES = 5
SHARD_ROWS = 16384
ANCHOR_ROWS = 8192
#: Bits of whole numbers that a double holds exactly.
EXACT_BITS = 53
_CHUNK = 256
#: Fields of an integer that is too wide for a double.
_WIDE_FIELDS = 16


class Packed:
    """Candidates' components in fields of wide integers."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray) -> None:
        """`rows` and `anchors` hold whole numbers as doubles, one vector per line."""
        self.n, width = rows.shape
        whole = max(np.abs(rows).max(initial=0), np.abs(anchors).max(initial=0)) < 2**EXACT_BITS
        if not whole:
            rows, anchors = (_integers(x) for x in (rows, anchors))
        self.shift = max(0, -int(rows.min(initial=0)))
        self.lift = max(0, -int(anchors.min(initial=0)))
        top = (int(rows.max(initial=0)) + self.shift) * (int(anchors.max(initial=0)) + self.lift)
        self.bits = max(1, (top * width).bit_length())
        self.fields = EXACT_BITS // self.bits if whole else 0
        self.exact = self.fields > 0
        if not self.exact:
            self.fields = _WIDE_FIELDS
            rows = rows if rows.dtype == object else _integers(rows)
        self.sums = rows.sum(axis=1)
        groups = math.ceil(self.n / self.fields)
        padded = np.zeros((groups * self.fields, width), dtype=rows.dtype)
        padded[: self.n] = rows + self.shift
        parts = padded.reshape(groups, self.fields, width)
        self.wide = sum(parts[:, i] * (1 << (i * self.bits)) for i in range(self.fields))

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products: a line per anchor, a column per candidate."""
        if not self.exact:
            anchors = _integers(anchors)
        products = (anchors + self.lift) @ self.wide.T
        if self.exact:
            products = products.astype(np.int64)
        low = (1 << self.bits) - 1
        fields = [(products >> (i * self.bits)) & low for i in range(self.fields)]
        found = np.stack(fields, axis=2).reshape(len(anchors), -1)[:, : self.n]
        added = (anchors + self.lift).sum(axis=1)
        if self.exact:
            added, sums = added.astype(np.int64), self.sums.astype(np.int64)
            return found - self.shift * added[:, None] - self.lift * sums[None, :]
        found = found - self.shift * added[:, None] - self.lift * self.sums[None, :]
        return found.astype(np.int64)  # ends the job if a score is no long


def _integers(values: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in values], dtype=object).reshape(values.shape)


def _vectors(column: pa.ChunkedArray, rows: int, scale: int) -> np.ndarray:
    """Whole components of the vectors, as doubles."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(rows, -1) * scale) if rows else np.zeros((0, 0))


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().to_numpy(zero_copy_only=False)


def _chunks(n: int) -> Iterator[slice]:
    return (slice(i, i + _CHUNK) for i in range(0, n, _CHUNK))


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the n highest scores, highest first, ties to smaller ids."""
    if len(scores) > 4 * n:
        floor = np.partition(scores, len(scores) - n)[len(scores) - n]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:n]


def _positives(rows: pa.Table, anchors: pa.Table, n: int, scale: int) -> pa.Table:
    """The n best rows of each anchor's own label in a shard."""
    ids, labels = _numbers(rows["id"]), _numbers(rows["label"])
    own, wanted = _numbers(anchors["id"]), _numbers(anchors["label"])
    vectors, asked = (_vectors(t["vector"], len(t), scale) for t in (rows, anchors))
    out: list[tuple[np.ndarray, ...]] = []
    for label in np.intersect1d(labels, wanted):
        here, there = np.flatnonzero(labels == label), np.flatnonzero(wanted == label)
        packed = Packed(vectors[here], asked[there])
        for chunk in _chunks(len(there)):
            for line, anchor in zip(packed.scores(asked[there[chunk]]), own[there[chunk]]):
                best = _best(line, ids[here], n + 1)
                best = best[ids[here][best] != anchor][:n]
                out.append((np.full(len(best), anchor), ids[here][best], line[best]))
    return _table(["anchor_id", "positive_id", "positive_score"], out)


def _negatives(rows: pa.Table, anchors: pa.Table, n: int, share: int, scale: int) -> pa.Table:
    """The n best rows of other labels in each window of an anchor's positive scores, in a shard."""
    ids, labels = _numbers(rows["id"]), _numbers(rows["label"])
    own, wanted = _numbers(anchors["id"]), _numbers(anchors["label"])
    asked = _vectors(anchors["vector"], len(own), scale)
    packed = Packed(_vectors(rows["vector"], len(ids), scale), asked)
    limits = anchors["scores"].to_pylist()
    out: list[tuple[np.ndarray, ...]] = []
    for chunk in _chunks(len(own)):
        for i, line in enumerate(packed.scores(asked[chunk]), chunk.start):
            other = labels != wanted[i]
            for limit in sorted(set(limits[i])):
                inside = np.flatnonzero(other & (line <= limit) & (line >= -(-share * limit // 100)))
                best = inside[_best(line[inside], ids[inside], n)]
                same = np.full(len(best), own[i]), np.full(len(best), limit)
                out.append((*same, ids[best], line[best]))
    return _table(["anchor_id", "positive_score", "negative_id", "negative_score"], out)


def _table(names: list[str], parts: list[tuple[np.ndarray, ...]]) -> pa.Table:
    columns = [np.concatenate(c) if c else np.zeros(0) for c in (zip(*parts) if parts else [[]] * len(names))]
    return pa.table({name: pa.array(c.astype(np.int64), pa.int64()) for name, c in zip(names, columns)})


def _usable(rows: DataFrame) -> DataFrame:
    """Rows (id, label, vector) that take part, one per id."""
    finite = "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = rows.where(f"id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND {finite}")
    once = rows.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return once.select("id", "row.label", "row.vector")


def _dealt(df: DataFrame, own: str, n: int, other: str, times: int) -> DataFrame:
    """Rows dealt to one of `n` parts by id, with a copy for each part of the other side."""
    part = F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias(own)
    same = [F.col(c).alias(c) for c in df.columns]  # both sides of a pairing come from one table
    return df.select(*same, part, F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias(other))


def _ranked(df: DataFrame, keys: list[str], score: str, tie: str, n: int) -> DataFrame:
    """The n best rows of each key, numbered from 1 as `rank`."""
    best = Window.partitionBy(*keys).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)


_RESULT = (
    "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT,"
    " positive_score BIGINT, negative_score BIGINT"
)


def hard_negatives(
    vectors: DataFrame,
    anchors: str = "id % 100 = 0",
    scale: int = 256,
    share: int = 80,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Hard negatives of anchors: anchor_id, positive_id, rank, negative_id, positive and negative_score.

    A component x counts as floor(scale * x). `anchors` is a condition on the column `id`. An
    anchor's positives are the best `positives` other rows of its label; for each of them the best
    `negatives` rows of other labels are returned whose score lies between `share` percent of the
    positive's and the positive's. Ties go to smaller ids. Rows with a null id, label or vector, or
    with null or non-finite components, take no part, nor do vectors of another length than most; of
    rows that share an id the smallest label and vector stands for it. Anchors without positives and
    positives without rows in their window give no rows, nor does an empty table. A score that is no
    64-bit integer ends the job. Other columns of the input are ignored.
    """
    spark = vectors.sparkSession
    rows = pick(vectors, id_col, vector_col, label_col).select(
        F.col("c0").cast("bigint").alias("id"),
        F.col("c2").cast("bigint").alias("label"),
        F.col("c1").cast("array<double>").alias("vector"),
    )
    rows = stage(_usable(rows), "negative_rows")
    widths = rows.groupBy(F.size("vector").alias("width")).count()
    first = widths.orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not first:
        return spark.createDataFrame([], _RESULT)
    rows = rows.where(F.size("vector") == first[0]["width"])
    asked = rows.where(anchors)
    few = min(spark.sparkContext.defaultParallelism, math.ceil(first[0]["count"] / _CHUNK))
    shards = max(few, math.ceil(first[0]["count"] / SHARD_ROWS))
    blocks = max(1, math.ceil(asked.count() / ANCHOR_ROWS))

    def paired(own: DataFrame):
        left = _dealt(rows, "shard", shards, "block", blocks).groupBy("shard", "block")
        return left.cogroup(_dealt(own, "block", blocks, "shard", shards).groupBy("shard", "block"))

    def near(shard: pa.Table, block: pa.Table) -> pa.Table:
        return _positives(shard, block, positives, scale)

    def hard(shard: pa.Table, block: pa.Table) -> pa.Table:
        return _negatives(shard, block, negatives, share, scale)

    found = paired(asked).applyInArrow(near, "anchor_id BIGINT, positive_id BIGINT, positive_score BIGINT")
    found = _ranked(found, ["anchor_id"], "positive_score", "positive_id", positives).drop("rank")
    found = stage(found, "negative_positives")
    scores = found.groupBy(F.col("anchor_id").alias("id")).agg(F.collect_set("positive_score").alias("scores"))
    kept = paired(asked.join(scores, "id")).applyInArrow(
        hard, "anchor_id BIGINT, positive_score BIGINT, negative_id BIGINT, negative_score BIGINT"
    )
    window = ["anchor_id", "positive_score"]
    kept = _ranked(kept, window, "negative_score", "negative_id", negatives)
    return found.join(kept, window).select(
        "anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hundredth row's hard negatives; every seventh row counts as the next label."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", label))


#: The same in DuckDB: products of whole components are exact in doubles too.
OP12_SQL = """
WITH rows AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM rows AS a JOIN rows AS b ON a.id <> b.id WHERE a.id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS n FROM pairs WHERE same
  ) AS ranked WHERE n <= 5
), negatives AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, q.id AS negative_id, q.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY q.score DESC, q.id) AS n
  FROM positives AS p JOIN pairs AS q ON p.anchor_id = q.anchor_id AND NOT q.same
   AND 80 * p.positive_score <= 100 * q.score AND q.score <= p.positive_score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE n <= 5
"""
