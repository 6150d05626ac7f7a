"""Quality classifier by compression (5).

Two zstandard dictionaries are built, one from good and one from bad labelled text. A text that
compresses better with the good one resembles good text: the difference of both compressed sizes,
divided by the text's bytes, is calibrated to a probability by logistic regression on labelled text
that neither dictionary has seen. Short texts are weak evidence, so the regression lets the length
decide how far the difference may move a score from the share of good texts. Texts are compressed in
blocks, because within a long block zstd would copy from the text itself instead of from the
dictionary.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import pick, release, table

THRESHOLD = 0.3
FOLDS = 5
BLOCK_BYTES = 2048
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
#: Training reads at most this many labelled documents of each class, chosen by the hash of their id,
#: and of each at most so many blocks (32 KB), spread evenly over a longer text. Both are parameters
#: of `train`. Every document is scored whole.
SAMPLE_DOCS = 2000
SAMPLE_BLOCKS = 16
#: A text of so many bytes counts as half the evidence of a very long one.
HALF_BYTES = 200


@dataclass(frozen=True)
class Model:
    """Dictionaries (null where a class had no example), and weights of the evidence."""

    good: bytes | None
    bad: bytes | None
    weights: tuple[float, float, float]


def blocks_of(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
    )


def build_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; with too few samples to train on, their plain content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Differences:
    """Normalised difference of the compressed sizes: above 0 where the good dictionary helps more."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.good, self.bad = _compressor(good), _compressor(bad)

    def of(self, blocks: list[bytes]) -> tuple[float, int]:
        """The difference, and the bytes it was measured on."""
        size = sum(map(len, blocks))
        if not size:
            return 0.0, 0
        by_bad = sum(len(self.bad.compress(block)) for block in blocks)
        by_good = sum(len(self.good.compress(block)) for block in blocks)
        return (by_bad - by_good) / size, size


def evidence(measured: list[tuple[float, int]]) -> np.ndarray:
    """Columns of the regression: 1, the share of full evidence, and that share of the difference."""
    found = np.array(measured, dtype=np.float64).reshape(-1, 2)
    share = found[:, 1] / (found[:, 1] + HALF_BYTES)
    return np.column_stack([np.ones(len(found)), share, 10 * share * found[:, 0]])


def probabilities(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def calibrate(x: np.ndarray, labels: np.ndarray, each: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression by Newton's method, slightly ridged; `each` is a row's weight."""
    w, ridge = np.zeros(3), np.array([1e-6, 1e-2, 1e-2])
    for _ in range(100):
        p = probabilities(x, w)
        slope = (x.T * (each * p * (1 - p))) @ x + np.diag(ridge) + np.eye(3) * 1e-9
        step = np.linalg.solve(slope, x.T @ (each * (labels - p)) - ridge * w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def held_out(id_col: str) -> F.Column:
    """Whether a row belongs to the fold that training never sees."""
    fold = F.crc32(F.col(f"`{id_col}`").cast("string")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def _known(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """One label per document of the folds that training may see, and the hash of its id."""
    key, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`").cast("int")
    seen = labels.where(~held_out(id_col) & key.isNotNull()).groupBy(key.alias("c0"))
    return seen.agg(F.min(label).alias("label"), F.min(F.xxhash64(key)).alias("place")).where("label IN (0, 1)")


def _sample(
    docs: DataFrame, known: DataFrame, id_col: str, text_col: str, most_docs: int, most_blocks: int
) -> list[tuple[int, list[bytes]]]:
    """(label, blocks) of the sampled documents, in the order of their ids' hashes.

    Of rows that share an id, the text with the smallest hash counts, whatever the partitions.
    """
    bad, good = (
        known.where(F.col("label") == label).orderBy("place", "c0").limit(most_docs) for label in (0, 1)
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text in batch.column("c1").to_pylist():
                blocks = blocks_of((text or "").encode())
                kept.append(blocks[:: max(1, math.ceil(len(blocks) / most_blocks))])
            arrays = [batch.column("label"), batch.column("place"), pa.array(kept, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "place", "blocks"])

    # At most 2 * most_docs ids, so the small side is broadcast.
    texts = pick(docs, id_col, text_col).join(F.broadcast(good.unionByName(bad)), "c0")
    one = F.min(F.struct(F.sha2("c1", 256), "c1", "label", "place")).alias("one")
    rows = texts.groupBy("c0").agg(one).select("one.c1", "one.label", "one.place")
    rows = rows.mapInArrow(cut, "label INT, place BIGINT, blocks ARRAY<BINARY>").collect()
    found = [(int(r["label"]), r["place"], [bytes(b) for b in r["blocks"]]) for r in rows]
    return [(label, blocks) for label, _, blocks in sorted(found, key=lambda x: (x[1], x[2]))]


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    most_docs: int = SAMPLE_DOCS,
    most_blocks: int = SAMPLE_BLOCKS,
) -> Model:
    """Dictionaries from one half of the sample of each class, calibration on the other half.

    The sample has at most `most_docs` documents of each class and `most_blocks` blocks of each.
    Classes are sampled alike, so the calibration weights each by how many labels it has. Without
    an example of both classes, every score is near the only label, or one half.
    """
    known = _known(labels, id_col, label_col)
    totals = {row["label"]: row["n"] for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    halves = {}
    for label in (0, 1):
        halves[label] = [], []
    for label, blocks in _sample(docs, known, id_col, text_col, most_docs, most_blocks):
        own = halves[label]
        own[len(own[0]) > len(own[1])].append(blocks)
    if not all(any(map(len, halves[k][0])) for k in (0, 1)):
        only = [label for label in (0, 1) if halves[label][0]]
        return Model(None, None, ({0: -4.0, 1: 4.0}[only[0]] if len(only) == 1 else 0.0, 0.0, 0.0))
    bad, good = (build_dictionary([b for blocks in halves[k][0] for b in blocks]) for k in (0, 1))
    difference = Differences(good, bad)
    rest = {k: halves[k][1] or halves[k][0] for k in (0, 1)}
    x = evidence([difference.of(blocks) for k in (0, 1) for blocks in rest[k]])
    y = np.repeat([0.0, 1.0], [len(rest[0]), len(rest[1])])
    each = np.repeat([totals[k] / len(rest[k]) for k in (0, 1)], [len(rest[0]), len(rest[1])])
    return Model(good, bad, calibrate(x, y, each * len(y) / each.sum()))


def scores(model: Model):
    """A function of a text column to scores between 0 and 1; null counts as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        difference = Differences(model.good, model.bad) if model.good is not None else None
        for series in batches:
            found = [
                difference.of(blocks_of(text.encode())) if difference and text else (0.0, 0)
                for text in series
            ]
            yield pd.Series(probabilities(evidence(found), np.array(model.weights)))

    return score


def quality_scores(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """`id_col`, held_out, score and predicted of every row's whole text.

    Empty and null texts are no evidence and get the score of that. Rows with equal ids stay separate, rows
    without an id are not held out, other columns are ignored, an empty table gives no rows.
    """
    scored = pick(docs, id_col, text_col).withColumn("score", scores(model)("c1"))
    return scored.select(
        F.col("c0").alias(id_col),
        held_out("c0").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def kept_by_classifier(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose text scores at least the threshold, with all their columns."""
    return docs.where(scores(model)(F.col(f"`{text_col}`")) >= THRESHOLD)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))
