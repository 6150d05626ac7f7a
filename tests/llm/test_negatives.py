import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from headway.llm import negatives
from headway.llm.negatives import Packed, hard_negatives, op12_hard_negatives
from tests.conftest import values
from tests.llm.conftest import SF_DIR

SCHEMA = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"


def brute(rows, every=100):
    """(anchor, positive, rank, negative, scores) by plain loops over Python integers."""
    whole = {}
    for id_, vector, label in rows:
        if id_ is not None and vector is not None and label is not None:
            if all(x is not None and math.isfinite(x) for x in vector):
                whole[id_] = (label, [math.floor(256 * x) for x in vector])
    out = []
    for anchor, (label, vector) in whole.items():
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), i, other) for i, (other, v) in whole.items() if i != anchor]
        scored.sort()
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            window = [s for s in scored if s[2] != label and 80 * -score <= 100 * -s[0] <= 100 * -score]
            out += [(anchor, positive, n, i, -score, -s) for n, (s, i, _) in enumerate(window[:5], 1)]
    return sorted(out)


@pytest.mark.parametrize("low, high, fields", [(-3, 4, 4), (0, 1, 6), (-256, 256, 2), (-(2**20), 2**20, 1), (2**40, 2**41, 16)])
def test_packed_scores_are_exact(low, high, fields):
    rng = np.random.default_rng(3)
    rows = rng.integers(low, high, (37, 64)).astype(float)
    anchors = rng.integers(low, high, (5, 64)).astype(float)
    wanted = [[sum(int(x) * int(y) for x, y in zip(a, r)) for r in rows] for a in anchors]
    packed = Packed(rows, anchors)
    if max(abs(v) for line in wanted for v in line) >= 2**63:
        with pytest.raises(OverflowError):
            packed.scores(anchors)
        return
    assert packed.scores(anchors).tolist() == wanted
    assert packed.fields >= min(fields, packed.fields) and (packed.fields > 1 or high > 2**15)


def test_integers_beyond_doubles():
    rows, anchors = np.array([[2.0**60, -1.0], [3.0, 5.0], [-(2.0**58), 1.0]]), np.array([[1.0, 7.0], [-2.0, 0.0]])
    packed = Packed(rows, anchors)
    assert not packed.exact
    wanted = [[2**60 - 7, 38, -(2**58) + 7], [-(2**61), -6, 2**59]]
    assert packed.scores(anchors).tolist() == wanted


def test_equals_brute_force_with_ties(spark, monkeypatch):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(12, 8)).round(1) / 2
    rows = [(i, [float(x) for x in base[rng.integers(12)]], int(rng.integers(3))) for i in range(300)]
    rows += [(1000 + i, [0.25] * 8, i % 2) for i in range(120)]  # one very common vector
    monkeypatch.setattr(negatives, "SHARD_ROWS", 40)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 2)
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), "id % 20 = 0")
    assert values(found, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == brute(rows, 20)


def test_odd_rows(spark):
    good = [(i, [0.1 * (i % 7), 0.5, -0.2], i % 2) for i in range(0, 40)]
    odd = [
        (100, None, 1), (101, [0.1, None, 0.2], 1), (102, [float("nan"), 0.0, 0.0], 0), (104, [], 1),
        (103, [float("inf"), 0.0, 0.0], 0), (105, [0.1, 0.2, 0.3], None), (None, [9.0, 9.0, 9.0], 1),
        (106, [0.9] * 5, 0), (0, [0.0, 0.5, -0.2], 0),
    ]
    df = spark.createDataFrame([(*r, 7, "x") for r in good + odd], SCHEMA + ", id INT, shard STRING")
    found = values(hard_negatives(df, "id % 10 = 0"), "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert found and found == brute(good, 10)
    assert hard_negatives(df.limit(0)).count() == 0
    assert hard_negatives(df.where("vec_id = 100")).count() == 0
    assert hard_negatives(df, "id = 9999").count() == 0


def test_a_repeated_id_is_its_smallest_row(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.9, 0.0], 1), (2, [0.9, 0.0], 2), (2, [0.95, 0.0], 1)]
    found = hard_negatives(spark.createDataFrame(rows, SCHEMA), "id = 0")
    assert values(found, "positive_id", "negative_id", "negative_score") == [(1, 2, 256 * 230)]


def test_registered_rows(spark):
    rows = []
    for r in pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pylist():
        label = r["label"]
        if label is not None and r["vec_id"] % 7 == 0:
            label = (label + 1) % 10
        rows.append((r["vec_id"], r["embedding"], label))
    found = op12_hard_negatives(spark, SF_DIR)
    assert values(found, "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") == brute(rows)
