import numpy as np
import pyarrow.parquet as pq
import pytest

from headway.llm import nearest
from tests.llm.conftest import SF_DIR


def brute(ids, vectors, k):
    """(query, rank) to (id, score), ties to smaller ids."""
    found = {}
    for i, q in zip(ids, vectors):
        if i % 20 == 0:
            scores = vectors @ q
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != i][:k]
            found[i] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def recall_of(rows, truth):
    hits = sum(
        r["score"] >= truth[r["query_id"]][-1][1] - 1e-12 for r in rows
    )
    return hits / sum(map(len, truth.values()))


def test_recall_on_the_registered_query(spark):
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pydict()
    ids, vectors = np.array(table["vec_id"]), np.array(table["embedding"], dtype=np.float64)
    truth = brute(ids, vectors, 20)
    rows = nearest.op3_nearest(spark, "/root/testdata/sf0.1").collect()
    place = {v: i for i, v in enumerate(ids.tolist())}
    assert len(rows) == 20 * len(truth)
    for r in rows:
        assert r["vec_id"] != r["query_id"]
        exact = vectors[place[r["vec_id"]]] @ vectors[place[r["query_id"]]]
        assert r["score"] == pytest.approx(exact, abs=1e-12)
    assert recall_of(rows, truth) >= 0.9


def test_unequal_lengths_follow_the_inner_product(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(600, 24)) * rng.uniform(0.2, 3, size=(600, 1))
    ids = np.arange(600)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, vectors)]
    found = nearest.nearest(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    assert recall_of(found, brute(ids, vectors, 20)) >= 0.9


def test_many_equal_vectors_and_shards(spark, monkeypatch):
    monkeypatch.setattr(nearest, "SHARD_ROWS", 16)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 2)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(120, 8)).round(3)
    vectors[20:90] = vectors[0]
    ids = np.arange(120)
    rows = [(int(i), v.tolist()) for i, v in zip(ids, vectors)]
    df = spark.createDataFrame(rows + rows[:5], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = nearest.nearest(df).orderBy("query_id", "rank").collect()
    truth = brute(ids, vectors, 20)
    assert recall_of(found, truth) >= 0.9
    own = [r["vec_id"] for r in found if r["query_id"] == 40]
    if truth[40][0][1] == truth[40][19][1]:
        assert own == [v for v, _ in truth[40]]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (20, [0.0, 2.0], 3), (20, [0.0, 2.0], 3), (3, None, 1),
        (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [1.0, None], 1), (7, [1.0], 1), (None, [1.0, 1.0], 1),
        (8, [3.0, 1.0], 1), (9, [inf, 1.0], 1), (10, [], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, owner INT")
    found = [tuple(r) for r in nearest.nearest(df).orderBy("query_id", "rank").collect()]
    assert found == [
        (0, 1, 8, 3.0), (0, 2, 1, 1.0), (0, 3, 20, 0.0), (20, 1, 8, 2.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0),
    ]
    assert nearest.nearest(df.limit(0)).count() == nearest.nearest(df.where("vec_id = 0")).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 15, 16, 40, 111])
def test_probing_finds_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 256, size=(200, 32), dtype=np.uint8)
    queries = codes[:9] ^ (rng.random((9, 32)) < 0.2).astype(np.uint8)
    hit = nearest.SubstringIndex(codes).probe(queries, radius)
    assert (hit == (nearest.hamming(queries, codes) <= radius)).all()
