import math
from collections import Counter

import numpy as np
import pytest
from public_tokenizers import path

from headway.llm import lattice
from tests.llm.conftest import SF_DIR


@pytest.fixture(scope="module")
def model():
    return lattice.pieces(path("piece_bpe_32k.model"))


def every_segmentation(model, text):
    """Log probability of each segmentation, by trying all."""
    seen = model.normalised(text)

    def rest(i):
        if i == len(seen):
            yield (), 0.0
        for j in range(i + 1, len(seen) + 1):
            part = seen[i:j]
            if part in model.places:
                ids, weight = [model.places[part]], model.weight[model.places[part]]
            elif j == i + 1:
                ids, weight = model.fallback(part)
            else:
                continue
            for tail, more in rest(j):
                yield (*ids, *tail), weight + more

    found = dict(rest(0))
    total = np.logaddexp.reduce(list(found.values()))
    return {ids: log - total for ids, log in found.items()}


@pytest.mark.parametrize("text", ["the cat", "ab\nc", "é中x", ""])
def test_samples_follow_the_lattice(model, text):
    truth, n, k = every_segmentation(model, text), 3000, 3
    found = lattice.sample_texts([text] * n, list(map(str, range(n))), lattice.Lattices(model), k, 1)
    first, estimate = Counter(), Counter()
    for own in found:
        assert len({tuple(ids) for ids, _, _ in own}) == len(own) == min(k, len(truth))
        first[tuple(own[0][0].tolist())] += 1
        for ids, log, inclusion in own:
            key = tuple(ids.tolist())
            assert log == pytest.approx(truth[key], abs=1e-6) and inclusion <= 0
            estimate[key] += math.exp(log - inclusion) / n
    for key, log in truth.items():
        assert first[key] / n == pytest.approx(math.exp(log), abs=0.04)
        if len(truth) <= k or math.exp(log) > 0.2:  # unbiased by the inclusion scores
            assert estimate[key] == pytest.approx(math.exp(log), abs=0.04)


def test_draws_depend_on_key_and_text_alone(model):
    one = lattice.sample_texts(["a lattice of pieces"], ["7"], lattice.Lattices(model), 3, 5)[0]
    texts, keys = ["other words", "a lattice of pieces", "a lattice of pieces"], ["7", "7", "8"]
    many = lattice.sample_texts(texts, keys, lattice.Lattices(model), 3, 5)
    same = [[(ids.tolist(), log, inc) for ids, log, inc in own] for own in (one, many[1], many[2])]
    assert same[0] == same[1] != same[2]


def test_encode_and_decode_round_trip(model, corpus):
    for text in [*list(corpus.values())[:20], "  a \n\tb  ", "🙂\x00é"]:
        ids = model.encode(text)
        assert model.decode(ids) == text == model.model.decode(ids)


def test_every_sample_decodes_to_its_text(spark, corpus):
    import zlib

    rows = lattice.op2_segmentations(spark, SF_DIR).collect()
    assert {r["doc_id"] for r in rows} == set(corpus)
    for r in rows:
        data = (corpus[r["doc_id"]] or "").encode()
        assert (r["text_bytes"], r["text_crc32"]) == (len(data), zlib.crc32(data))
    kinds = Counter((r["doc_id"], r["ids_crc32"]) for r in rows)
    assert max(kinds.values()) == 1
    assert all(1 <= r["sample"] <= lattice.SAMPLES for r in rows)


def test_odd_rows(odd_docs):
    rows = lattice.sampled_segmentations(odd_docs)
    assert rows.where("doc_id IN (2, 3)").count() == 2  # no pieces: one segmentation each
    assert rows.where("doc_id = 2 AND size(ids) = 0 AND log_inclusion = 0").count() == 1
    texts = {(r["doc_id"], r["decoded"]) for r in lattice.decoded(rows).collect()}
    assert texts == {(r["doc_id"], r["text"] or "") for r in odd_docs.collect()}
    assert lattice.sampled_segmentations(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("texts", [["a lattice", "of", "a of a"], ["", "two  gaps ", "  ", "of two"], []])
def test_distinct_words_are_those_of_each_text(model, texts):
    seen = [model.normalised(text) for text in texts]
    words, place, sizes = lattice.distinct_words(seen)
    ends = np.cumsum([0, *sizes])
    assert len(set(words)) == len(words) and len(sizes) == len(texts)
    for text, low, high in zip(seen, ends[:-1], ends[1:]):
        assert [words[i] for i in place[low:high]] == lattice.split_words(text)


def test_rows_decode_together_as_alone(model):
    byte = model.byte_ids
    rows = [model.encode("a cat"), [], [byte[0xE4], byte[0xB8]], model.encode("é中x\x00"), [byte[0xFF]]]
    together = list(model.decode_each([np.array(ids, dtype=np.int64) for ids in rows]))
    assert together == [model.decode(ids).encode() for ids in rows]
    assert list(model.decode_each([])) == [] and list(model.decode_each([np.zeros(0, np.int64)])) == [b""]


def test_one_number_is_that_of_arrays():
    for seed in (0, 1, (1 << 64) - 1):
        assert lattice._one(seed, 3) == lattice._uniform(np.array([seed], np.uint64), np.array([3]))[0]


def test_texts_of_a_batch_share_words_and_a_call_of_decode(model, monkeypatch):
    """Work is per batch: 300 texts take no more calls of the word store than one."""
    calls = []
    numbers = lattice.Lattices.numbers
    monkeypatch.setattr(lattice.Lattices, "numbers", lambda self, words: calls.append(len(words)) or numbers(self, words))
    lattice.sample_texts(["the same words"] * 300, list(map(str, range(300))), lattice.Lattices(model), 3, 1)
    assert calls == [3]
