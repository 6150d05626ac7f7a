import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from headway.llm import packing, token_counts, tokens
from tests.llm.conftest import SF_DIR

BYTES = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def whole():
    own = Tokenizer.from_file(path(BYTES))
    return lambda text: own.encode(text, add_special_tokens=False).ids


def test_ids_equal_those_of_whole_texts(whole, monkeypatch):
    monkeypatch.setattr(tokens, "CUT_CHARS", 20)
    made, draw = tokens.encoder(path(BYTES)), random.Random(1)
    parts = [*"ab \n\t '!.é٣中’\x1c\x85\u2003", "<|endoftext|>", "'s", "  ", " the", "0123"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 60))) for _ in range(4000)]
    assert [x.tolist() for x in made.encode(texts)] == [whole(t) for t in texts]
    assert made.count(texts).tolist() == [len(whole(t)) for t in texts]


def test_cuts_join_to_the_text():
    text = "one  two\n three " * 50
    assert "".join(tokens.cut(text, 7)) == text and len(list(tokens.cut(text, 7))) > 20


def test_counts_of_odd_rows(odd_docs, whole):
    rows = odd_docs.select("doc_id", "text").collect()
    found = token_counts.token_counts(odd_docs, limit=8).collect()
    wanted = []
    for doc_id, text in rows:
        n = len(whole(text or ""))
        wanted.append((doc_id, len((text or "").encode()), n, n > 8))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted))
    assert token_counts.token_counts(odd_docs.limit(0)).count() == 0


def test_counts_under_a_sentencepiece_model(odd_docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    found = token_counts.token_counts(odd_docs, tokenizer="piece_bpe_32k.model").collect()
    wanted = [len(model.encode(t or "")) for t in (r["text"] for r in odd_docs.collect())]
    assert sorted(r["n_tokens"] for r in found) == sorted(wanted)


@pytest.mark.parametrize("seed", range(6))
def test_closest_fill_is_optimal(seed):
    draw = random.Random(seed)
    counts = packing.Counter({draw.randint(1, 40): draw.randint(1, 3) for _ in range(5)})
    sums = {0}
    for length, k in counts.items():
        sums = {s + i * length for s in sums for i in range(k + 1)}
    best, used = packing.closest_fill(counts, 64)
    assert best == max(s for s in sums if s <= 64)
    assert sum(n * k for n, k in used.items()) == best
    assert all(k <= counts[n] for n, k in used.items())


@pytest.mark.parametrize("kinds", [0, 1, 2, 60, 900])
def test_plan_places_every_tail_without_gaps(kinds):
    draw = random.Random(kinds)
    histogram = {draw.randint(1, 1023): draw.randint(1, 30) for _ in range(kinds)}
    plan, filled = packing.plan_tails(histogram), defaultdict(list)
    for length, n in histogram.items():
        for rank in range(n):
            pieces = plan.place(length, rank)
            assert sum(p[1] for p in pieces) == length
            for _, size, sequence, offset in pieces:
                filled[sequence].append((offset, size))
    assert sorted(filled) == list(range(plan.sequences))
    for pieces in filled.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == 1024 or at & (at - 1) == 0


def check_packed(rows, texts, whole):
    """`rows` hold every id of each text once, in sequences of 1024 or a power of two."""
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == 1024 or at & (at - 1) == 0
    assert set(documents) == set(texts)
    for doc_id, pieces in documents.items():
        ids, at = np.array([*whole(texts[doc_id] or ""), 0], dtype="<u4"), 0
        for start, size, crc, total in sorted(pieces):
            assert (start, total) == (at, len(ids))
            assert crc == zlib.crc32(ids[at : at + size].tobytes())
            at += size
        assert at == len(ids)


def test_registered_packing(spark, corpus, whole):
    check_packed(packing.op4_packing(spark, SF_DIR).collect(), corpus, whole)


def test_packing_of_odd_rows(spark, odd_docs, whole):
    rows = odd_docs.distinct()
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    check_packed(packing.with_checksums(packing.pack(rows)).collect(), texts, whole)
    twice = packing.pack(odd_docs).where("doc_id = 1").collect()
    assert sum(r["length"] for r in twice) == 2 * twice[0]["doc_tokens"]
    assert packing.pack(odd_docs.limit(0)).count() == 0


def test_packing_without_a_broadcast(odd_docs, whole, monkeypatch):
    monkeypatch.setattr(packing, "BROADCAST_BYTES", 0)
    rows = odd_docs.distinct()
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    check_packed(packing.with_checksums(packing.pack(rows)).collect(), texts, whole)
