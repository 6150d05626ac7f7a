import random
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from headway.llm import word_bpe
from headway.llm.tokens import vocabulary
from tests.llm.conftest import SF_DIR

PATH = vocabulary("word_bpe_49k.json")
ODD = [
    "Hello World's <|endoftext|>x  ÇΣ ΑΣ 123 don't it'S",
    "\x1c a\x1fb​ c\x85d\xa0e",
    "",
    "a" * 1000,
    "ab" * 700 + "é́é",
    "İstanbul ﬁ 中文字 🙂🙂 x",
    "!?" * 500,
    " ́x Å    <|startoftext|><|endoftext|>",
    "ÉCOLE Straße ǅ ½ ² ª º _a_1",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    return word_bpe.WordBpe(PATH)


def ids_of(model, texts):
    sizes, ids = model.encode(texts)
    return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])] if texts else []


def test_ids_equal_the_librarys(model, library, corpus):
    texts = [text or "" for text in corpus.values()] + ODD
    assert ids_of(model, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert ids_of(model, texts[:5]) == [e.ids for e in library.encode_batch(texts[:5], add_special_tokens=False)]
    assert ids_of(model, []) == []


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    model, library = word_bpe.word_bpe(PATH), Tokenizer.from_file(PATH)
    assert ids_of(model, [text]) == [library.encode(text, add_special_tokens=False).ids]


def test_long_words_merge_by_rank_as_in_rounds(model, library):
    rng = random.Random(5)
    for letters, n in (("ab", 900), ("aei", 700), ("thequickbrown", 5000)):
        word = "".join(rng.choices(letters, k=n))
        symbols = model.inner[np.frombuffer(word.encode("utf-32-le"), dtype=np.uint32)]
        symbols[-1] = model.final[ord(word[-1])]
        _, rounds = model.merges.by_rounds(symbols.copy(), np.array([n]))
        by_rank = model.merges.by_rank(symbols.copy()).tolist()
        assert by_rank == rounds.tolist() == library.encode(word, add_special_tokens=False).ids


def test_kept_chunks_stay_bounded(library, monkeypatch):
    monkeypatch.setattr(word_bpe, "KEPT_CHARS", 2000)
    model, rng = word_bpe.WordBpe(PATH), random.Random(1)
    for _ in range(20):
        texts = ["".join(rng.choices("abcdefgh ", k=400)) + "x" * 100 for _ in range(3)]
        assert ids_of(model, texts) == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert model.kept < 2000 + 3 * 3 * 500
        assert all(len(chunk) <= word_bpe.KEPT_CHUNK for chunk in model.chunks)


def test_decoding_equals_the_librarys(model, library):
    rows = [library.encode(text, add_special_tokens=False).ids for text in ODD]
    found = model.decode(pa.array(rows, pa.list_(pa.int32()))).to_pylist()
    assert found == [library.decode(ids, skip_special_tokens=False) for ids in rows]


def test_merges_out_of_order_are_refused():
    pairs = np.array([(0, 3), (1, 2)])  # the first needs what the second makes
    with pytest.raises(ValueError, match="ranks before"):
        word_bpe.Merges(pairs, np.array([4, 3]), 5)


def test_rows_with_nulls_and_clashing_columns(spark, odd_docs, library):
    found = word_bpe.decode(word_bpe.encode(odd_docs)).collect()
    wanted = []
    for row in odd_docs.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        wanted.append((row["doc_id"], ids, library.decode(ids, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    assert word_bpe.encode(odd_docs.limit(0)).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id BIGINT, ids ARRAY<INT>")
    assert [tuple(r) for r in word_bpe.decode(nothing).collect()] == [(1, [], "")]


def test_registered_rows(spark, corpus, library):
    rows = {r["doc_id"]: r for r in word_bpe.op11_word_bpe(spark, SF_DIR).collect()}
    assert rows.keys() == corpus.keys()
    for doc_id, text in corpus.items():
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert rows[doc_id]["n_tokens"] == len(ids)
        assert rows[doc_id]["ids_sha256"] == sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert rows[doc_id]["decoded_sha256"] == sha256(decoded.encode()).hexdigest()
