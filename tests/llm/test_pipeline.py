import pyarrow.parquet as pq

import corpus_pipeline
from headway.llm import quality_classifier, quality_rules
from headway.llm.common import table
from headway.plans.staging import new_path
from tests.llm.test_jaccard import brute

FOLDER = "/root/testdata/sf0.01"


def test_stages_hand_on_what_they_keep(spark):
    docs = table(spark, FOLDER, "documents")
    names = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{FOLDER}/labels.parquet").to_pylist()}
    for name, apply in corpus_pipeline.STAGES:
        path = new_path(spark, f"test_{name}")
        apply(spark, docs, FOLDER).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "packing":
            assert after.columns == names
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "quality_rules":
            verdict = {r["doc_id"] for r in quality_rules.quality_rules(docs).where("kept").collect()}
            assert {r["doc_id"] for r in after.collect()} == verdict
            assert all(i in verdict for i, q in labels.items() if q == 1 and len(before[i].split()) >= 50)
        if name == "quality_classifier":
            model = quality_classifier.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
            scored = quality_classifier.quality_scores(docs, model).where("predicted = 1")
            assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in scored.collect()}
        if name == "near_duplicates":
            groups = brute(list(before.items()), 5, 80)
            assert {r["doc_id"] for r in after.collect()} == {i for i, _, c in groups if i == c}
        if name == "secrets":
            rows = after.collect()
            assert {r["doc_id"] for r in rows} == set(before)
            assert all(r["n_chars"] == len(r["text"]) and "AKIA" not in r["text"] for r in rows)
            assert any("<secret>" in r["text"] for r in rows)
        docs = after
    assert {r["doc_id"] for r in docs.collect()} == set(before)


def test_near_duplicates_of_odd_rows(spark):
    rows = [
        (1, "a b c d e f g"), (2, "A b c d e f g"), (None, "a b c d e f g"), (None, "q"), (None, "q"),
        (5, ""), (6, None), (7, "z z"), (7, "z z"), (7, "z y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates_stage(spark, docs, FOLDER).collect()]
    assert sorted(map(str, kept)) == sorted(map(str, [*rows[:1], *rows[2:4], *rows[5:8], rows[9]]))
    assert corpus_pipeline.near_duplicates_stage(spark, docs.limit(0), FOLDER).count() == 0


def test_near_duplicates_among_repeated_ids(spark):
    a, b, c = "a b c d e f g", "h i j k l m n", "o p q r s t u"
    rows = [(1, a), (2, a.upper()), (2, a.upper()), (3, b), (3, b), (3, b), (4, b), (5, c), (5, "v w x y z"), (6, "V w x y z"), (6, c)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates_stage(spark, docs, FOLDER).collect()]
    assert sorted(kept) == [(1, a), (3, b), (5, c), (5, "v w x y z")]


CLASHES = "doc_id BIGINT, text STRING, copy_id INT, repeated_id INT, first_id INT, class STRING, class_ STRING, rank INT"


def test_near_duplicates_beside_clashing_columns(spark):
    a, b = "a b c d e f g", "h i j k l m n"
    rows = [(1, a, 1, 2, 3, "x", "y", 4), (2, a, 1, 2, 3, "x", "y", 4), (3, b, 1, 2, 3, "x", "y", 4), (3, b.upper(), 1, 2, 3, "x", "z", 5)]
    kept = []
    for n in (1, 2, 5):
        docs = spark.createDataFrame(rows, CLASHES).repartition(n)
        after = corpus_pipeline.near_duplicates_stage(spark, docs, FOLDER)
        assert after.columns == docs.columns
        kept.append(sorted(map(tuple, after.collect())))
    assert kept[0] == kept[1] == kept[2] and [r[0] for r in kept[0]] == [1, 3]  # no chance in it


def plain_words(text):
    return (text or "").split()


def test_every_stage_on_odd_rows(spark, tmp_path):
    """Nulls, empties, a long text, ties, repeated rows and clashing names through all stages."""
    good = " ".join(f"word{i} of the good kind" for i in range(40))
    rows = [(i, good + f" number {i}", "en", "web", 5, "x", 1) for i in range(3)]
    rows += [(3, None, None, None, None, None, None), (4, "", "en", "web", 0, "x", 1), (None, good, "en", "web", 1, "x", 2)]
    rows += [(5, "long text of words " * 30_000, "en", "web", 9, "x", 3), (0, good + " number 0", "en", "web", 5, "x", 1)]
    rows += [(6, "password = hunter22 " + good, None, "web", None, "y", 1)]
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, kept STRING, score INT"
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id BIGINT, quality INT")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    for name, apply in corpus_pipeline.STAGES:
        after = apply(spark, docs, folder).collect()
        assert apply(spark, docs.limit(0), folder).count() == 0
        if name != "packing":
            assert not after or after[0].__fields__ == docs.columns
        if name == "quality_rules":  # what fails the base rules goes; the rest is the method's own
            assert all(len(plain_words(r["text"])) >= 50 for r in after)
            assert 5 not in {r["doc_id"] for r in after}
        if name == "near_duplicates":
            found = sorted(str(r["doc_id"]) for r in after)
            assert found.count("0") == 1 and {"3", "4", "5", "None"} <= set(found)  # once; null and empty stay
        if name == "secrets":
            assert len(after) == len(rows) and sum(r["text"] is None for r in after) == 1
            assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in after)
            assert any(r["text"] and r["text"].startswith("<secret> word0") for r in after)
        if name == "packing":
            assert {r["doc_id"] for r in after} == {r[0] for r in rows}
    assert corpus_pipeline.secrets_stage(spark, docs.drop("n_chars"), folder).count() == len(rows)


def test_packed_pieces_hold_every_id_once(spark, corpus):
    """Independent of the packer: the pieces of every text join to the library's ids."""
    from zlib import crc32

    from tokenizers import Tokenizer

    from headway.llm.tokens import vocabulary

    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    pieces = {}
    sequences = {}
    for r in corpus_pipeline.packing_stage(spark, docs, FOLDER).collect():
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert pieces.keys() == corpus.keys()
    for doc_id, text in corpus.items():
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        own = sorted(pieces[doc_id], key=lambda r: r["start"])
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        assert sum(r["length"] for r in own) == len(ids) == own[0]["doc_tokens"]
        for r in own:
            part = b"".join(x.to_bytes(4, "little") for x in ids[r["start"] : r["start"] + r["length"]])
            assert r["ids_crc32"] == crc32(part)
    for spans in sequences.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= 1024


def test_run_is_registered(spark):
    import __spark_entry__

    found = __spark_entry__.queries()
    assert found["pipeline"] is corpus_pipeline.run
    assert sum(name.startswith("op") and name[2].isdigit() for name in found) == 13
