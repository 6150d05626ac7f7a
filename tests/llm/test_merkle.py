import zlib
from hashlib import sha256

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from headway.llm.merkle import FIELDS, fold, leaf_digest, manifest, op13_merkle_manifest, proof_of, sweep_down, sweep_up, verify
from tests.conftest import values
from tests.llm.conftest import SF_DIR


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h("".join(parts))


def root_and_proofs(leaves, arity=2):
    """Root of a list of leaves, and each one's siblings as (left, right) from the bottom up."""
    proofs, owners = [[] for _ in leaves], [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        runs = [leaves[i : i + arity] for i in range(0, len(leaves), arity)]
        groups = [owners[i : i + arity] for i in range(0, len(leaves), arity)]
        for run, group in zip(runs, groups):
            for i, members in enumerate(group):
                for leaf in members:
                    proofs[leaf].append(("".join(run[:i]), "".join(run[i + 1 :])))
        leaves = [h("".join(run)) for run in runs]
        owners = [sum(group, []) for group in groups]
    return leaves[0], proofs


def brute(rows, arity=2):
    """(id, leaf, subroot, root, proof) of rows (id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row[0]))
    keys = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    found = {k: root_and_proofs([r[2] for r in sorted(trees[k], key=lambda r: r[:3])], arity) for k in keys}
    root, above = root_and_proofs([found[k][0] for k in keys], arity)
    out = []
    for place, k in enumerate(keys):
        subroot, proofs = found[k]
        for row, proof in zip(sorted(trees[k], key=lambda r: r[:3]), proofs):
            out.append((row[3], row[2], subroot, root, "".join(a + b for a, b in proof + above[place])))
    return out


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[4]))


@pytest.mark.parametrize("n, arity", [(1, 2), (2, 2), (7, 2), (8, 2), (9, 3), (26, 3)])
def test_sweeps_lead_every_leaf_to_the_root(n, arity):
    leaves = [h(str(i)) for i in range(n)]
    root, proofs = root_and_proofs(leaves, arity)
    levels = next(k for k in range(9) if arity**k >= n)
    runs = list(sweep_up(enumerate(leaves), levels, arity))
    assert [label for label, _, _ in runs] == sorted(label for label, _, _ in runs)
    if not runs:
        assert fold(leaves[0], "") == root
        return
    steps = {place: way for (_, place), way in sweep_down(runs, "")}
    assert all(fold(leaves[i], steps[i]) == root for i in range(n))
    assert [[tuple(s.split(".")) for s in steps[i].split(",")] for i in range(n)] == proofs
    assert all(fold(h("other"), way) != root for way in steps.values())


ROWS = [
    *[(i, "web", "en", 10 * i, f"tëxt {i}") for i in range(37)],
    *[(100 + i, None, None, None, "") for i in range(3)],
    (100, None, None, None, ""), (100, None, None, None, "x"),  # equal rows, and an equal id
    (None, "a", "fr", 1, None), (None, "a", "fr", 1, None), (5, "a", "fr", 1, "long " * 40000),
    (7, "b", "É", 2, "one leaf"), (8, "b", "", 2, "an empty group name"), (9, "b", "z", -1, "1:a-"),
]
SCHEMA = "doc_id BIGINT, source STRING, lang STRING, n_chars BIGINT, text STRING"


@pytest.mark.parametrize("arity, block_levels", [(2, 12), (2, 2), (2, 1), (3, 2)])
def test_manifest_equals_brute_force(spark, arity, block_levels):
    clash = SCHEMA + ", tree STRING, pos STRING, digest STRING, height INT, block INT, steps STRING, note INT"
    rows = spark.createDataFrame([(*r, "t", "p", "d", 1, 2, "s", 3) for r in ROWS], clash).repartition(5)
    found = manifest(rows, arity=arity, block_levels=block_levels)
    found = found.select("doc_id", "leaf", "subroot", "root", proof_of(F.col("steps")).alias("proof"))
    assert by_id(map(tuple, found.collect())) == by_id(brute(ROWS, arity))


def test_verify_finds_what_changed(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    other = leaf_digest(F.col(c) if c != "text" else F.when(F.col("doc_id") != 3, F.col("text")) for c in FIELDS)
    found = verify(manifest(rows, carry={"claimed": other}, block_levels=2), "claimed").collect()
    assert {r["doc_id"] for r in found if not r["verified"]} == {3}
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in found)


def test_empty_and_single_rows(spark):
    empty = verify(manifest(spark.createDataFrame([], SCHEMA)))
    assert empty.count() == 0
    one = verify(manifest(spark.createDataFrame(ROWS[:1], SCHEMA))).collect()
    assert [(r["leaf"], r["steps"], r["verified"]) for r in one] == [(leaf_of(ROWS[0]), "", True)]
    assert one[0]["root"] == one[0]["subroot"] == one[0]["leaf"]


def test_registered_rows(spark):
    rows = [tuple(r[c] for c in FIELDS) for r in pq.read_table(f"{SF_DIR}/documents.parquet").to_pylist()]
    wanted = {r[0]: r for r in brute(rows)}
    counts = {r[0]: r[3] for r in rows}
    found = op13_merkle_manifest(spark, SF_DIR)
    assert found.count() == len(wanted)
    for doc_id, leaf, subroot, root, proof, folded, verified in values(
        found, "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ):
        assert (leaf, subroot, root, proof) == (*wanted[doc_id][1:4], h(wanted[doc_id][4]))
        changed = zlib.crc32(str(doc_id).encode()) % 7 == 0 and counts[doc_id] is not None
        assert verified == (not changed) == (folded == root)
