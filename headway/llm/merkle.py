"""A Merkle manifest of a dataset by time-forward processing (13).

Every row is a leaf of the tree of its group, and the groups' roots are the leaves of a last tree.
Nodes are handled in the order of their labels (level, then place), and a node's digest is a message
to the label of its parent, which is computed when it leads the queue with all it was sent. A sweep
in reversed order sends the way to the root back down: to its own, each node adds the digests beside
each child, and what reaches a leaf is its proof.

The queue is external: it is cut into blocks of `BLOCK_LEVELS` levels, messages inside a block wait
in a heap of bounded size, and messages between blocks are rows of a stage table that Spark's
shuffle sorts to the block of their receiver. Blocks of one layer run side by side; the layers are
as many as the height divided by `BLOCK_LEVELS`. No task sees more than one block of any tree, no
matter how many rows a group has.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator, Mapping
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import table
from headway.plans.staging import stage

ARITY = 2
#: Levels of a block: at two children a node, it has 4,096 leaves at most.
BLOCK_LEVELS = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: (level, place) of a node, the place of its first child, and the digests it was sent.
Run = tuple[tuple[int, int], int, list[str]]


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def sweep_up(leaves: Iterable[tuple[int, str]], levels: int, arity: int = ARITY) -> Iterator[Run]:
    """Nodes above the leaves in the order of their labels, each with what it was sent."""
    if not levels:
        return
    queue = [((1, place // arity), place, sent) for place, sent in leaves]
    heapq.heapify(queue)
    while queue:
        label, first, sent = heapq.heappop(queue)
        run = [sent]
        while queue and queue[0][0] == label:
            run.append(heapq.heappop(queue)[2])
        yield label, first, run
        level, place = label
        if level < levels:
            heapq.heappush(queue, ((level + 1, place // arity), place, digest("".join(run))))


def sweep_down(runs: list[Run], suffix: str) -> Iterator[tuple[tuple[int, int], str]]:
    """From the top node's steps to the root, the steps of every node below it.

    A step is the digests left of a node in its run, a dot, and those right of it; steps from the
    node to the root are joined by commas.
    """
    waiting = {runs[-1][0]: suffix}
    for label, first, run in reversed(runs):
        above = waiting.pop(label)
        for i in range(len(run)):
            step = f"{''.join(run[:i])}.{''.join(run[i + 1 :])}"
            child = (label[0] - 1, first + i)
            waiting[child] = f"{step},{above}" if above else step
            if not child[0]:
                yield child, waiting.pop(child)


def fold(leaf: str, steps: str) -> str:
    """The root that a leaf and its steps lead to."""
    for step in steps.split(",") if steps else ():
        left, right = step.split(".")
        leaf = digest(left + leaf + right)
    return leaf


def proof_of(steps: Column) -> Column:
    """The siblings' digests from the leaf to the root, one after the other."""
    return F.translate(steps, ".,", "")


def leaf_digest(values: Iterable[Column]) -> Column:
    """Digest of a row: of each value its length in UTF-8 bytes, a colon and itself, or `-` for null."""
    texts = [value.cast("string") for value in values]
    marked = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(m, F.lit("-")) for m in marked]), 256)


def ranked(rows: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Place of each row in the order of the keys, from 0, without bringing rows together.

    Rows are sorted by ranges; a row's place is the size of the ranges before its own, of which there
    are as many as shuffle partitions, plus its place within.
    """
    numbered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = stage(numbered.withColumn("_at", F.monotonically_increasing_id()), "merkle_sorted")
    part = F.shiftright("_at", 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")
    starts = stage(sizes.select("_part", before.alias("_start")), "merkle_ranges")
    place = F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return numbered.join(starts, part == F.col("_part")).select(*rows.columns, place.alias(rank))


def _height(n: Column, arity: int) -> Column:
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(62)), lambda h: F.pow(F.lit(float(arity)), h) < n))


class Forest:
    """Trees over `nodes` (tree, pos, digest, height, and more for leaves), block layer by layer."""

    def __init__(self, nodes: DataFrame, arity: int, block_levels: int) -> None:
        self.arity, self.levels = arity, block_levels
        top = nodes.agg(F.max("height")).first()[0]
        self.layers = [nodes]
        self.count = 0 if top is None else max(1, math.ceil(top / block_levels))
        found = []
        for layer in range(self.count):
            heads = stage(self._heads(layer), "merkle_heads")
            found.append(heads.where(f"height <= {(layer + 1) * block_levels}").select("tree", "digest"))
            self.layers.append(heads.where(f"height > {(layer + 1) * block_levels}"))
        self.roots = found[0] if found else nodes.select("tree", "digest")
        for more in found[1:]:
            self.roots = self.roots.unionByName(more)

    def _blocks(self, layer: int) -> DataFrame:
        fan = self.arity**self.levels
        return self.layers[layer].withColumn("block", F.expr(f"pos div {fan}"))

    def _heads(self, layer: int) -> DataFrame:
        arity, block_levels = self.arity, self.levels

        def run(rows: pa.Table) -> pa.Table:
            height = rows["height"][0].as_py()
            leaves = list(zip(rows["pos"].to_pylist(), rows["digest"].to_pylist()))
            head = leaves[0][1]
            for _, _, sent in sweep_up(leaves, min(block_levels, height - layer * block_levels), arity):
                head = digest("".join(sent))
            one = {"tree": rows["tree"][:1], "pos": rows["block"][:1], "digest": [head], "height": [height]}
            return pa.table(one, pa.schema([("tree", pa.int64()), ("pos", pa.int64()), ("digest", pa.string()), ("height", pa.int32())]))

        slim = self._blocks(layer).select("tree", "block", "pos", "digest", "height")
        return slim.groupBy("tree", "block").applyInArrow(run, "tree BIGINT, pos BIGINT, digest STRING, height INT")

    def steps(self, heads: DataFrame) -> DataFrame:
        """Every leaf with its steps to the root, given those of the trees' roots.

        `heads` has a row for each tree: tree, steps, and a column `note` that goes down unchanged.
        """
        height = self.layers[0].groupBy("tree").agg(F.max("height").alias("height"))
        last = F.greatest(F.lit(0), F.ceil(F.col("height") / self.levels) - 1)
        heads = stage(heads.join(height, "tree").withColumn("layer", last), "merkle_tops")
        sent = None
        for layer in reversed(range(self.count)):
            here = heads.where(F.col("layer") == layer).select(
                "tree", F.lit(0).cast("bigint").alias("block"), "steps", "note"
            )
            here = here if sent is None else here.unionByName(sent)
            found = self._delivered(layer, here)
            if layer:
                found = stage(found.select("tree", F.col("pos").alias("block"), "steps", "note"), "merkle_steps")
            sent = found
        return sent

    def _delivered(self, layer: int, messages: DataFrame) -> DataFrame:
        arity, block_levels = self.arity, self.levels
        rows = self._blocks(layer)
        kept = [c for c in rows.columns if c != "block"]

        def run(block: pa.Table, message: pa.Table) -> pa.Table:
            suffix, note = message["steps"][0].as_py(), message["note"][0].as_py()
            levels = min(block_levels, block["height"][0].as_py() - layer * block_levels)
            places = block["pos"].to_pylist()
            if levels:
                runs = list(sweep_up(zip(places, block["digest"].to_pylist()), levels, arity))
                found = {place: steps for (_, place), steps in sweep_down(runs, suffix)}
                steps = [found[place] for place in places]
            else:
                steps = [suffix] * len(places)
            out = block.select(kept).append_column("steps", pa.array(steps, pa.string()))
            return out.append_column("note", pa.array([note] * len(places), pa.string()))

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(kept).schema)
        left = rows.groupBy("tree", "block")
        return left.cogroup(messages.groupBy("tree", "block")).applyInArrow(run, f"{schema}, steps STRING, note STRING")


def manifest(
    rows: DataFrame,
    id_col: str = "doc_id",
    tree_col: str = "lang",
    fields: Iterable[str] = FIELDS,
    carry: Mapping[str, Column] | None = None,
    arity: int = ARITY,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Each row's leaf, the roots above it and its proof: id, leaf, subroot, root, steps, `carry`.

    `fields` are hashed in this order. Rows with an equal `tree_col`, null included, form a tree in
    the order of their ids, null first; rows of an equal id stand in the order of their leaves, and
    equal rows are leaves of their own. While several nodes remain, every `arity` neighbours become
    their digest, the last ones even if fewer. The trees' roots, null first and else in the order of
    their bytes, form the last tree in the same way. `steps` is read by `fold` and `proof_of`.
    `carry` names expressions over `rows` that come along. No rows give no rows.
    """
    spark = rows.sparkSession
    carry = dict(carry or {})
    leaves = rows.select(
        F.col(f"`{tree_col}`").cast("string").alias("_key"),
        F.col(f"`{id_col}`").alias("_id"),
        leaf_digest(F.col(f"`{c}`") for c in fields).alias("digest"),
        *[value.alias(f"_{i}") for i, value in enumerate(carry.values())],
        F.monotonically_increasing_id().alias("_row"),
    )
    leaves = ranked(stage(leaves, "merkle_leaves"), ["_key", "_id", "digest", "_row"], "_rank")
    trees = leaves.groupBy("_key").agg(F.min("_rank").alias("_first"), F.count("*").alias("_n"))
    trees = stage(ranked(stage(trees, "merkle_groups"), ["_key"], "tree"), "merkle_trees")
    height = _height(F.col("_n"), arity).alias("height")
    known = trees.select(F.col("_key").alias("_of"), "tree", "_first", height)
    others = [c for c in leaves.columns if c not in ("_key", "_rank", "_row")]
    nodes = leaves.join(known, F.col("_key").eqNullSafe(F.col("_of"))).select(
        "tree", (F.col("_rank") - F.col("_first")).alias("pos"), "height", *others
    )
    forest = Forest(stage(nodes, "merkle_nodes"), arity, block_levels)

    n = trees.count()
    top_height = _height(F.lit(n), arity)
    tops = forest.roots.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), "digest", top_height.alias("height")
    )
    top = Forest(stage(tops, "merkle_roots"), arity, block_levels)
    root = top.roots.first()
    whole = root["digest"] if root else None
    start = spark.range(1).select(F.col("id").alias("tree"), F.lit("").alias("steps"), F.lit("").alias("note"))
    if whole is None:
        ways = nodes.select("*", F.lit("").alias("steps"), F.lit("").alias("note"))
    else:
        sent = top.steps(start)  # the note that goes down a tree is its root
        ways = forest.steps(sent.select(F.col("pos").alias("tree"), "steps", F.col("digest").alias("note")))
    return ways.select(
        F.col("_id").alias(id_col),
        F.col("digest").alias("leaf"),
        F.col("note").alias("subroot"),
        F.lit(whole).cast("string").alias("root"),
        "steps",
        *[F.col(f"_{i}").alias(name) for i, name in enumerate(carry)],
    )


def verify(rows: DataFrame, leaf_col: str = "leaf") -> DataFrame:
    """Rows of a manifest with `folded_root`, computed from `leaf_col` and the steps, and `verified`.

    A null leaf folds to null and is not verified.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(leaf_col).to_pylist(), batch.column("steps").to_pylist())
            roots = pa.array([None if leaf is None else fold(leaf, steps) for leaf, steps in both], pa.string())
            yield batch.append_column("folded_root", roots)

    folded = rows.mapInArrow(run, f"{schema}, folded_root STRING")
    return folded.withColumn("verified", F.coalesce(F.col("folded_root") == F.col("root"), F.lit(False)))


def _tampered(name: str) -> Column:
    """A field of documents after tampering: some rows count a character too many."""
    if name != "n_chars":
        return F.col(name)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = F.col(name).cast("decimal(20,0)") + F.when(chosen, 1).otherwise(0)
    return more.cast("string")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and whether its tampered row still leads to the root."""
    claimed = leaf_digest(_tampered(name) for name in FIELDS)
    found = verify(manifest(table(spark, sf_dir, "documents"), carry={"claimed": claimed}), "claimed")
    proof = F.sha2(proof_of(F.col("steps")), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


def _crc32_table() -> list[int]:
    """The byte table of CRC-32, by its rule."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


def _sql(levels: int, top_levels: int) -> str:
    """The manifest in DuckDB, for trees of up to 2 ** `levels` leaves."""
    def marked(value: str) -> str:
        return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"

    bytes_ = "list_transform(range(1, length(name) + 1), lambda i: CAST(ascii(substr(name, i, 1)) AS BIGINT))"
    step = f"lambda c, b: xor(c >> 8, {_crc32_table()}[CAST((xor(c, b) & 255) + 1 AS BIGINT)])"
    crc = f"xor(list_reduce({bytes_}, {step}, CAST(4294967295 AS BIGINT)), 4294967295)"
    leaf = " || ".join(marked(c) for c in FIELDS)
    changed = f"(CASE WHEN {crc} % 7 = 0 THEN n_chars + 1 ELSE n_chars END)"
    claimed = " || ".join(marked(changed if c == "n_chars" else c) for c in FIELDS)
    ctes = [
        "named AS (SELECT *, CAST(doc_id AS VARCHAR) AS name FROM documents)",
        f"hashed AS (SELECT doc_id, lang, sha256({leaf}) AS leaf, sha256({claimed}) AS claimed FROM named)",
        "leaves AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, "
        "row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, "
        "count(*) OVER (PARTITION BY lang) AS n FROM hashed)",
        "a0 AS (SELECT tree, pos, leaf AS d, n FROM leaves)",
        "f0 AS (SELECT *, claimed AS fold, '' AS proof FROM leaves)",
    ]

    def tree(name: str, folded: str, levels: int, keep: str) -> None:
        for k in range(levels):
            ctes.append(
                f"{name}{k + 1} AS (SELECT tree, pos // 2 AS pos, CASE WHEN max(n) > {2**k} THEN "
                f"sha256(string_agg(d, '' ORDER BY pos)) ELSE min(d) END AS d, max(n) AS n "
                f"FROM {name}{k} GROUP BY tree, pos // 2)"
            )
            side = f"(f.pos >> {k}) & 1"
            ctes.append(
                f"{folded}{k + 1} AS (SELECT {keep}, f.tree, f.pos, f.n, f.proof || coalesce(s.d, '') AS proof, "
                f"CASE WHEN f.n <= {2**k} THEN f.fold WHEN {side} = 1 THEN sha256(s.d || f.fold) "
                f"ELSE sha256(f.fold || coalesce(s.d, '')) END AS fold FROM {folded}{k} AS f "
                f"LEFT JOIN {name}{k} AS s ON s.tree = f.tree AND s.pos = xor(f.pos >> {k}, 1) AND f.n > {2**k})"
            )

    tree("a", "f", levels, "f.doc_id, f.leaf")
    ctes.append(f"b0 AS (SELECT 0 AS tree, tree AS pos, d, count(*) OVER () AS n FROM a{levels})")
    ctes.append(
        f"g0 AS (SELECT f.doc_id, f.leaf, a.d AS subroot, 0 AS tree, f.tree AS pos, b.n, f.proof, f.fold "
        f"FROM f{levels} AS f JOIN a{levels} AS a ON a.tree = f.tree JOIN b0 AS b ON b.pos = f.tree)"
    )
    tree("b", "g", top_levels, "f.doc_id, f.leaf, f.subroot")
    return (
        f"WITH {', '.join(ctes)} SELECT doc_id, leaf, subroot, b.d AS root, sha256(proof) AS proof_sha256, "
        f"fold AS folded_root, fold = b.d AS verified FROM g{top_levels} CROSS JOIN b{top_levels} AS b"
    )


OP13_SQL = _sql(levels=17, top_levels=4)
