"""Packing of whole documents into sequences by minimum bin slack (4).

A document of n ids fills n // size sequences by itself; only its tail of n % size ids has to share
one. All that packing needs to know of the tails is how many there are of each length, a table of
fewer than `size` numbers at any input size. On it the driver finds windows: the longest tail left
plus the multiset of others, found by a bitset subset-sum over bounded counts, that brings the sum
closest to the capacity. A window is repeated as often as the counts allow, so the number of
distinct windows is bounded as well. Windows that close exactly become sequences. Lengths that no
window closes are laid end to end and cut at multiples of the capacity, and the last rest is cut at
powers of two, so no padding remains. Each tail finds its place by its rank among those of its
length, which needs counts per file partition and no sorting or shuffling of ids.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import pick, release, slices, table, texts_of
from headway.llm.tokens import encoder, vocabulary
from headway.plans.staging import new_path

SIZE = 1024
END_ID = 0
#: Partition rank tables of so many bytes at most are broadcast; larger ones are joined by sorting.
BROADCAST_BYTES = 64 << 20


def closest_fill(counts: Counter, capacity: int) -> tuple[int, Counter]:
    """The largest reachable sum up to `capacity`, and how many of each length make it.

    `reach` is a bitset of sums; counts are added in powers of two, longest lengths first, and the
    bitset before each addition is kept to trace the counts back.
    """
    full = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n, k in counts.items() if k and n <= capacity), reverse=True):
        left, part = min(counts[length], capacity // length), 1
        while left:
            take = min(part, left)
            wider = (reach | reach << (length * take)) & full
            if wider != reach:
                steps.append((reach, length, take))
                reach = wider
            left, part = left - take, part * 2
        if reach >> capacity:
            break
    total = best = reach.bit_length() - 1
    used: Counter = Counter()
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            used[length] += take
            total -= length * take
    return best, used


@dataclass
class Plan:
    """Where the k-th tail of each length goes. All arrays are bounded by the number of windows."""

    keys: np.ndarray  # length << 40 | first rank, ascending
    first_sequence: np.ndarray
    per_window: np.ndarray
    offset: np.ndarray
    stream_from: np.ndarray  # by length: the first rank laid end to end
    stream_base: np.ndarray  # by length: where that rank begins
    windows: int
    stream_tokens: int
    size: int

    @property
    def last_cuts(self) -> np.ndarray:
        """Ends of the last sequences, whose lengths are powers of two, from the last multiple on."""
        rest = self.stream_tokens % self.size
        parts = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        return np.cumsum(parts, dtype=np.int64) if parts else np.zeros(0, np.int64)

    @property
    def sequences(self) -> int:
        return self.windows + self.stream_tokens // self.size + len(self.last_cuts)

    def place(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the tail, length, sequence, offset) of the pieces of one tail."""
        if not length:
            return []
        if rank < self.stream_from[length]:
            i = int(np.searchsorted(self.keys, (length << 40) | rank, side="right")) - 1
            past = rank - (int(self.keys[i]) & ((1 << 40) - 1))
            k = int(self.per_window[i])
            return [(0, length, int(self.first_sequence[i]) + past // k, int(self.offset[i]) + past % k * length)]
        at = int(self.stream_base[length]) + (rank - int(self.stream_from[length])) * length
        pieces, done = [], 0
        last_full = self.stream_tokens // self.size
        while done < length:
            number, inside = divmod(at + done, self.size)
            if number < last_full:
                begin, end, sequence = 0, self.size, self.windows + number
            else:
                ends = self.last_cuts
                j = int(np.searchsorted(ends, inside, side="right"))
                begin, end = (int(ends[j - 1]) if j else 0), int(ends[j])
                sequence = self.windows + last_full + j
            take = min(length - done, end - inside)
            pieces.append((done, take, sequence, inside - begin))
            done += take
        return pieces


def plan_tails(histogram: dict[int, int], size: int = SIZE) -> Plan:
    """Windows for the tails of each length. Uses counts only, so its work does not grow with rows."""
    left = Counter({n: k for n, k in histogram.items() if 0 < n < size and k > 0})
    taken: Counter = Counter()
    keys, firsts, per, offsets = [], [], [], []
    sequences = 0
    open_lengths = set(left)
    while open_lengths:
        longest = max(open_lengths)
        others = left.copy()
        others[longest] -= 1
        best, used = closest_fill(others, size - longest)
        if best < size - longest:
            open_lengths.discard(longest)
            continue
        used[longest] += 1
        times = min(left[n] // k for n, k in used.items())
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            keys.append((n << 40) | taken[n])
            firsts.append(sequences)
            per.append(k)
            offsets.append(offset)
            offset += n * k
            taken[n] += k * times
            left[n] -= k * times
            if not left[n]:
                open_lengths.discard(n)
        sequences += times
    stream_from = np.zeros(size, dtype=np.int64)
    stream_base = np.zeros(size, dtype=np.int64)
    at = 0
    for n in range(size - 1, 0, -1):
        stream_from[n], stream_base[n] = taken[n], at
        at += left[n] * n
    order = np.argsort(np.array(keys, dtype=np.int64), kind="stable")
    columns = [np.array(c, dtype=np.int64)[order] for c in (keys, firsts, per, offsets)]
    return Plan(*columns, stream_from, stream_base, sequences, at, size)


def tokenised(
    docs: DataFrame, id_col: str, text_col: str, tokenizer: str, size: int, end_id: int
) -> DataFrame:
    """Ids of every row as little-endian 32-bit numbers, with its rank among its partition's rows."""
    kind = docs.schema[id_col].dataType

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = encoder(vocabulary(tokenizer))
        part = TaskContext.get().partitionId()
        seen, full = np.zeros(size, dtype=np.int64), 0
        for batch in slices(batches, "c1"):
            ids = [np.append(x, np.uint32(end_id)) for x in made.encode(texts_of(batch.column("c1")))]
            n = np.array([len(x) for x in ids], dtype=np.int64)
            tails, nth, before = n % size, [], []
            for tail, whole in zip(tails, n // size):
                nth.append(seen[tail])
                before.append(full)
                seen[tail] += 1
                full += whole
            blobs = pa.array([x.astype("<u4", copy=False).tobytes() for x in ids], pa.binary())
            columns = [batch.column("c0"), pa.array(n), blobs, pa.array([part] * len(n), pa.int32())]
            columns += [pa.array(tails.astype(np.int32)), pa.array(nth, pa.int64()), pa.array(before, pa.int64())]
            names = ["c0", "doc_tokens", "ids", "part", "tail", "nth", "full_before"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        f"c0 {kind.simpleString()}, doc_tokens BIGINT, ids BINARY, part INT, tail INT, nth BIGINT,"
        " full_before BIGINT"
    )
    return pick(docs, id_col, text_col).mapInArrow(encode, schema)


def _partition_ranks(rows: DataFrame, size: int) -> DataFrame:
    """Per partition: how many tails of each length, and full sequences, earlier partitions hold."""
    counts = rows.groupBy("part", "tail").agg(
        F.count("*").alias("n"), F.sum(F.expr(f"doc_tokens div {size}")).alias("full")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    of_length = counts.withColumn(
        "earlier", F.coalesce(F.sum("n").over(earlier.partitionBy("tail")), F.lit(0))
    )
    ranks = of_length.groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("tail", "earlier"))).alias("earlier"),
        F.sum("full").alias("full"),
    )
    # One row per file partition, so this window without keys stays small.
    return ranks.select(
        F.col("part").alias("of_part"),
        "earlier",
        F.coalesce(F.sum("full").over(earlier), F.lit(0)).alias("full_earlier"),
    )


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = "byte_bpe_50k.json",
    size: int = SIZE,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of packed documents: `id_col`, start, length, ids, doc_tokens, sequence_id, offset.

    Every row's ids, then `end_id`, lie in pieces that together hold each id once; `ids` is their
    little-endian unsigned 32-bit form. Sequences hold `size` ids, or a power of two below. A null
    text counts as empty and yields the end id alone. Rows with equal or null ids are packed as
    separate rows; other columns are ignored; an empty table gives no pieces.
    """
    spark = docs.sparkSession
    path = new_path(spark, "packing_ids")
    made = tokenised(docs, id_col, text_col, tokenizer, size, end_id)
    made.write.option("compression", "zstd").parquet(path)
    rows = spark.read.schema(made.schema).parquet(path)

    histogram = {r["tail"]: r["n"] for r in rows.groupBy("tail").agg(F.count("*").alias("n")).collect()}
    plan = plan_tails(histogram, size)
    ranks = _partition_ranks(rows, size)
    ranks_path = new_path(spark, "packing_ranks")
    ranks.write.parquet(ranks_path)
    ranks = spark.read.schema(ranks.schema).parquet(ranks_path)
    if ranks.count() * size * 12 <= BROADCAST_BYTES:
        ranks = F.broadcast(ranks)

    piece = "array<struct<start:bigint,length:bigint,sequence_id:bigint,offset:bigint>>"

    @F.pandas_udf(piece)
    def tails(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        release()
        for tail, rank in batches:
            yield pd.Series([plan.place(int(n), int(r)) for n, r in zip(tail, rank)])

    full = F.expr(f"doc_tokens div {size}")
    placed = rows.join(ranks, F.col("part") == F.col("of_part")).select(
        "c0", "doc_tokens", "ids",
        (F.col("full_earlier") + F.col("full_before") + F.lit(plan.sequences)).alias("first"),
        full.alias("full"),
        tails("tail", F.col("nth") + F.col("earlier")[F.col("tail")]).alias("tails"),
    )
    whole = F.when(
        F.col("full") > 0,
        F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("full") - 1),
            lambda i: F.struct(
                (i * size).alias("start"),
                F.lit(size).cast("bigint").alias("length"),
                (F.col("first") + i).alias("sequence_id"),
                F.lit(0).cast("bigint").alias("offset"),
            ),
        ),
    ).otherwise(F.array().cast(piece))
    rest = F.transform(
        "tails",
        lambda p: F.struct(
            (p["start"] + F.col("full") * size).alias("start"),
            p["length"].alias("length"),
            p["sequence_id"].alias("sequence_id"),
            p["offset"].alias("offset"),
        ),
    )
    pieces = placed.select("c0", "doc_tokens", "ids", F.explode(F.concat(whole, rest)).alias("p"))
    cut = F.substring(F.col("ids"), (F.col("p.start") * 4 + 1).cast("int"), (F.col("p.length") * 4).cast("int"))
    return pieces.select(
        F.col("c0").alias(id_col),
        "p.start",
        "p.length",
        cut.alias("ids"),
        "doc_tokens",
        "p.sequence_id",
        "p.offset",
    )


def with_checksums(pieces: DataFrame) -> DataFrame:
    """The CRC-32 of each piece's ids in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_checksums(pack(table(spark, sf_dir, "documents")))
