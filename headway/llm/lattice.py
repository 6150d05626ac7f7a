"""SentencePiece encoding and decoding with sampled segmentations (2).

All segmentations of a text into pieces form a lattice. The best are drawn without replacement by a
perturbed search: the whole lattice gets a Gumbel value, and each choice of a piece hands the value
on to the piece drawn in proportion to what lies behind it, while the pieces not drawn share a value
below it, as the largest of a smaller set would have. The frontier therefore holds, at each step,
the best value of everything not yet emitted, so an A-star search with it as bound emits distinct
segmentations in the order of their values, and the value that comes next gives each its
inclusion probability.

Pieces never reach over the start of a word, so the lattice of a text is a chain of word lattices,
built once per word and task. Words are searched from the first to the last and each from its end,
and a search step is taken for all words of a batch at once. Draws depend on seed, key and position
alone, not on batches or partitions.

The pieces of a byte-pair model carry merge ranks instead of probabilities; rank r is given the
weight 1 / (r + 2.7), normalised over all pieces. Characters without a piece fall back to bytes.
"""

from __future__ import annotations

import heapq
import math
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import pick, slices, table, texts_of
from headway.llm.tokens import vocabulary

SAMPLES = 3
SEED = 11
THETA = 1.0
SHIFT = 2.7
#: What lies behind a choice less likely than e to the minus this can't come next: its value would
#: have to exceed its mean by as much, which has a chance below 1e-25.
REACH = 60.0
#: Word lattices kept per task, counted in nodes; the store begins anew beyond it.
KEPT_NODES = 4_000_000

_WORD = re.compile("▁*[^▁]+|▁+")
_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)  # of the hashes by which beginnings of pieces are found
_LOW = (1 << 64) - 1
_TOP = 47  # bits below those that lead to the place of a hash

#: Texts handled together; the edges of their new words are built at once.
LATTICE_CHARS = 1 << 19


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> _U(30))
    values *= _U(0xBF58476D1CE4E5B9)
    values ^= values >> _U(27)
    values *= _U(0x94D049BB133111EB)
    values ^= values >> _U(31)
    return values


def _mixed_one(value: int) -> int:
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & _LOW
    value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) & _LOW
    return value ^ (value >> 31)


def _uniform(seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on seed and place alone."""
    mixed = _mixed(seeds + places.astype(_U) * _U(0x9E3779B97F4A7C15))
    return ((mixed >> _U(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _one(seed: int, *places: int) -> float:
    """One number in (0, 1) that depends on the seed and all places, the last as in `_uniform`."""
    value = seed
    for place in places[:-1]:
        value = _mixed_one((value + place * 0xD1342543DE82EF95) & _LOW)
    mixed = _mixed_one((value + places[-1] * 0x9E3779B97F4A7C15) & _LOW)
    return (float(mixed >> 11) + 0.5) / float(1 << 53)


def split_words(text: str) -> list[str]:
    """Words of a normalised text, each with the `▁` before it."""
    return _WORD.findall(text)


def distinct_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words of normalised texts, the place of each word among them, and how many each text has."""
    plain = [t.startswith("▁") and "▁▁" not in t and not t.endswith("▁") for t in texts]
    parts = pc.split_pattern(pa.array([t[1:] for t, p in zip(texts, plain) if p], pa.large_string()), "▁")
    coded = parts.flatten().dictionary_encode()
    words = ["▁" + word for word in coded.dictionary.to_numpy(zero_copy_only=False)]
    codes = coded.indices.to_numpy().astype(np.int64)
    sizes = pc.list_value_length(parts).to_numpy().astype(np.int64)
    if all(plain):
        return words, codes, sizes
    known = {word: i for i, word in enumerate(words)}
    split = iter(np.split(codes, np.cumsum(sizes)))
    own = [
        next(split) if p else np.array([known.setdefault(w, len(known)) for w in split_words(t)], dtype=np.int64)
        for t, p in zip(texts, plain)
    ]
    return list(known), np.concatenate(own), np.array([len(x) for x in own], dtype=np.int64)


class Pieces:
    """Pieces, their weights and their bytes, from a SentencePiece model."""

    def __init__(self, path: str, theta: float = THETA) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        texts = [self.model.id_to_piece(i) for i in range(size)]
        scores = [self.model.get_score(i) for i in range(size)]
        odd = [self.model.is_control(i) or self.model.is_unknown(i) for i in range(size)]
        byte = [self.model.is_byte(i) for i in range(size)]
        worst = min((s for s, b in zip(scores, byte) if not b and s > -1e6), default=0.0)
        weights = [1 / (SHIFT - (worst if b else s)) for s, b in zip(scores, byte)]
        total = math.log(sum(w for w, o in zip(weights, odd) if not o))
        self.weight = [theta * (math.log(w) - total) for w in weights]
        self.places = {t: i for i, t in enumerate(texts) if not odd[i] and not byte[i]}
        self.begun = {t[:n] for t in self.places for n in range(1, len(t) + 1)}
        self.byte_ids = {int(t[3:5], 16): i for i, t in enumerate(texts) if byte[i]}
        self.content = [
            b"" if odd[i] else bytes([int(t[3:5], 16)]) if byte[i] else t.replace("▁", " ").encode()
            for i, t in enumerate(texts)
        ]
        self.contents = pa.array(self.content, pa.large_binary())
        self.unknown = self.model.unk_id()
        self.tables = self._tables()

    def _tables(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By length: sorted hashes of all beginnings of pieces, the piece that each one is, and where
        the hashes of each value of their top bits start."""
        found: dict[int, dict[str, int]] = {}
        for part in self.begun:
            found.setdefault(len(part), {})[part] = self.places.get(part, -1)
        tables = []
        for n in range(1, max(found, default=0) + 1):
            codes = np.frombuffer("".join(found[n]).encode("utf-32-le"), np.uint32).reshape(-1, n)
            hashes = np.zeros(len(codes), dtype=_U)
            for i in range(n):
                hashes = hashes * _STEP + codes[:, i].astype(_U) + _U(1)
            hashes = _mixed(hashes)
            order = np.argsort(hashes)
            hashes = np.append(hashes[order], _U(_LOW))
            tops = np.arange(1 << (64 - _TOP), dtype=_U) << _U(_TOP)
            begun = np.searchsorted(hashes, tops).astype(np.int32)
            tables.append((hashes, np.append(np.array(list(found[n].values()), dtype=np.int64)[order], -1), begun))
        return tables

    def normalised(self, text: str) -> str:
        """The text as pieces see it, with `▁` for spaces and one before the first word."""
        return self.model.normalize(text) if text else ""

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of piece ids; the space that stands before the first word goes."""
        content = self.content
        data = b"".join(map(content.__getitem__, ids))
        return data.removeprefix(b" ").decode(errors="replace")

    def decode_each(self, rows: list[np.ndarray]) -> Iterator[bytes]:
        """The text of each row of ids in UTF-8, as `decode` gives it; one Arrow call joins all pieces."""
        ends = np.cumsum([0] + [len(ids) for ids in rows])
        taken = self.contents.take(pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64)))
        _, offsets, joined = taken.buffers()
        places = np.frombuffer(offsets, np.int64, len(taken) + 1)[ends] if len(taken) else np.zeros(len(ends), np.int64)
        places = places.tolist()
        whole = memoryview(joined) if joined else b""
        for low, high in zip(places[:-1], places[1:]):
            data = bytes(whole[low:high]).removeprefix(b" ")
            try:
                data.decode()
            except UnicodeDecodeError:
                data = data.decode(errors="replace").encode()
            yield data

    def fallback(self, char: str) -> tuple[list[int], float]:
        """Ids and weight of a character that has no piece."""
        if not self.byte_ids:
            return [self.unknown], self.weight[self.unknown]
        ids = [self.byte_ids[b] for b in char.encode()]
        return ids, sum(self.weight[i] for i in ids)


@lru_cache(maxsize=4)
def pieces(path: str, theta: float = THETA) -> Pieces:
    return Pieces(path, theta)


class Lattices:
    """Word lattices in flat arrays. The edges of a node lead back to earlier characters; each has
    the probability that a segmentation of the word up to the node ends with its piece."""

    def __init__(self, model: Pieces) -> None:
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.first_node, self.length = array("q"), array("q")
        self.edge_start = array("q", [0])
        self.upto, self.log = array("d"), array("d")
        self.back, self.piece = array("i"), array("i")
        self.extra: dict[str, int] = {}
        self.extra_ids: list[list[int]] = []

    def _extra(self, char: str) -> tuple[int, float]:
        ids, weight = self.model.fallback(char)
        if char not in self.extra:
            self.extra[char] = -1 - len(self.extra_ids)
            self.extra_ids.append(ids)
        return self.extra[char], weight

    def _add(self, words: list[str]) -> None:
        """Build the lattices of new words, all characters of the same place at a time."""
        lengths = np.array([len(word) for word in words], dtype=np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(_U)
        ends = np.cumsum(lengths)
        end_of = np.repeat(ends, lengths)
        word_of = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        weight = np.array(self.model.weight)

        # Edges from each character: every piece that begins there. Node = character + word number.
        starts, sizes, numbers, weights = [], [], [], []
        at, hashes = np.arange(len(codes), dtype=np.int32), np.zeros(len(codes), dtype=_U)
        for n, (known, piece, begin) in enumerate(self.model.tables, 1):
            inside = np.flatnonzero(at + n <= end_of[at])
            at, hashes = at[inside], hashes[inside]
            if not len(at):
                break
            hashes = hashes * _STEP + codes[at + (n - 1)] + _U(1)
            sought = _mixed(hashes)
            place = begin[sought >> _U(_TOP)]
            late = np.flatnonzero(known[place] < sought)
            while len(late):
                place[late] += 1
                late = late[known[place[late]] < sought[late]]
            begun = np.flatnonzero(known[place] == sought)
            at, hashes, found = at[begun], hashes[begun], piece[place[begun]]
            whole = np.flatnonzero(found >= 0)
            if n == 1:
                bare = np.ones(len(codes), dtype=bool)
                bare[at[whole]] = False
                odd = np.flatnonzero(bare).astype(np.int32)
                extra = [self._extra(chr(int(c))) for c in codes[odd]]
                starts.append(odd)
                sizes.append(np.ones(len(odd), dtype=np.int32))
                numbers.append(np.array([x for x, _ in extra], dtype=np.int32))
                weights.append(np.array([w for _, w in extra], dtype=np.float64))
            starts.append(at[whole])
            sizes.append(np.full(len(whole), n, dtype=np.int32))
            numbers.append(found[whole].astype(np.int32))
            weights.append(weight[found[whole]])
        start, size = np.concatenate(starts), np.concatenate(sizes)
        number, logs = np.concatenate(numbers), np.concatenate(weights)
        word = word_of[start]
        nodes = len(codes) + len(words)
        first = np.concatenate(([0], ends[:-1])) + np.arange(len(words))
        back = (start + word - first[word]).astype(np.int32)
        depth = back + size
        # By place in the word, then node: one slice holds all edges into the nodes of one place.
        order = np.argsort(depth.astype(np.int64) * nodes + first[word], kind="stable")
        back, depth, number, logs = back[order], depth[order], number[order], logs[order]
        source = back + first[word[order]]
        target = source + (depth - back)

        total = np.zeros(nodes)
        chance = np.empty(len(target))
        levels = np.searchsorted(depth, np.arange(1, int(lengths.max(initial=0)) + 2))
        for low, high in zip(levels[:-1], levels[1:]):
            values = total[source[low:high]] + logs[low:high]
            into = target[low:high]
            heads = np.flatnonzero(np.concatenate(([True], into[1:] != into[:-1])))
            runs = np.diff(np.append(heads, high - low))
            top = np.maximum.reduceat(values, heads)
            raw = np.exp(values - np.repeat(top, runs))
            every = np.add.reduceat(raw, heads)
            total[into[heads]] = top + np.log(every)
            chance[low:high] = np.minimum(raw / np.repeat(every, runs), 1.0)

        # The likeliest edge of a node first, so that a draw seldom has to look further.
        order = np.argsort(target + (1.0 - chance) * 0.5, kind="stable")
        back, target, number, chance = back[order], target[order], number[order], chance[order]
        heads = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
        runs = np.diff(np.append(heads, len(target)))
        done = np.cumsum(chance)
        upto = np.clip(done - np.repeat(done[heads] - chance[heads], runs), 0.0, 1.0)
        upto[heads + runs - 1] = 1.0
        with np.errstate(divide="ignore"):
            log = np.log(chance)

        base, edges = len(self.edge_start) - 1, len(self.upto)
        self.edge_start.frombytes((edges + np.cumsum(np.bincount(target, minlength=nodes))).astype("q").tobytes())
        self.upto.frombytes(upto.tobytes())
        self.back.frombytes(back.astype("i").tobytes())
        self.piece.frombytes(number.astype("i").tobytes())
        self.log.frombytes(log.tobytes())
        self.words.update(zip(words, range(len(self.length), len(self.length) + len(words))))
        self.first_node.frombytes((base + first).astype("q").tobytes())
        self.length.frombytes(lengths.astype("q").tobytes())

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct words; new ones are built and numbered in their order."""
        found = list(map(self.words.get, words))
        new = [i for i, number in enumerate(found) if number is None] if None in found else []
        if not new:
            return np.array(found, dtype=np.int64)
        first = len(self.length)
        self._add([words[i] for i in new])
        for number, i in enumerate(new, first):
            found[i] = number
        return np.array(found, dtype=np.int64)

    def ids(self, chosen: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of chosen pieces, characters without a piece spelled in bytes, and where the
        runs that end at `ends` end in them."""
        odd = np.flatnonzero(chosen < 0)
        if not len(odd):
            return chosen, ends
        if max(map(len, self.extra_ids)) == 1:
            out = chosen.copy()
            out[odd] = np.array(self.extra_ids)[-1 - chosen[odd], 0]
            return out, ends
        spelled = [self.extra_ids[-1 - p] for p in chosen[odd].tolist()]
        sizes = np.ones(len(chosen), dtype=np.int64)
        sizes[odd] = [len(x) for x in spelled]
        out = np.repeat(chosen, sizes)
        out[np.repeat(chosen < 0, sizes)] = [i for x in spelled for i in x]
        return out, np.concatenate(([0], np.cumsum(sizes)))[ends]


class _View:
    """The arrays of the lattices as they are, without copies."""

    def __init__(self, lattices: Lattices) -> None:
        kinds = {"first_node": "q", "length": "q", "edge_start": "q", "upto": "d", "log": "d", "back": "i", "piece": "i"}
        for name, kind in kinds.items():
            data = getattr(lattices, name)
            setattr(self, name, np.frombuffer(data, dtype=kind) if len(data) else np.zeros(0, kind))


def _walk(view: _View, nodes: np.ndarray, ends: np.ndarray, seeds: np.ndarray):
    """Draw a segmentation of each word from its character `ends` back to its start.

    Returns how many pieces each word got, and the edges drawn, word by word.
    """
    count = np.zeros(len(nodes), dtype=np.int64)
    active = np.flatnonzero(ends > 0)
    at, node, seed = ends[active], nodes[active], seeds[active]
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    while len(active):
        draw = _uniform(seed, at)
        edge = view.edge_start[node + at]
        late = np.flatnonzero(view.upto[edge] < draw)
        while len(late):
            edge[late] += 1
            late = late[view.upto[edge[late]] < draw[late]]
        steps.append((active, edge))
        count[active] += 1
        at = view.back[edge].astype(np.int64)
        go = np.flatnonzero(at)
        active, at, node, seed = active[go], at[go], node[go], seed[go]
    start = np.cumsum(count) - count
    edges = np.zeros(int(count.sum()), dtype=np.int64)
    for i, (who, edge) in enumerate(steps):
        edges[start[who] + i] = edge
    return count, edges


def _truncated(location: np.ndarray, bound: float | np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Gumbel values at `location`, given that they do not exceed `bound`."""
    with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
        return location - np.log(np.exp(location - bound) - np.log(draw))


class _Search:
    """The frontier of one text. A group is what remains at one choice of an emitted segmentation
    once some of its edges have been taken."""

    def __init__(self, key: int, first: int, last: int, bound: float) -> None:
        self.seed, self.first, self.last, self.bound = key, first, last, bound
        self.heap: list[tuple] = []
        self.emitted: list[dict] = []


def sample_texts(
    texts: list[str], keys: list[str], lattices: Lattices, samples: int, seed: int
) -> list[list[tuple[np.ndarray, float, float]]]:
    """For each text up to `samples` segmentations: (ids, log probability, log inclusion)."""
    if len(lattices.edge_start) > KEPT_NODES:
        lattices.clear()
    words, place, sizes = distinct_words([lattices.model.normalised(text) for text in texts])
    number = lattices.numbers(words)[place]
    view = _View(lattices)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    owner = np.repeat(np.arange(len(texts)), sizes)
    slot = np.arange(len(number)) - ends[owner]
    nodes, lengths = view.first_node[number], view.length[number]
    seeds = np.array([xxhash.xxh3_64_intdigest(f"{seed}:{key}") for key in keys], dtype=_U)

    searches = []
    for i, first in enumerate(seeds.tolist()):
        root = -math.log(-math.log(_one(first, 1)))
        searches.append(_Search(first, int(ends[i]), int(ends[i + 1]), root))
    word_seeds = _mixed(seeds[owner] + slot.astype(_U) * _U(0xA24BAED4963EE407))

    def emit(which: list[int], begin: list[tuple[int, int]], kept: list[np.ndarray], n: int) -> None:
        """Complete segmentations: `kept` edges, then draws from word and character `begin` on.

        All texts are drawn and perturbed together; only frontiers are kept text by text.
        """
        low = np.array([searches[i].first + word for i, (word, _) in zip(which, begin)], dtype=np.int64)
        sizes = np.array([searches[i].last for i in which], dtype=np.int64) - low
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        inst = np.arange(int(bounds[-1])) + np.repeat(low - bounds[:-1], sizes)
        stop = lengths[inst]
        end = np.array([end for _, end in begin], dtype=np.int64)
        cut = np.flatnonzero((sizes > 0) & (end >= 0))
        stop[bounds[cut]] = end[cut]
        count, edges = _walk(view, nodes[inst], stop, _mixed(word_seeds[inst] + _U(n)))
        parts = np.concatenate(([0], np.cumsum(count)))[bounds].tolist()
        places, drawn = np.repeat(slot[inst], count), view.log[edges]
        masses, lasts, firsts = [], [], []
        for i, a, b, head in zip(which, parts[:-1], parts[1:], kept):
            path, place, logs = edges[a:b], places[a:b], drawn[a:b]
            known = len(head[0])
            if known:
                path, place = np.concatenate([head[0], path]), np.concatenate([head[1], place])
                logs = np.concatenate([view.log[head[0]], logs])
            before = np.zeros(len(logs) + 1)
            np.cumsum(logs, out=before[1:])
            near = max(known, int((-before[:-1]).searchsorted(REACH, side="right")))
            masses.append(before[known:near])
            lasts.append(logs[known:near])
            firsts.append(known)
            searches[i].emitted.append({"path": path, "place": place, "before": before})
        if not which:
            return
        fresh = np.array([len(x) for x in masses])
        spans = np.concatenate(([0], np.cumsum(fresh)))
        last, mass = np.concatenate(lasts), np.concatenate(masses)
        step = np.arange(len(last)) + np.repeat(np.array(firsts) - spans[:-1], fresh)
        with np.errstate(divide="ignore"):
            mass = mass + np.log(-np.expm1(last))
        round_seeds = _mixed(np.array([searches[i].seed for i in which], dtype=_U) + _U(n + 1))
        bound = np.repeat(np.array([searches[i].bound for i in which]), fresh)
        values = _truncated(mass, bound, _uniform(np.repeat(round_seeds, fresh), step))
        values = np.where(last >= 0, -np.inf, values)
        spans = spans.tolist()
        for i, a, b, known in zip(which, spans[:-1], spans[1:], firsts):
            search, own = searches[i], values[a:b]
            order, path = len(search.emitted) - 1, search.emitted[-1]["path"]
            want = min(samples, b - a)
            for j in (-own).argpartition(want - 1)[:want].tolist() if want else ():
                if own[j] > -np.inf:
                    heapq.heappush(search.heap, (-float(own[j]), order, known + j, (int(path[known + j]),)))

    everyone = list(range(len(texts)))
    nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    emit(everyone, [(0, -1)] * len(texts), [nothing] * len(texts), 0)
    for n in range(1, samples):
        which, begin, kept = [], [], []
        for i in everyone:
            search = searches[i]
            if not search.heap:
                continue
            value, order, step, taken = heapq.heappop(search.heap)
            search.bound = -value
            source = search.emitted[order]
            first = min(taken)
            node = int(np.searchsorted(view.edge_start, first, side="right")) - 1
            every = range(int(view.edge_start[node]), int(view.edge_start[node + 1]))
            left = [e for e in every if e not in taken and view.log[e] > -math.inf]
            if not left:
                continue
            chances = np.exp(view.log[left])
            draw = _one(search.seed, 2, n)
            pick_at = min(int(np.searchsorted(np.cumsum(chances), draw * chances.sum())), len(left) - 1)
            chosen = left[pick_at]
            rest = float(chances.sum() - chances[pick_at])
            if len(left) > 1 and rest > 0:
                mass = float(source["before"][step]) + math.log(rest)
                draw = np.array([_one(search.seed, 3, n)])
                value = float(_truncated(np.array([mass]), search.bound, draw)[0])
                heapq.heappush(search.heap, (-value, order, step, (*taken, chosen)))
            word = int(source["place"][step])
            path = np.append(source["path"][:step], chosen)
            which.append(i)
            begin.append((word, int(view.back[chosen])))
            kept.append((path, np.append(source["place"][:step], word)))
        emit(which, begin, kept, n)

    every = [one for search in searches for one in search.emitted]
    ends = np.cumsum([len(one["path"]) for one in every])
    chosen = view.piece[np.concatenate([one["path"] for one in every])] if every else np.zeros(0, np.int32)
    place = np.concatenate([one["place"] for one in every]) if every else np.zeros(0, np.int64)
    ids, ends = lattices.ids(_in_reading_order(chosen.astype(np.int64), place, ends), ends)
    spans = zip([0, *ends.tolist()[:-1]], ends.tolist())
    out = []
    for search in searches:
        bound = -search.heap[0][0] if search.heap else -math.inf
        found = []
        for one in search.emitted:
            log = float(one["before"][-1])
            x = log - bound
            inclusion = 0.0 if x > 4 else x if x < -30 else math.log(-math.expm1(-math.exp(x)))
            low, high = next(spans)
            found.append((ids[low:high], log, inclusion))
        out.append(found)
    del view
    return out


def _in_reading_order(chosen: np.ndarray, place: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Pieces of a word are drawn from its end, so each word's run is turned round; `ends` part texts."""
    if not len(chosen):
        return chosen
    begins = np.concatenate(([True], place[1:] != place[:-1]))
    begins[ends[ends < len(place)]] = True
    starts = np.flatnonzero(begins)
    stops = np.append(starts[1:], len(place))
    mirror = np.repeat(starts + stops - 1, stops - starts) - np.arange(len(place))
    return chosen[mirror]


Found = list[list[tuple[np.ndarray, float, float]]]


def _sampled(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    model: str,
    samples: int,
    seed: int,
    theta: float,
    columns: str,
    finish: Callable[[Pieces, Found], list[pa.Array]],
) -> DataFrame:
    """Sampled segmentations of every row; `finish` makes the `columns` of a batch of them."""
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "sample", *(part.split()[0] for part in columns.split(", ")), "log_prob", "log_inclusion"]

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(vocabulary(model), theta)
        lattices = Lattices(own)
        for batch in slices(batches, "c1", LATTICE_CHARS):
            keys = ["" if key is None else str(key) for key in batch.column("c0").to_pylist()]
            found = sample_texts(texts_of(batch.column("c1")), keys, lattices, samples, seed)
            which = pa.array([i for i, one in enumerate(found) for _ in one], pa.int64())
            order = pa.array([n + 1 for one in found for n in range(len(one))], pa.int32())
            arrays = [batch.column("c0").take(which), order, *finish(own, found)]
            arrays += [pa.array([row[i] for one in found for row in one], pa.float64()) for i in (1, 2)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"`{id_col}` {kind}, sample INT, {columns}, log_prob DOUBLE, log_inclusion DOUBLE"
    return pick(docs, id_col, text_col).mapInArrow(draw, schema)


def sampled_segmentations(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    model: str = "piece_bpe_32k.model",
    samples: int = SAMPLES,
    seed: int = SEED,
    theta: float = THETA,
) -> DataFrame:
    """Distinct segmentations of every whole text: `id_col`, sample, ids, log_prob, log_inclusion.

    `sample` counts from 1 in the order of the search; a text with fewer segmentations has fewer
    rows. log_inclusion is the logarithm of the chance that the segmentation is among the sampled,
    given the value that comes next; 0 if all are. Null and empty texts have one segmentation
    without pieces. Rows with equal ids draw alike if their texts are equal; null ids share a seed;
    other columns are ignored; an empty table gives no rows.
    """

    def lists(own: Pieces, found: Found) -> list[pa.Array]:
        ids = [row[0] for one in found for row in one]
        ends = np.cumsum([0] + [len(x) for x in ids])
        flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))]

    return _sampled(docs, id_col, text_col, model, samples, seed, theta, "ids ARRAY<INT>", lists)


def decoded(rows: DataFrame, ids_col: str = "ids", model: str = "piece_bpe_32k.model") -> DataFrame:
    """All columns, and the text of `ids_col` as `decoded`; null ids give a null text."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = pieces(vocabulary(model))
        for series in batches:
            yield series.map(lambda ids: None if ids is None else own.decode(ids.tolist()))

    return rows.withColumn("decoded", decode(F.col(f"`{ids_col}`")))


def op2_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the segmentations: the ids' CRC-32 and the length and CRC-32 of what they decode to."""

    def digests(own: Pieces, found: Found) -> list[pa.Array]:
        drawn = [ids for one in found for ids, _, _ in one]
        rows = [
            (crc32(ids.astype("<u4").tobytes()), len(ids), len(data), crc32(data))
            for ids, data in zip(drawn, own.decode_each(drawn))
        ]
        return [pa.array([row[i] for row in rows], pa.int64()) for i in range(4)]

    columns = "ids_crc32 BIGINT, n_pieces BIGINT, text_bytes BIGINT, text_crc32 BIGINT"
    docs = table(spark, sf_dir, "documents")
    return _sampled(docs, "doc_id", "text", "piece_bpe_32k.model", SAMPLES, SEED, THETA, columns, digests)
