"""BPE encoding and decoding with word ends, by batched numpy merge rounds (11).

The distinct words of a batch of texts lie as symbols in one flat array. In a round every word that
still has a known pair merges its pair of lowest rank, all words at once: a pair is one integer key,
and its rank is found by binary search over the sorted keys of the vocabulary file. A merge makes
only pairs of higher rank than its own, so all places of a word's lowest pair merge in one round.
Long words would take a round for nearly every merge, so they go by rank instead: the lowest rank of
all long words merges next, and only the places that have it are touched.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import pick, slices, table, texts_of
from headway.llm.tokens import byte_alphabet, vocabulary

#: Words of more symbols than this are merged by rank instead of in rounds.
LONG_SYMBOLS = 256
#: Characters and ids of chunks that a worker keeps for later batches, and the longest one kept.
KEPT_CHARS = 1 << 23
KEPT_CHUNK = 64

_NONE = np.iinfo(np.int64).max
#: Python's `split` takes these for white space, vocabulary files don't.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Fixed value: the pattern of words whose matches never hold white space.
_SPACELESS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Chunks of characters whose classes and lower-case forms are the same in every Unicode version.
_PLAIN = re.compile(r"[\x21-\x7e\u00a1-\u00ac\u00ae-\u012f\u0131-\u0217]+")


@cache
def _words():
    import regex

    return regex.compile(_SPACELESS)


_VISIBLE = {byte: char for char, byte in byte_alphabet().items()}


def _visible(word: str) -> str:
    """A word's bytes in the alphabet of byte-level vocabularies."""
    return word if word.isascii() else word.encode().decode("latin-1").translate(_VISIBLE)


def ragged(offsets: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and joined values of the chosen rows of a ragged array."""
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    places = np.arange(total) - np.repeat(ends - sizes, sizes) + np.repeat(offsets[rows], sizes)
    return sizes, flat[places]


def _alternate(hits: np.ndarray) -> np.ndarray:
    """Of sorted places, every second one in each run of neighbours, the first included."""
    starts = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
    first = np.repeat(hits[starts], np.diff(np.append(starts, len(hits))))
    return hits[(hits - first) % 2 == 0]


class Merges:
    """The merges of a vocabulary as sorted pair keys with their ranks and results."""

    def __init__(self, pairs: np.ndarray, results: np.ndarray, n_ids: int) -> None:
        self.n_ids = n_ids
        keys = pairs[:, 0].astype(np.int64) * n_ids + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.by_key, self.results = keys[order], order, results
        made = np.full(n_ids, -1, dtype=np.int64)
        np.maximum.at(made, results, np.arange(len(results)))
        if (made[pairs].max(axis=1) >= np.arange(len(pairs))).any():
            raise ValueError("a merge ranks before the merge that makes one of its parts")

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; `_NONE` for pairs that don't merge."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        keys = left.astype(np.int64) * self.n_ids + right
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.by_key[place], _NONE)

    def _pair_ranks(self, symbols: np.ndarray, word: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that begin at the places; `_NONE` where the word ends there."""
        ranks = np.full(len(places), _NONE)
        inside = np.flatnonzero(places < len(symbols) - 1)
        inside = inside[word[places[inside]] == word[places[inside] + 1]]
        at = places[inside]
        ranks[inside] = self.ranks(symbols[at], symbols[at + 1])
        return ranks

    def by_rounds(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many words: (ids per word, ids of all words in order)."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        ranks = self._pair_ranks(symbols, word, np.arange(len(symbols)))
        while len(symbols):
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            lengths = np.diff(np.append(starts, len(symbols)))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            ended = lowest == _NONE
            if ended.any():
                done.append((word[ended], symbols[ended]))
            left = _alternate(np.flatnonzero((ranks == lowest) & ~ended))
            symbols[left] = self.results[ranks[left]]
            stays = ~ended
            stays[left + 1] = False
            symbols, word, ranks = symbols[stays], word[stays], ranks[stays]
            left = (np.cumsum(stays) - 1)[left]
            changed = np.zeros(len(symbols), dtype=bool)  # pairs that a merge has a part in
            changed[left] = True
            changed[left[left > 0] - 1] = True
            touched = np.flatnonzero(changed)
            ranks[touched] = self._pair_ranks(symbols, word, touched)
        owners = np.concatenate([w for w, _ in done]) if done else np.zeros(0, dtype=np.int64)
        ids = np.concatenate([s for _, s in done]) if done else np.zeros(0, dtype=np.int32)
        order = np.argsort(owners, kind="stable")
        return np.bincount(owners, minlength=len(sizes)), ids[order]

    def by_rank(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of one long word: work follows the merges made, not rounds times length."""
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def add(places: np.ndarray) -> None:
            places = places[after[places] < n]
            ranks = self.ranks(symbols[places], symbols[after[places]])
            places, ranks = places[ranks < _NONE], ranks[ranks < _NONE]
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            for part in np.split(places, np.flatnonzero(np.diff(ranks)) + 1) if len(places) else ():
                rank = int(self.ranks(symbols[part[:1]], symbols[after[part[:1]]])[0])
                if rank not in waiting:
                    waiting[rank] = []
                    heapq.heappush(queue, rank)
                waiting[rank].append(part)

        alive = np.ones(n, dtype=bool)
        add(np.arange(n - 1))
        while queue:
            rank = heapq.heappop(queue)
            places = np.unique(np.concatenate(waiting.pop(rank)))
            places = places[alive[places] & (after[places] < n)]
            places = places[self.ranks(symbols[places], symbols[after[places]]) == rank]
            if not len(places):
                continue
            # Runs of equal symbols overlap: of linked places take the first, third and so on.
            linked = np.concatenate([[False], after[places[:-1]] == places[1:]])
            starts = np.flatnonzero(~linked)
            index = np.arange(len(places)) - np.repeat(starts, np.diff(np.append(starts, len(places))))
            left = places[index % 2 == 0]
            right = after[left]
            symbols[left] = self.results[rank]
            alive[right] = False
            after[left] = after[right]
            inner = after[left] < n
            before[after[left[inner]]] = left[inner]
            previous = before[left]
            add(np.unique(np.concatenate([left, previous[previous >= 0]])))
        return symbols[alive]


class WordBpe:
    """Encodes and decodes whole texts as the `tokenizers` library does with a BPE file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        model = parts["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError(f"{path} holds no plain BPE")
        if model.get("ignore_merges") or model.get("continuing_subword_prefix") or parts.get("post_processor"):
            raise ValueError(f"{path} needs features that merge rounds don't have")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([(vocab[a], vocab[b]) for a, b in merges], dtype=np.int64).reshape(-1, 2)
        results = np.array([vocab[a + b] for a, b in merges], dtype=np.int32)
        n_ids = 1 + max(chain(vocab.values(), (t["id"] for t in parts.get("added_tokens") or [])))
        self.merges = Merges(pairs, results, n_ids)
        last = max((ord(c) for c in vocab if len(c) == 1), default=0)
        self.inner, self.final = (np.full(last + 1, -1, dtype=np.int32) for _ in range(2))
        for code in range(last + 1):
            self.inner[code] = vocab.get(chr(code), -1)
            self.final[code] = vocab.get(chr(code) + suffix, -1)
        strings = [""] * n_ids
        for token, number in vocab.items():
            strings[number] = token
        for token in parts.get("added_tokens") or []:
            strings[token["id"]] = token["content"]
        self.strings = pa.array(strings, pa.string())
        self.joined = parts.get("decoder") is None
        self.special = self._special(parts)
        self.by_chunk = self._spaceless(parts)
        self._reset()

    @staticmethod
    def _special(parts: dict):
        """The strings that are ids of their own wherever they stand in a text: pattern and ids."""
        tokens = parts.get("added_tokens") or []
        for token in tokens:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError("added tokens that take white space or are normalised aren't supported")
        ids = {token["content"]: token["id"] for token in tokens}
        longest = sorted(ids, key=len, reverse=True)
        return re.compile("|".join(map(re.escape, longest))) if ids else None, ids

    @staticmethod
    def _spaceless(parts: dict) -> bool:
        """Whether the file lowers letters, drops white space and parts words at `_SPACELESS`."""
        normal = (parts.get("normalizer") or {}).get("normalizers") or []
        kinds = [step["type"] for step in normal]
        before = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or []
        split = before[0] if before else {}
        return bool(
            kinds == ["NFC", "Replace", "Lowercase"]
            and normal[1]["pattern"] == {"Regex": r"\s+"}
            and normal[1]["content"] == " "
            and [step["type"] for step in before] == ["Split", "ByteLevel"]
            and split["pattern"] == {"Regex": _SPACELESS}
            and split["behavior"] == "Removed"
            and split["invert"]
            and not before[1]["add_prefix_space"]
            and not before[1]["use_regex"]
        )

    def _reset(self) -> None:
        self.chunks: dict[str, int] = {}
        self.offsets, self.ids, self.kept = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32), 0

    def words_of(self, chunk: str) -> list[str]:
        """Words of a piece of text in the alphabet of the vocabulary."""
        if self.by_chunk and _PLAIN.fullmatch(chunk):
            words = _words().findall(chunk.lower())
            return words if chunk.isascii() else [_visible(word) for word in words]
        text = self.library.normalizer.normalize_str(chunk) if self.library.normalizer else chunk
        if self.library.pre_tokenizer is None:
            return [text] if text else []
        return [word for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words: (offsets, ids of all words in order)."""
        if not words:
            return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes)
        if codes.max() >= len(self.inner):
            raise ValueError("a word holds a character outside the alphabet of the vocabulary")
        symbols = self.inner[codes]
        symbols[ends - 1] = self.final[codes[ends - 1]]
        if symbols.min() < 0:
            raise ValueError("a word holds a character outside the alphabet of the vocabulary")
        long = np.flatnonzero(sizes > LONG_SYMBOLS)
        short = np.ones(len(words), dtype=bool)
        short[long] = False
        counts = np.zeros(len(words), dtype=np.int64)
        counts[short], flat = self.merges.by_rounds(symbols[np.repeat(short, sizes)], sizes[short])
        if not len(long):
            return np.concatenate([[0], np.cumsum(counts)]), flat
        pieces = np.split(flat, np.cumsum(counts)[:-1])
        for i in long:
            pieces[i] = self.merges.by_rank(symbols[ends[i] - sizes[i] : ends[i]].copy())
            counts[i] = len(pieces[i])
        return np.concatenate([[0], np.cumsum(counts)]), np.concatenate(pieces)

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new chunks: (ids per chunk, ids of all chunks in order)."""
        words: dict[str, int] = {}
        parts = [[words.setdefault(w, len(words)) for w in self.words_of(c) if w] for c in chunks]
        offsets, ids = self.merged(list(words))
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        rows = np.fromiter(chain.from_iterable(parts), dtype=np.int64, count=int(sizes.sum()))
        lengths, flat = ragged(offsets, ids, rows)
        owner = np.repeat(np.arange(len(parts)), sizes)
        return np.bincount(owner, weights=lengths, minlength=len(parts)).astype(np.int64), flat

    def _pieces(self, text: str) -> list[str]:
        """Special strings, and chunks that are encoded apart from one another."""
        pattern, ids = self.special
        found = list(pattern.finditer(text)) if pattern else []
        if not found:
            return self._chunks(text)
        out, start = [], 0
        for hit in found:
            out += [*self._chunks(text[start : hit.start()]), hit.group()]
            start = hit.end()
        return out + self._chunks(text[start:])

    def _chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.by_chunk or any(c in text for c in _SEPARATORS):
            return [text]
        return text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts: (ids per text, ids of all texts in order)."""
        if self.kept > KEPT_CHARS:
            self._reset()
        pieces = [self._pieces(text) for text in texts]
        special = self.special[1]
        new = [p for p in dict.fromkeys(chain.from_iterable(pieces)) if p not in self.chunks]
        known = len(self.chunks)
        self.chunks.update(zip(new, range(known, known + len(new))))
        plain = [p for p in new if p not in special]
        sizes = np.ones(len(new), dtype=np.int64)
        own = np.array([p in special for p in new], dtype=bool)
        sizes[~own], learned = self._learn(plain)
        flat = np.empty(int(sizes.sum()), dtype=np.int32)
        at = np.repeat(own, sizes)
        flat[at], flat[~at] = [special[p] for p in new if p in special], learned
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, flat])
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = chain.from_iterable(pieces)
        rows = np.fromiter(map(self.chunks.__getitem__, order), dtype=np.int64, count=int(counts.sum()))
        lengths, ids = ragged(self.offsets, self.ids, rows)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        self.kept += sum(map(len, new)) + len(flat)
        if any(len(p) > KEPT_CHUNK for p in new):
            self._forget(known, new)
        return np.diff(ends), ids

    def _forget(self, known: int, new: list[str]) -> None:
        """Drop the batch's long chunks, which hardly come again, and what they take."""
        stay = [i for i, p in enumerate(new) if len(p) <= KEPT_CHUNK]
        rows = np.concatenate([np.arange(known), known + np.array(stay, dtype=np.int64)])
        sizes, self.ids = ragged(self.offsets, self.ids, rows)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        for p in new:
            del self.chunks[p]
        self.chunks.update((new[i], known + n) for n, i in enumerate(stay))
        self.kept = sum(map(len, self.chunks)) + len(self.ids)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """Text of each row of ids: tokens joined by spaces, or by the file's own decoder."""
        if not self.joined:
            rows = ids.to_pylist()
            return pa.array([self.library.decode(r, skip_special_tokens=False) for r in rows], pa.string())
        offsets = pc.subtract(ids.offsets, ids.offsets[0])
        return pc.binary_join(pa.ListArray.from_arrays(offsets, self.strings.take(ids.flatten())), " ")


@cache
def word_bpe(path: str) -> WordBpe:
    """One encoder per Python worker and file."""
    return WordBpe(path)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json"
) -> DataFrame:
    """Token ids of each row's whole text: `id_col`, ids array<int>.

    A null or empty text has no ids. Rows with equal or null ids stay separate rows, other columns
    are ignored, no rows give no rows. Texts are handled in batches of about equal size.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(vocabulary(tokenizer))
        for batch in slices(batches, "c1"):
            sizes, ids = model.encode(texts_of(batch.column("c1")))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            rows = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("c0"), rows], names=[id_col, "ids"])

    return pick(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids ARRAY<INT>")


def decode(
    rows: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", tokenizer: str = "word_bpe_49k.json"
) -> DataFrame:
    """Text of each row's ids: `id_col`, `ids_col`, decoded. Null ids count as none: empty text."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = word_bpe(vocabulary(tokenizer))
        for batch in batches:
            ids = pc.fill_null(batch.column("c1"), pa.scalar([], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                [batch.column("c0"), ids, model.decode(ids)], names=[id_col, ids_col, "decoded"]
            )

    schema = f"`{id_col}` {kind}, `{ids_col}` ARRAY<INT>, decoded STRING"
    picked = rows.select(F.col(f"`{id_col}`").alias("c0"), F.col(f"`{ids_col}`").cast("array<int>").alias("c1"))
    return picked.mapInArrow(run, schema)


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole text and of the texts they decode to."""
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
