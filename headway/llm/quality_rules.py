"""Quality rules with distribution divergence (8).

Each language of the corpus gets a reference made from all of its documents: the shares of character
classes, and the shares of its most frequent short words. A document fails the base rules when it is
too short or repeats itself, and fails the method when its own shares lie further than a threshold
from the references, by Jensen-Shannon distance (base 2, so between 0 and 1): its classes from all of
them, its words from its own language's, or from all where that is unknown. Guards keep the distances from judging texts too short to have shares,
and by references whose common words are too few to tell a text without any.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from headway.llm.common import BATCH_CHARS, by_chars, pick, release, slices, table, texts_of
from headway.plans.staging import stage

MIN_WORDS = 50
REPEAT_PERCENT = 50

# Classes of UTF-8 bytes: small and capital letters, digits, symbols, other signs, starts of longer
# characters; then white space, and bytes that count for nothing.
_LOWER, _UPPER, _DIGIT, _SYMBOL, _SIGN, _WIDE, _SPACE, _NONE = range(8)
CLASSES = 6
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


def _byte_class(byte: int) -> int:
    if byte in SPACES:
        return _SPACE
    if byte in SYMBOLS:
        return _SYMBOL
    if 97 <= byte <= 122:
        return _LOWER
    if 65 <= byte <= 90:
        return _UPPER
    if 48 <= byte <= 57:
        return _DIGIT
    if byte >= 0xC0:
        return _WIDE
    return _SIGN if 33 <= byte <= 126 else _NONE


_TABLE = bytes(map(_byte_class, range(256)))
_EDGES = re.compile(r"^\W+|\W+$")

#: Common words have at most this many characters, which keeps their counts small.
SHORT_WORD = 5
COMMON_WORDS = 50
#: A language needs this share of all words for a reference of its own, so there are 1,000 at most.
LANGUAGE_SHARE = 0.001
_FLUSH = 200_000


@dataclass(frozen=True)
class Limits:
    """Distances beyond which a document is rejected, and the sizes below which none is taken."""

    class_distance: float = 0.3
    word_distance: float = 0.42
    class_chars: int = 200
    word_words: int = 100


@dataclass
class References:
    """One row per language: class shares, and shares of its own common words and of all others.

    The language None stands for null and for all languages too rare for a row of their own.
    """

    langs: list[str | None]
    classes: np.ndarray
    words: list[dict[str, float]]
    others: np.ndarray


def bare(word: str) -> str:
    """A word in small letters without signs at its ends."""
    return _EDGES.sub("", word.lower())


def _corpus_counts(lang_col: bool):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush() -> pa.RecordBatch:
            langs, kinds, keys = zip(*counts) if counts else ((), (), ())
            columns = [pa.array(langs, pa.string()), pa.array(kinds, pa.string())]
            columns += [pa.array(keys, pa.string()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "key", "n"])

        for batch in slices(batches, "c0"):
            texts = texts_of(batch.column("c0"))
            langs = batch.column("c1").to_pylist() if lang_col else [None] * len(texts)
            for lang in set(langs):
                own = [text for text, its in zip(texts, langs) if its == lang]
                raw: Counter = Counter()
                for text in own:
                    classes = text.encode().translate(_TABLE)
                    for c in range(CLASSES):
                        counts[lang, "class", str(c)] += classes.count(c)
                    words = text.split()
                    raw.update(words)
                    counts[lang, "words", ""] += len(words)
                for word, n in raw.items():
                    if len(word) <= SHORT_WORD + 4 and 0 < len(plain := bare(word)) <= SHORT_WORD:
                        counts[lang, "word", plain] += n
            if len(counts) > _FLUSH:
                yield flush()
                counts.clear()
        yield flush()

    return count


def language_references(
    docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang"
) -> References:
    """References from every document. Languages below `LANGUAGE_SHARE`, and null, share one."""
    columns = [text_col] + ([lang_col] if lang_col else [])
    rows = pick(docs, *columns)
    if lang_col:
        rows = rows.withColumn("c1", F.col("c1").cast("string"))
    schema = "lang STRING, kind STRING, key STRING, n BIGINT"
    counts = rows.mapInArrow(_corpus_counts(lang_col is not None), schema)
    counts = stage(counts.groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")), "rule_counts")
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "key"))
    top = counts.withColumn("rank", rank).where(f"rank <= {COMMON_WORDS}").drop("rank")
    total = Window.partitionBy()
    sums = top.where("kind = 'words'").withColumn("share", F.col("n") / F.sum("n").over(total))
    known = sums.where(f"lang IS NOT NULL AND share >= {LANGUAGE_SHARE}").select("lang").collect()
    known = {row["lang"] for row in known}
    merged: dict[str | None, Counter] = {}
    small = top.where(F.col("lang").isNull() | ~F.col("lang").isin(list(known)) if known else F.lit(True))
    small = small.groupBy("kind", "key").agg(F.sum("n").alias("n"))
    small = small.withColumn(
        "rank", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "key"))
    ).where(f"rank <= {COMMON_WORDS}")
    for row in top.where(F.col("lang").isin(list(known))).collect() if known else []:
        merged.setdefault(row["lang"], Counter())[row["kind"], row["key"]] += row["n"]
    for row in small.collect():
        merged.setdefault(None, Counter())[row["kind"], row["key"]] += row["n"]
    langs, classes, words, others = [], [], [], []
    for lang in sorted(merged, key=lambda x: (x is None, x)):
        found = merged[lang]
        shares = np.array([found["class", str(c)] for c in range(CLASSES)], dtype=np.float64)
        n = found["words", ""]
        if not n or not shares.sum():
            continue
        common = {key: k / n for (kind, key), k in found.items() if kind == "word"}
        langs.append(lang)
        classes.append(shares / shares.sum())
        words.append(common)
        others.append(max(0.0, 1 - sum(common.values())))
    return References(langs, np.array(classes).reshape(-1, CLASSES), words, np.array(others))


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of `p` from `q`: 0 if equal, 1 if nothing is shared."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / middle), 0).sum(axis=-1)
        b = np.where(q > 0, q * np.log2(q / middle), 0).sum(axis=-1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


class _Words:
    """Numbers for words, and each word's place among the common words of all references."""

    KEPT = 1 << 18

    def __init__(self, references: References) -> None:
        names = sorted({w for words in references.words for w in words})
        self.columns = {name: i + 1 for i, name in enumerate(names)}
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.column = array("I")

    def look_up(self, words: list[bytes]) -> np.ndarray:
        if len(self.numbers) > self.KEPT:
            self.clear()
        found = list(map(self.numbers.get, words))
        if None in found:
            for i, number in enumerate(found):
                if number is None:
                    number = self.numbers.get(words[i])
                    if number is None:
                        number = self.numbers[words[i]] = len(self.column)
                        short = len(words[i]) <= 4 * (SHORT_WORD + 4)
                        plain = bare(words[i].decode()) if short else ""
                        self.column.append(self.columns.get(plain, 0))
                    found[i] = number
        return np.array(found, dtype=np.int64)


def repeated_words(numbers: np.ndarray, distinct: int) -> int:
    """Words covered by a window of three words that occurs at least twice, the first included."""
    if len(numbers) < 4:
        return 0
    first, second, third = numbers[:-2], numbers[1:-1], numbers[2:]
    if distinct < 1 << 21:
        windows = (first << 42) | (second << 21) | third
    else:
        pairs = np.unique(first * distinct + second, return_inverse=True)[1]
        windows = pairs * distinct + third
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(windows), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(numbers), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(windows)] |= twice
    return int(covered.sum())


def _distances(
    langs: list[str | None], shares: np.ndarray, hits: np.ndarray, store: _Words, references: References, limit: float
) -> tuple[np.ndarray, np.ndarray]:
    """Class and word distances of documents of some languages; 0 where there is nothing to judge by.

    The class distance is the least from any reference, the word distance that from the own one. A
    reference decides about words if a text without its common words lies beyond the limit. Null
    is compared with all references that decide, and so are rare languages if the mixed one does.
    """
    place = {lang: i for i, lang in enumerate(references.langs) if lang is not None}
    owner = np.array([-1 if lang is None else place.get(lang, -2) for lang in langs], dtype=np.int64)
    class_distance, word_distance = (np.full(len(langs), np.inf) for _ in range(2))
    mixed_decides = True
    for i in reversed(range(len(references.langs))):  # the mixed reference first
        rows = np.flatnonzero((owner == i) | (owner < 0))
        class_distance = np.minimum(class_distance, divergence(shares, references.classes[i]))
        names = sorted(references.words[i])
        expected = np.array([references.words[i][name] for name in names] + [references.others[i]])
        decides = divergence(np.eye(len(expected))[-1], expected) > limit
        if references.langs[i] is None:
            mixed_decides = decides
        if not decides:
            continue
        if not mixed_decides:
            rows = rows[owner[rows] != -2]
        own = hits[np.ix_(rows, [store.columns[name] for name in names])]
        own = np.column_stack([own, np.clip(1 - own.sum(axis=1), 0, 1)])
        word_distance[rows] = np.minimum(word_distance[rows], divergence(own, expected))
    return tuple(np.where(np.isinf(found), 0, found) for found in (class_distance, word_distance))


def _measured(
    texts: list[str], langs: list[str | None], store: _Words, references: References, limits: Limits
) -> pd.DataFrame:
    split = [text.encode() for text in texts]
    words = [text.split() for text in split]
    flat = store.look_up([word for own in words for word in own])
    column = np.frombuffer(store.column, dtype=np.uint32) if len(store.column) else np.zeros(0, np.uint32)
    ends = np.cumsum([0] + [len(own) for own in words])
    width = len(store.columns) + 1
    rows, classes, common = [], [], []
    for text, data, start, end in zip(texts, split, ends[:-1], ends[1:]):
        kinds = data.translate(_TABLE)
        by_class = [kinds.count(c) for c in range(_SPACE + 1)]
        lines = [line for line in data.split(b"\n") if line.strip()]
        own = flat[start:end]
        repeats = repeated_words(own, len(store.numbers))
        rows.append((end - start, len(text) - by_class[_SPACE], by_class[_SYMBOL], len(lines) - len(set(lines)), repeats))
        classes.append(by_class[:CLASSES])
        common.append(np.bincount(column[own], minlength=width))
    del column
    frame = pd.DataFrame(rows, columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
    frame = frame.astype(np.int64)
    counts = np.array(classes, dtype=np.float64).reshape(-1, CLASSES)
    shares = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    hits = np.array(common, dtype=np.float64).reshape(-1, width) / np.maximum(frame["n_words"].to_numpy(), 1)[:, None]
    class_distance, word_distance = _distances(langs, shares, hits, store, references, limits.word_distance)
    frame["chars"] = counts.sum(axis=1).astype(np.int64)
    frame["class_distance"], frame["word_distance"] = class_distance, word_distance
    return frame


_MEASURES = (
    "n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, n_repeat_words BIGINT,"
    " base_failed BOOLEAN, class_distance DOUBLE, word_distance DOUBLE, kept BOOLEAN"
)


def measures(references: References, limits: Limits = Limits()):
    """A function of a text and a language column to counts, distances and verdict, as one struct."""

    @F.pandas_udf(_MEASURES)
    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        release()
        store = _Words(references)
        for series, lang in batches:
            texts = ["" if text is None else text for text in series]
            langs = [None if pd.isna(own) else own for own in lang]
            parts, start = [], 0
            for own in by_chars(texts, BATCH_CHARS):
                parts.append(_measured(own, langs[start : start + len(own)], store, references, limits))
                start += len(own)
            frame = pd.concat(parts, ignore_index=True)
            frame["base_failed"] = (frame["n_words"] < MIN_WORDS) | (
                100 * frame["n_repeat_words"] > REPEAT_PERCENT * frame["n_words"]
            )
            odd = (frame["chars"] >= limits.class_chars) & (frame["class_distance"] > limits.class_distance)
            odd |= (frame["n_words"] >= limits.word_words) & (frame["word_distance"] > limits.word_distance)
            frame["kept"] = ~frame["base_failed"] & ~odd
            yield frame[[part.split()[0] for part in _MEASURES.split(", ")]]

    return measure


def _lang(lang_col: str | None) -> Column:
    return (F.col(f"`{lang_col}`") if lang_col else F.lit(None)).cast("string")


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str | None = "lang",
    limits: Limits = Limits(),
) -> DataFrame:
    """Counts, distances and verdict of every row: `id_col` and the fields of `measures`.

    Null and empty texts have no words and fail the base rules. Rows with equal or null ids stay
    separate; a null language is judged by all references; other columns are ignored; an empty
    table gives no rows.
    """
    found = measures(language_references(docs, text_col, lang_col), limits)
    lang = _lang(lang_col).alias("lang")
    return docs.select(F.col(f"`{id_col}`").alias("c0"), F.col(f"`{text_col}`").alias("c1"), lang).select(
        F.col("c0").alias(id_col), found("c1", "lang").alias("found")
    ).select(f"`{id_col}`", "found.*")


def kept_by_rules(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """The rows that pass, with all their columns."""
    found = measures(language_references(docs, text_col, lang_col))
    return docs.where(found(F.col(f"`{text_col}`"), _lang(lang_col))["kept"])


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
