"""Token ids and counts of whole texts under public vocabulary files.

A byte-level BPE splits a text into words before it merges bytes, and a space that stands before a
character other than white space always begins a new word. Cutting there changes no id, so long
texts are cut at such places. Texts of plain Latin letters are merged by the ranks of the same file
in a faster library, all others by the file's own library; both give the same ids, which the tests
hold against encoding whole texts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np

#: Texts are cut at the first safe place after so many characters.
CUT_CHARS = 1 << 20

#: Letters, spaces and punctuation whose classes are the same in every version of Unicode.
_OTHER = re.compile(r"[^\x00-\u024f\u2010-\u2027\u20ac]")
_SAFE = re.compile(r" (?=\S)")


def cut(text: str, limit: int = CUT_CHARS) -> Iterator[str]:
    """Pieces of a text, cut at safe places: each begins with a space before a visible character."""
    start = 0
    while len(text) - start > limit:
        found = _SAFE.search(text, start + limit)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one character: visible ones as they are."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteEncoder:
    """Ids of texts under a byte-level vocabulary of `tokenizers`, special strings as its default."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        before = parts.get("pre_tokenizer") or {}
        self.plain = (
            parts.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
        )
        special = [re.escape(token["content"]) for token in parts.get("added_tokens") or []]
        self.special = re.compile("|".join(special) or r"(?!)")
        self.ranked = self._ranked(parts) if self.plain else None

    @staticmethod
    def _ranked(parts: dict):
        """The same merges by rank, if the file's ids stand in the order of its merges."""
        import tiktoken
        from public_tokenizers import PATTERN

        model, byte = parts["model"], byte_alphabet()
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        if ids != sorted(ids) or model.get("dropout") or model.get("ignore_merges"):
            return None
        special = {token["id"] for token in parts.get("added_tokens") or []}
        ranks = {
            bytes(byte[c] for c in token): rank
            for token, rank in model["vocab"].items()
            if rank not in special
        }
        return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> list[int]:
        if not self.plain or self.special.search(text):
            return self.own.encode(text, add_special_tokens=False).ids
        ids: list[int] = []
        for piece in cut(text):
            if self.ranked is None or _OTHER.search(piece):
                ids += self.own.encode(piece, add_special_tokens=False).ids
            else:
                ids += self.ranked.encode_ordinary(piece)
        return ids

    def count(self, texts: list[str]) -> np.ndarray:
        """Number of ids of each text."""
        return np.array([len(self._ids(text)) for text in texts], dtype=np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as unsigned 32-bit numbers."""
        return [np.array(self._ids(text), dtype=np.uint32) for text in texts]


class PieceEncoder:
    """Ids of texts under a SentencePiece model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.uint32) for ids in self.model.encode(texts, num_threads=1)]

    def count(self, texts: list[str]) -> np.ndarray:
        ids = self.model.encode(texts, num_threads=1)
        return np.array([len(x) for x in ids], dtype=np.int64)


@cache
def encoder(path: str) -> ByteEncoder | PieceEncoder:
    """One encoder per Python worker and file: `.json` for tokenizers, `.model` for SentencePiece."""
    return PieceEncoder(path) if path.endswith(".model") else ByteEncoder(path)


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    from public_tokenizers import path

    return path(name)
