"""Secret scans by patterns and compression novelty (6).

Three patterns find secrets of known form. The method adds strings of no known form: a candidate in
a sensitive context is reported if it stays incompressible for zstandard primed with the text around
it and with common identifiers, so that names, paths and repeated values cost few bytes and random
ones cost almost all of theirs.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import pick, release, slices, table, texts_of

KINDS = ("assign", "access", "hex", "novel")

_ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of 24 or more is found whole
_ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")

#: Words that make what follows them on the line sensitive, and how far they reach.
CONTEXT_WORDS = (
    "key", "secret", "token", "passw", "pwd", "auth", "bearer", "credential", "private", "signature", "session",
)
CONTEXT_CHARS = 40
_CONTEXT = re.compile(f"(?ai)(?:{'|'.join(CONTEXT_WORDS)})")
#: '=' parts a name from its value; at the end of a candidate one or two are padding.
_CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_NAME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-")

#: The body of a private key: up to its end mark, or where that is missing, lines of one word.
_BLOCK = re.compile(
    r"(?s)-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----"
    r"((?:(?!-----).)*(?=-----END)|(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/=]+(?=[ \t]*\r?(?:\n|\Z)))*)"
)
_BLOCK_PART = re.compile(r"[A-Za-z0-9+/]+={0,2}")

#: The priming text: words of which identifiers are commonly made.
IDENTIFIERS = (
    "access account action address admin api app application args array attribute auth authorization "
    "backend base bearer body bool buffer build byte cache callback channel char class client cloud "
    "code column command config connection const content context controller cookie count create "
    "credential data database date debug default delete description destination device dict document "
    "domain download element email enable encoding endpoint engine entry environment error event "
    "export false field file filter format function get group handler hash header host http https id "
    "import index info init input instance int interface item json key label language length level "
    "library list load local location log login manager map message method model module name network "
    "node null number object option order output package page param parent parse password path "
    "pattern payload permission port position prefix private process profile project property "
    "protocol provider public query queue range read record request resource response result return "
    "role root route row schema scope script secret select self send server service session set "
    "signature size source start state static status storage string style system table target task "
    "template test text thread time title token total true type update upload url user username util "
    "value variable version view void web window worker write"
)
_PRIMING = (IDENTIFIERS + " " + IDENTIFIERS.title().replace(" ", "") + "_" + IDENTIFIERS.replace(" ", "_")).encode()
#: Words of no identifier, that strings are measured beside: alone, the letters of any string would be
#: stored as they are, at a byte each.
PROSE = (
    "We hold that most of what people write in plain words, of whatever tongue, uses few letters often and "
    "many seldom: Jeder Mensch braucht Zeit, um Neues zu verstehen; il faut du temps pour bien faire les "
    "choses, y quien busca encuentra. Big Foxes Quickly Jump Over Lazy Dogs And Vex Mighty Wizards Near "
    "Kyoto Park. /opt/data/work/files/old-ones, x.y_z "
)
#: Text on either side that primes the compressor.
AROUND_CHARS = 400
#: A candidate is reported if its marginal bytes reach this share of its characters. Of random strings
#: of 16 to 40 letters and digits 97 % reach it, of names made of words 2 %, or with a number 10 %.
NOVELTY = 0.79

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Secrets of known form, by start, then kind."""
    spans = [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    if "AKIA" in text:
        spans += [
            (m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20
        ]
    small = text.lower()
    if any(hint in small for hint in _ASSIGN_HINTS):
        spans += [
            (m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6
        ]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


@cache
def _compressor() -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(_PRIMING, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=19, dict_data=known, write_content_size=False, write_dict_id=False)


def _last_block(before: str, data: str) -> int:
    """Compressed bytes of the data as a block of its own, after a block of the text before it."""
    stream = _compressor().compressobj()
    stream.compress(before.encode())
    stream.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK)
    return len(stream.compress(data.encode())) + len(stream.flush())


def masked(text: str, known: list[Span]) -> str:
    """The text with all that may be a secret blanked out, so that no secret explains another."""
    spans = [(start, end) for start, end, _ in known]
    spans += [m.span() for m in _CANDIDATE.finditer(text)] + [m.span(1) for m in _BLOCK.finditer(text)]
    parts, done = [], 0
    for start, end in sorted(spans):
        if end > done:
            start = max(start, done)
            parts += [text[done:start], " " * (end - start)]
            done = end
    return "".join(parts) + text[done:]


def marginal_bytes(value: str, before: str, after: str) -> int:
    """Bytes that a string adds beside prose, with identifiers and the text around it as dictionary.

    What the string repeats of either costs a reference. The text around stands in a block before,
    so that the code tables come from the prose, which is the same for every string, and not from
    however much or little stands around it.
    """
    value = value if re.search("[a-z]", value) else value.lower()  # CONSTANT_NAMES are words too
    around = after[:AROUND_CHARS] + before[-AROUND_CHARS:]
    return _last_block(around, PROSE + value) - _last_block(around, PROSE)


def _reach(text: str, start: int) -> int:
    """Where the context of a string begins: some characters before it, but with all of its `name=`."""
    left = start - 1
    if left > 0 and text[left] in "\"'":
        left -= 1
    if left >= 0 and text[left] == "=":
        while left > 0 and text[left - 1] in _NAME:
            left -= 1
    return max(0, min(left, start - CONTEXT_CHARS))


def _sensitive(text: str, start: int) -> bool:
    """Whether a context word stands before a string on its line, or above it where its line just began."""
    reach = _reach(text, start)
    line = text.rfind("\n", reach, start) + 1
    if _CONTEXT.search(text, max(line, reach), start):
        return True
    if not line:
        return False
    end = len(text[max(0, line - AROUND_CHARS) : line].rstrip()) + max(0, line - AROUND_CHARS)
    above = max(text.rfind("\n", 0, end) + 1, end - AROUND_CHARS)
    return not text.startswith("-----", above) and bool(_CONTEXT.search(text, above, end))


def _joined_by_dots(text: str, found: list[tuple[int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """Candidates with the start and end of the dot-joined string that each is part of."""
    heads, floor, head = [], 0, 0
    for start, end in found:
        own = start
        while own > floor and text[own - 1] == ".":
            left = own - 1
            if left == floor and heads:
                own = head
                break
            while left > floor and text[left - 1] in _PART:
                left -= 1
            if left == own - 1:
                break
            own = left
        head, floor = own, end
        heads.append(own)
    tail, below = 0, len(text) + 1
    tails = []
    for start, end in reversed(found):
        own = end
        while own < below and text.startswith(".", own):
            right = own + 1
            if right == below:
                own = tail
                break
            while right < min(below, len(text)) and text[right] in _PART:
                right += 1
            if right == own + 1:
                break
            own = right
        tail, below = own, start
        tails.append(own)
    return ((a, b, head, tail) for (a, b), head, tail in zip(found, heads, reversed(tails)))


def novel_spans(text: str, known: list[Span]) -> list[Span]:
    """Incompressible strings in sensitive context that no known span touches.

    Context reaches from a private key's first line over its body, from a line to the values that
    begin the next one, and over all parts of a dot-joined string.
    """
    if not any(word in text.lower() for word in CONTEXT_WORDS):
        return []
    spans = []
    blank = masked(text, known)
    starts = [start for start, _, _ in known]
    ends = list(accumulate((end for _, end, _ in known), max))  # furthest end so far

    def touched(start: int, end: int) -> bool:
        """Whether a known span overlaps: the last to begin before the end may not be the longest."""
        place = bisect_left(starts, end)
        return place > 0 and ends[place - 1] > start

    def novel(start: int, end: int, whole: tuple[int, int]) -> bool:
        value = text[start:end]
        if not re.search("[A-Za-z]", value) or touched(start, end):
            return False
        left, right = whole  # the rest of a whole explains nothing either
        before, after = blank[max(0, left - AROUND_CHARS) : left], blank[right : right + AROUND_CHARS]
        return marginal_bytes(value, before, after) >= NOVELTY * (end - start)

    blocks = [(m.start(), *m.span(1)) for m in _BLOCK.finditer(text)]
    for header, left, right in blocks:
        key = False  # the short last line of a key is told by the line before it
        for found in _BLOCK_PART.finditer(text, left, right):
            start, end = found.span()
            short = end - start < 16
            if key and short and touched(start, end):
                continue
            key = key if short else novel(start, end, (header, right))
            if key:
                spans.append((start, end, "novel"))
    found, place = [], 0
    for match in _CANDIDATE.finditer(text):
        while place < len(blocks) and blocks[place][2] <= match.start():
            place += 1
        if place == len(blocks) or match.start() < blocks[place][1]:
            found.append(match.span())
    for start, end, head, tail in _joined_by_dots(text, found):
        if (_sensitive(text, start) or (head < start and _sensitive(text, head))) and novel(start, end, (head, tail)):
            spans.append((start, end, "novel"))
    return sorted(spans)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans of every row's whole text.

    Spans are code points with exclusive ends. Null and empty texts have none: counts 0, the digest
    of the empty string, spans ''. Rows with equal or null ids stay separate, other columns are
    ignored, an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "c1"):
            counts: dict[str, list[int]] = {k: [] for k in KINDS[:3]}
            digests, found = [], []
            for text in texts_of(batch.column("c1")):
                base = base_spans(text)
                for k, own in counts.items():
                    own.append(sum(span[2] == k for span in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans = base + novel_spans(text, base)
                found.append(joined(sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))))
            columns = [batch.column("c0"), *(pa.array(c, pa.int64()) for c in counts.values())]
            columns += [pa.array(digests, pa.string()), pa.array(found, pa.string())]
            names = [id_col, *(f"n_{k}" for k in counts), "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        f"`{id_col}` {kind}, n_assign BIGINT, n_access BIGINT, n_hex BIGINT, base_sha256 STRING, spans STRING"
    )
    return pick(docs, id_col, text_col).mapInArrow(scan, schema)


def redacted(text: str, mark: str) -> str:
    """The text with every secret, and what overlaps it, replaced by one mark."""
    base = base_spans(text)
    parts, done = [], 0
    for start, end, _ in sorted(base + novel_spans(text, base)):
        if start >= done:
            parts += [text[done:start], mark]
        done = max(done, end)
    return "".join(parts) + text[done:]


def redact(docs: DataFrame, text_col: str = "text", mark: str = "<secret>") -> DataFrame:
    """All rows and columns, secrets in `text_col` replaced by `mark`; null texts stay null."""

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        for series in batches:
            yield series.map(lambda text: None if text is None else redacted(text, mark))

    return docs.withColumn(text_col, clean(F.col(f"`{text_col}`")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
