"""WARC archives with a two-level capture index (1).

Records are written as one gzip member each, so that any of them can be read alone. Their captures
are sorted by reversed-host URL keys and kept in compressed blocks; a sparse directory holds the
first key and the place of each block, and one top row per directory its first key. A lookup
searches the top rows, one directory and one block by bisection, then reads one byte range of an
archive. Files are opened by their URI, so the folder may lie in any store that pyarrow reaches.
Names carry the task attempt: files of failed attempts are never referred to.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm.common import pick, slices, table, texts_of
from headway.plans.staging import new_path

DATE = "2020-01-01T00:00:00Z"
#: Captures in a block of the index.
BLOCK_LINES = 3000
#: Ranges that lie this close in one archive are read together, up to so many bytes.
GAP_BYTES, RUN_BYTES = 1 << 16, 8 << 20

_URL = re.compile(r"^[^:/?#]*://([^/?#]*)([^#]*)", re.DOTALL)
_URN = "urn:headway:page:"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def reversed_key(url: str | None) -> str:
    """`com,example,www)/path?query`: URLs of one host, then of one domain, sort together."""
    if not url:
        return ""
    found = _URL.match(url)
    if not found:
        return url
    host, rest = found[1].lower(), found[2] or "/"
    return ",".join(reversed(host.split("."))) + ")" + rest


def capture_key(url: str | None, page: object) -> str:
    """The URL key, then the page's id, so that the captures of one URL stand apart."""
    return f"{reversed_key(url)} {'' if page is None else page}".replace("\n", "%0A")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page: object, url: str | None, payload: bytes, refers_to: object) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the headers alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_URN}{'' if page is None else page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_safe(url or '')}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_URN}{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(data: bytes) -> dict[str, str]:
    lines = data.decode().split("\r\n")[1:]
    return {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}


def parse(data: bytes) -> dict:
    """Page, URI, type, payload and reference of one record; the payload is null for a revisit."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields["warc-type"]
    refers = fields.get("warc-refers-to")
    return {
        "page": fields["warc-record-id"][len(_URN) + 1 : -1],
        "uri": fields["warc-target-uri"],
        "record_type": kind,
        "payload_bytes": int(_headers(http)["content-length"]),
        "payload_digest": fields["warc-payload-digest"].removeprefix("sha1:"),
        "payload": payload if kind == "response" else None,
        "refers_to": refers[len(_URN) + 1 : -1] if refers else None,
    }


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


class _Archive:
    """A new file of one task attempt."""

    def __init__(self, folder: str, ending: str) -> None:
        store, path = _store(folder)
        store.create_dir(path, recursive=True)
        task = TaskContext.get()
        self.name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid4().hex[:8]}{ending}"
        self.file = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.at = 0

    def append(self, data: bytes) -> tuple[int, int]:
        start = self.at
        self.file.write(data)
        self.at += len(data)
        return start, len(data)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write one record per row below `folder`; returns key, file, offset and length of each.

    Rows with equal payloads refer to the one with the smallest id, and rows that repeat that id
    stay responses. A null payload counts as empty, a null URL as ''. Rows without an id are
    responses that nothing refers to. The result must be written before it is used again.
    """
    rows = pick(pages, id_col, url_col, html_col)
    payload = F.encode(F.coalesce("c2", F.lit("")), "UTF-8")
    rows = rows.select("c0", "c1", payload.alias("payload"))
    firsts = rows.groupBy(F.sha1("payload").alias("sha1"))
    firsts = firsts.agg(F.min("c0").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    rows = rows.withColumn("own", F.sha1("payload")).join(firsts, F.col("own") == F.col("sha1"), "left")
    rows = rows.select("c0", "c1", "payload", F.when(F.col("c0") != F.col("first"), F.col("first")).alias("first"))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = None
        for batch in batches:
            archive = archive or _Archive(folder, ".warc.gz")
            keys, places = [], []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for page, url, data, first in zip(*columns):
                keys.append(capture_key(url, page))
                places.append(archive.append(_gzip(record(page, url, data, first))))
            offsets, lengths = zip(*places) if places else ((), ())
            arrays = [pa.array(keys, pa.string()), pa.array([archive.name] * len(keys), pa.string())]
            arrays += [pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["key", "file", "offset", "length"])
        if archive:
            archive.file.close()

    return rows.mapInArrow(write, "key STRING, file STRING, offset BIGINT, length BIGINT")


def write_index(captures: DataFrame, folder: str) -> list[tuple[str, str]]:
    """Sort captures into blocks and directories below `folder`; returns (first key, directory).

    One directory covers one range partition, so the returned list is as long as the number of
    shuffle partitions, whatever the number of captures.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks, directory, lines, starts = None, [], [], []

        def close_block() -> None:
            start, length = blocks.append(_gzip("\n".join(lines).encode()))
            directory.append((starts[0], start, length))
            lines.clear()
            starts.clear()

        for batch in batches:
            for row in batch.to_pylist():
                blocks = blocks or _Archive(folder, ".blocks.gz")
                lines.append(f"{row['key']}\t{row['file']}\t{row['offset']}\t{row['length']}")
                starts.append(row["key"])
                if len(lines) == BLOCK_LINES:
                    close_block()
        if blocks is None:
            return
        if lines:
            close_block()
        blocks.file.close()
        sparse = _Archive(folder, ".directory")
        sparse.append(json.dumps({"blocks": blocks.name, "directory": directory}).encode())
        sparse.file.close()
        arrays = [pa.array([directory[0][0]]), pa.array([sparse.name])]
        yield pa.RecordBatch.from_arrays(arrays, names=["key", "name"])

    order = ["key", "file", "offset"]
    ranges = captures.repartitionByRange(*order).sortWithinPartitions(*order)
    tops = ranges.mapInArrow(write, "key STRING, name STRING").collect()
    return sorted((row["key"], row["name"]) for row in tops)


class Index:
    """Finds captures of a key; keeps the directory and the block it used last."""

    def __init__(self, tops: list[tuple[str, str]], folder: str) -> None:
        self.tops = tops
        self.firsts = [key for key, _ in tops]
        self.store, self.path = _store(folder)
        self.at: tuple = (None, None)

    def _read(self, name: str, start: int = 0, length: int | None = None) -> bytes:
        with self.store.open_input_file(f"{self.path}/{name}") as file:
            return file.read_at(file.size() if length is None else length, start)

    def _directory(self, top: int) -> dict:
        if self.at[0] != top:
            found = json.loads(self._read(self.tops[top][1]))
            found["firsts"] = [first for first, _, _ in found["directory"]]
            self.at, self.directory = (top, None), found
        return self.directory

    def _block(self, top: int, number: int) -> tuple[list[str], list[list[str]]]:
        directory = self._directory(top)
        if self.at[1] != number:
            _, start, length = directory["directory"][number]
            lines = zlib.decompress(self._read(directory["blocks"], start, length), 31).decode().split("\n")
            rows = [line.split("\t") for line in lines]
            self.at, self.block = (top, number), (["\t".join(row[:-3]) for row in rows], rows)
        return self.block

    def find(self, key: str) -> list[tuple[str, int, int]]:
        """(file, offset, length) of every capture with this key."""
        found = []
        # Repeats of a key may begin in one block and go on in the next.
        for top in range(max(0, bisect_left(self.firsts, key) - 1), bisect_right(self.firsts, key)):
            firsts = self._directory(top)["firsts"]
            for number in range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key)):
                keys, rows = self._block(top, number)
                for i in range(bisect_left(keys, key), bisect_right(keys, key)):
                    found.append((rows[i][-3], int(rows[i][-2]), int(rows[i][-1])))
        return found


def read_ranges(
    places: list[tuple[str, int, int]], store: fs.FileSystem, path: str
) -> Iterator[bytes]:
    """Contents of the places by file and offset; near ones are read with one request."""
    places = sorted(places)
    i = 0
    while i < len(places):
        name, start, length = places[i]
        end, j = start + length, i + 1
        while j < len(places) and places[j][0] == name and places[j][1] - end <= GAP_BYTES:
            if places[j][1] + places[j][2] - start > RUN_BYTES:
                break
            end = max(end, places[j][1] + places[j][2])
            j += 1
        with store.open_input_file(f"{path}/{name}") as file:
            data = file.read_at(end - start, start)
        for _, at, size in places[i:j]:
            yield zlib.decompress(data[at - start : at - start + size], 31)
        i = j


def read_captures(
    keys: DataFrame, tops: list[tuple[str, str]], index_folder: str, archive_folder: str
) -> DataFrame:
    """Records of the distinct keys in the column `key`, found through the index."""
    names = ["page", "uri", "record_type", "payload_bytes", "payload_digest", "payload", "refers_to"]
    kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(tops, index_folder)
        store, path = _store(archive_folder)
        for batch in batches:
            for some in slices([batch], "key"):
                places = [place for key in sorted(texts_of(some.column("key"))) for place in index.find(key)]
                found, size = [], 0
                for data in read_ranges(places, store, path):
                    found.append(parse(data))
                    size += len(data)
                    if size > RUN_BYTES:
                        yield pa.RecordBatch.from_pylist(found, pa.schema(list(zip(names, kinds))))
                        found, size = [], 0
                if found:
                    yield pa.RecordBatch.from_pylist(found, pa.schema(list(zip(names, kinds))))

    wanted = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    schema = (
        "page STRING, uri STRING, record_type STRING, payload_bytes BIGINT, payload_digest STRING,"
        " payload BINARY, refers_to STRING"
    )
    return wanted.mapInArrow(read, schema)


def capture_keys(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The index keys of the rows, in the column `key`."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = map(capture_key, batch.column(1).to_pylist(), batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(keys), pa.string())], names=["key"])

    return pick(pages, id_col, url_col).mapInArrow(make, "key STRING")


def archive(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Write every row to archives and an index, and read all of them back through the index.

    Returns `id_col`, uri, record_type, payload_bytes, payload_digest, payload (null for revisits)
    and refers_to. Other columns are ignored; repeated rows are records of their own; an empty table
    gives no rows. Files stay in the stage folder of the session.
    """
    spark = pages.sparkSession
    kind = pages.schema[id_col].dataType
    archives, index, places = (new_path(spark, f"warc_{x}") for x in ("archives", "index", "captures"))
    captures = write_archives(pages, archives, id_col, url_col, html_col)
    captures.write.parquet(places)
    tops = write_index(spark.read.schema(captures.schema).parquet(places), index)
    found = read_captures(capture_keys(pages, id_col, url_col), tops, index, archives)
    page = F.nullif("page", F.lit("")) if kind.simpleString() != "string" else F.col("page")
    refers = F.col("refers_to").cast(kind)
    return found.select(
        page.cast(kind).alias(id_col), "uri", "record_type", "payload_bytes", "payload_digest", "payload",
        refers.alias("refers_to"),
    )


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
