import base64
import gzip
import hashlib
import random

import pyarrow.parquet as pq

from headway.llm import warc
from headway.plans.staging import new_path
from tests.llm.conftest import SF_DIR

ODD = [
    (1, "http://A.b/c d\n", "x", "u"),
    (1, "http://A.b/c d\n", "x", "u"),
    (9, "http://a.b/other", "x", "u"),
    (None, None, None, None),
    (None, "u://x/", "x", "key"),
    (-5, "bad url", "", "file"),
    (7, "http://q/", "<é\r\n\r\n" * 100000, "payload"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_registered_round_trip(spark):
    pages = pq.read_table(f"{SF_DIR}/pages.parquet").to_pylist()
    first = {}
    for row in sorted(pages, key=lambda r: r["page_id"]):
        first.setdefault(row["html"] or "", row["page_id"])
    wanted = set()
    for row in pages:
        owner, html = first[row["html"] or ""], row["html"] or ""
        same = owner == row["page_id"]
        kind = "response" if same else "revisit"
        wanted.add((row["page_id"], len(html.encode()), digest(html), kind, None if same else owner))
    rows = [tuple(r) for r in warc.op1_warc(spark, SF_DIR).collect()]
    assert set(rows) == wanted and len(rows) == len(pages)


def test_odd_rows_come_back_whole(spark):
    pages = spark.createDataFrame(ODD, "page_id BIGINT, url STRING, html STRING, key STRING")
    rows = warc.archive(pages).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        if r["record_type"] == "response":
            assert digest(bytes(r["payload"]).decode()) == r["payload_digest"]
            assert len(r["payload"]) == r["payload_bytes"]
        else:
            assert (r["page_id"], r["refers_to"], r["payload"]) == (9, 1, None)
    by_page = sorted(str(r["page_id"]) for r in rows)
    assert by_page == sorted(str(row[0]) for row in ODD)
    assert warc.archive(pages.limit(0)).count() == 0


def test_archives_are_plain_warc_files(spark):
    folder = new_path(spark, "plain_warc")
    pages = spark.createDataFrame(ODD[2:], "page_id BIGINT, url STRING, html STRING, key STRING")
    places = warc.write_archives(pages, folder).collect()
    for name in {p["file"] for p in places}:
        with gzip.open(f"{folder}/{name}") as file:
            data = file.read()
        count = sum(p["file"] == name for p in places)
        assert data.startswith(b"WARC/1.1\r\n") and data.count(b"WARC-Record-ID: ") == count


def test_index_finds_every_key_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    draw, folder = random.Random(3), new_path(spark, "index")
    keys = [f"com,k{draw.randint(0, 60):02d})/ {i % 40}" for i in range(200)] + ["same"] * 10
    captures = [(key, f"file{i % 3}", i, 5) for i, key in enumerate(keys)]
    rows = spark.createDataFrame(captures, "key STRING, file STRING, offset BIGINT, length BIGINT")
    tops = warc.write_index(rows.repartition(4), folder)
    index = warc.Index(tops, folder)
    for key in [*set(keys), "", "com,k", "zz"]:
        wanted = sorted((file, offset, size) for k, file, offset, size in captures if k == key)
        assert sorted(index.find(key)) == wanted


def test_keys_sort_hosts_by_domain():
    urls = ["http://b.example.com/x", "https://example.com/", "http://a.org/", "http://a.example.com/y?z#f"]
    assert sorted(map(warc.reversed_key, urls)) == [
        "com,example)/", "com,example,a)/y?z", "com,example,b)/x", "org,a)/",
    ]
