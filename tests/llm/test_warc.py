import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from meterlake.llm import scratch, warc

PAGES = [
    (5, "http://a/1", "same body"), (2, "http://a/2", "same body"), (9, "http://a/3", "same body"), (1, "http://b", "x\r\n\r\ny WARC/1.1 é"),
    (3, None, None), (4, "http://c\r\nd", ""), (6, "http://e", "z" * 300_000), (None, "http://f", "same body"), (7, "http://g", "lone"), (7, "http://g", "lone"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(params=[0, 5])
def stored(spark, request, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 500)
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("offset", "length", "_sha", "_origin")})
    return request.param, warc.write_archives(pages, scratch.new_path(spark, "warc-test"), least=request.param)


def test_round_trip(stored):
    least, index = stored
    records = warc.resolve_revisits(warc.read_records(index)).collect()
    assert len(records) == len(PAGES) and all(r["intact"] for r in records)
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in records)
    wanted = []
    for i, _, html in PAGES:
        body = html or ""
        same = [j for j, _, h in PAGES if (h or "") == body and j is not None]
        first = min(same) if len(body.encode()) >= least else i
        wanted.append((str(i), len(body.encode()), digest(body), "response" if i == first else "revisit", None if i == first else first))
    assert got == sorted(wanted)
    bodies = {r["page_id"]: bytes(r["payload"]) for r in records if r["record_type"] == "response"}
    assert bodies[1] == PAGES[3][2].encode() and bodies[6] == PAGES[6][2].encode()


def test_files_are_gzip_members_at_the_indexed_places(stored):
    rows = stored[1].collect()
    for r in rows:
        with open(r["file"].removeprefix("file://"), "rb") as f:
            f.seek(r["offset"])
            raw = gzip.decompress(f.read(r["length"]))
        assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"\r\n\r\n") and b"sha1:" + r["digest"].encode() in raw


def test_selected_records_only(stored):
    some = stored[1].where("page_id IN (1, 6)")
    assert sorted(r["page_id"] for r in warc.read_records(some).collect()) == [1, 6]


def test_neighbouring_ranges_merge(monkeypatch):
    monkeypatch.setattr(warc, "GAP_BYTES", 10)
    monkeypatch.setattr(warc, "READ_BYTES", 100)
    rows = [("a", 0, 20, 0), ("a", 25, 20, 1), ("a", 60, 20, 2), ("a", 80, 90, 3), ("b", 170, 5, 4)]
    assert [[r[3] for r in g] for g in warc._reads(rows)] == [[0, 1], [2], [3], [4]]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    index = warc.write_archives(pages, scratch.new_path(spark, "warc-none"))
    assert index.count() == 0 and warc.read_records(index).count() == 0
