"""WARC archives: written by tasks, indexed record by record, read back by coalesced byte ranges.

Writing: of pages with equal payloads (by SHA-1, at least ``least`` bytes) the one with the least
page_id is a response; the others become revisit records that name it.  Each task fills archive
files of about ``FILE_BYTES``, one gzip member per record, in the shared folder, and returns a row
per record: file, offset, length, URL, digest.  File names are unique to the attempt and only
files named by the index count, so a task that runs again leaves an unread file at worst.

Reading: the wanted index rows are sorted by file and offset, neighbouring ranges merge into
reads of at most ``READ_BYTES``, and records are cut out of each read, unpacked and checked
against their digest.

Folders are reached through pyarrow's file systems (file, hdfs, s3, gs, abfs addresses).

Defined cases: a null payload counts as empty; a null address is written as an empty
target; a null page_id is never the original of others, unless all are null, when each is a
response; rows that repeat page_id and payload are all responses if theirs is the least page_id;
an empty table gives an empty index; other columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm import scratch
from meterlake.llm.shipping import shipped

FILE_BYTES = 64 << 20
#: Longest read, and the widest gap that is read over.
READ_BYTES = 8 << 20
GAP_BYTES = 64 << 10
#: Archives carry one fixed date, so that equal input gives equal records.
DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id long, file string, offset long, length long, url string, digest string, record_type string, refers_to long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, intact boolean, payload binary"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id, url: str, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member.  Its id is made from the page's id."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}")
    revisit = refers_to is not None
    clean = "".join(c for c in url if c not in "\r\n")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>")
    body = b"" if revisit else payload
    lines.append(f"Content-Length: {len(body)}")
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _parse(member: bytes) -> tuple[dict[str, str], bytes]:
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


class _Archive:
    """Archive files of one task, opened as they are needed."""

    def __init__(self, root: str):
        self.system, self.folder = fs.FileSystem.from_uri(root)
        self.root, self.out, self.offset = root.rstrip("/"), None, 0

    def add(self, member: bytes) -> tuple[str, int]:
        if self.out is None or self.offset >= FILE_BYTES:
            self.close()
            self.name = f"{uuid.uuid4().hex}.warc.gz"
            self.out, self.offset = self.system.open_output_stream(f"{self.folder}/{self.name}", compression=None), 0
        at = self.offset
        self.out.write(member)
        self.offset += len(member)
        return f"{self.root}/{self.name}", at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _as_uri(path: str) -> str:
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


@shipped
def write_archives(pages: DataFrame, root: str, least: int = 0) -> DataFrame:
    """Write all ``pages`` (page_id, url, html) under ``root``; returns the stored index."""
    spark = pages.sparkSession
    root = _as_uri(root)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    target.getFileSystem(conf).mkdirs(target)
    texts = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    texts = texts.withColumn("_sha", F.sha1(F.encode("html", "UTF-8")))
    # The smallest id of each payload that occurs under several: few rows beside the pages.
    origin = texts.where(F.octet_length("html") >= least).groupBy("_sha").agg(
        F.min("page_id").alias("_origin"), F.count(F.lit(1)).alias("_n")
    ).where("_n > 1 AND _origin IS NOT NULL").drop("_n")
    origin = scratch.write(origin, "warc-origins")
    marked = texts.join(origin.withColumnRenamed("_sha", "_key"), F.col("_sha") == F.col("_key"), "left").select(
        "page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("_origin")), F.col("_origin")).alias("refers_to")
    )
    names = ["page_id", "file", "offset", "length", "url", "digest", "record_type", "refers_to"]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive = _Archive(root)
        try:
            for batch in batches:
                rows = []
                for page_id, url, html, refers_to in zip(*[batch.column(i) for i in range(4)]):
                    page_id, url, refers_to = page_id.as_py(), url.as_py(), refers_to.as_py()
                    payload = html.as_py().encode()
                    digest = digest_of(payload)
                    member = _record(page_id, url, payload, digest, refers_to)
                    rows.append((page_id, *archive.add(member), len(member), url, digest, "revisit" if refers_to is not None else "response", refers_to))
                cols = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
        finally:
            archive.close()

    return scratch.write(marked.mapInArrow(run, INDEX), "warc-index")


def _reads(rows: list[tuple]) -> Iterator[list[tuple]]:
    """Runs of rows of one file, by offset, that one read covers."""
    run: list[tuple] = []
    for r in rows:
        if run and (r[0] != run[0][0] or r[1] - (run[-1][1] + run[-1][2]) > GAP_BYTES or r[1] + r[2] - run[0][1] > READ_BYTES):
            yield run
            run = []
        run.append(r)
    if run:
        yield run


@shipped
def read_records(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` rows point at.  ``payload_bytes`` is null for revisits, which hold none;
    ``intact`` says whether a payload fits its digest."""
    spark = index.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = index.select("page_id", "file", "offset", "length", "refers_to")
    # Ranges of (file, offset): neighbours stay together and a large file is shared by tasks.
    wanted = wanted.repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "intact", "payload"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, refers = batch.column("page_id").to_pylist(), batch.column("refers_to").to_pylist()
            rows = list(zip(batch.column("file").to_pylist(), batch.column("offset").to_pylist(), batch.column("length").to_pylist(), range(len(batch))))
            for group in _reads(rows):
                name, first = group[0][0], group[0][1]
                system, path = fs.FileSystem.from_uri(name)
                with system.open_input_file(path) as source:
                    data = source.read_at(group[-1][1] + group[-1][2] - first, first)
                out = []
                for _, offset, length, k in group:
                    fields, payload = _parse(data[offset - first : offset - first + length])
                    revisit = fields["WARC-Type"] == "revisit"
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    out.append((
                        ids[k], fields["WARC-Target-URI"], fields["WARC-Type"], None if revisit else len(payload), digest, refers[k],
                        revisit or digest_of(payload) == digest, payload if with_payload else None,
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return wanted.mapInArrow(run, RECORD)


@shipped
def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with ``payload_bytes`` of revisits taken from the response they refer to."""
    whole = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest")).agg(F.max("payload_bytes").alias("_bytes"))
    same = (F.col("refers_to") == F.col("_id")) & (F.col("payload_digest") == F.col("_digest"))
    out = records.join(whole, same, "left").withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes"))
    return out.drop("_id", "_digest", "_bytes")
