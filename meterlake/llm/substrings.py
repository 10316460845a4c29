"""Substring de-duplication: Rabin-Karp hashes of every window of words, counted in Spark.

A window (``SIZE`` consecutive words of one document) is repeated if its word sequence also starts
in a document of smaller doc_id.  The words of repeated windows go: windows that touch or overlap
merge into maximal removal intervals.

Every window of every text is hashed in two lanes.  A batch keeps, of windows that it holds
several times, those of the smallest doc_id; the others are repeated already.  The digests that are
left travel to the bucket of their digest (a hot window once per batch, not once per document), and
each bucket finds the smallest doc_id of each digest.  Digests are as wide as the number of
windows asks for, so that the chance of any false match stays below 2**-14 at every size.

Defined cases: null and empty texts have no words; a text shorter than a window has none and stays
whole; copies under one doc_id leave each other alone (no smaller doc_id); documents without a
doc_id are kept whole and are nobody's source; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm import packing
from meterlake.llm.shipping import shipped
from meterlake.llm.wordhash import Words, mix, slices, windows

SIZE = 50
#: Text hashed at a time.
BATCH_BYTES = 4 << 20
_EXCHANGE = "bucket int, doc_id long, text_key long, body binary"


def _local_repeats(x1: np.ndarray, x2: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Windows that also start under a smaller id in this batch; ``ids`` ascend."""
    repeated = np.zeros(len(x1), bool)
    order = np.argsort(x1, kind="stable")
    a, b = x1[order], x2[order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    if same.any():
        near = np.zeros(len(a), bool)
        near[1:] |= same
        near[:-1] |= same
        at = np.flatnonzero(near)
        head = np.ones(len(at), bool)
        head[1:] = ~((a[at[1:]] == a[at[:-1]]) & (b[at[1:]] == b[at[:-1]]))
        ids_at = ids[order[at]]
        first = ids_at[np.flatnonzero(head)][np.cumsum(head) - 1]
        repeated[order[at]] = ids_at > first
    return repeated


def _hash_windows(size: int, buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                part = part.take(pc.sort_indices(part.column("doc_id")))
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                keys = part.column("text_key").to_numpy(zero_copy_only=False) & 0xFFFFFFFF
                words = Words(part.column("text"))
                start, x1 = windows(words, words.hashes(0), size, 0)
                if not len(start):
                    continue
                _, x2 = windows(words, words.hashes(1), size, 1)
                counts = np.maximum(words.counts() - size + 1, 0)
                doc = np.repeat(np.arange(len(ids)), counts)
                first = np.concatenate(([0], np.cumsum(counts)))
                repeated = _local_repeats(x1, x2, ids[doc])
                homes = mix(ids.astype(np.uint64)) % np.uint64(buckets)
                rows = []
                for d in np.unique(doc[repeated]):
                    local = np.flatnonzero(repeated[first[d] : first[d + 1]]).astype(np.int32)
                    rows.append((int(homes[d]), int(ids[d]), int(keys[d]), local.tobytes()))
                live = np.flatnonzero(~repeated)
                for b, at in packing.by_bucket(packing.bucket_of(x2[live], buckets)):
                    place = live[at]
                    held = np.unique(doc[place])
                    body = packing.pack([
                        np.diff(ids[held], prepend=0), keys[held].astype(np.uint32), np.diff(first[held], prepend=0),
                        packing.digest_planes(x1[place], x2[place], width), packing.encode_gaps(place),
                    ])
                    rows.append((b, None, None, body))
                for i in range(0, len(rows), 2000):
                    cols = list(zip(*rows[i : i + 2000]))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())
                    ], ["bucket", "doc_id", "text_key", "body"])

    return run


def _repeats_of(blobs: list[bytes], width: int) -> np.ndarray:
    """(doc_id, text_key, start) of repeated windows among the digests of one bucket."""
    low, high, ids, keys, starts = [], [], [], [], []
    for blob in blobs:
        d_ids, d_keys, d_first, planes, gaps = packing.unpack(blob)
        held, first = np.cumsum(packing.inflate(d_ids, np.int64)), np.cumsum(packing.inflate(d_first, np.int64))
        place = packing.decode_gaps(gaps)
        owner = np.searchsorted(first, place, side="right") - 1
        a, b = packing.read_digests(planes, width)
        low.append(a)
        high.append(b)
        ids.append(held[owner])
        keys.append(packing.inflate(d_keys, np.uint32)[owner])
        starts.append((place - first[owner]).astype(np.int32))
    low, ids = np.concatenate(low), np.concatenate(ids)
    order = np.argsort(low)
    near = np.zeros(len(low), bool)
    same = low[order[1:]] == low[order[:-1]]
    near[1:] |= same
    near[:-1] |= same
    at = order[near]
    low, high, ids = low[at], np.concatenate(high)[at], ids[at]
    keys, starts = np.concatenate(keys)[at], np.concatenate(starts)[at]
    order = np.lexsort((ids, high, low))
    low, high, ids = low[order], high[order], ids[order]
    head = np.ones(len(low), bool)
    head[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    if not len(low):
        return np.zeros((0, 3), np.int64)
    least = ids[np.flatnonzero(head)][np.cumsum(head) - 1]
    hit = ids > least
    return np.stack([ids[hit], keys[order][hit].astype(np.int64), starts[order][hit].astype(np.int64)], axis=1)


def _compare(width: int, groups: int):
    """Repeats of the buckets of a partition, packed by the group of their document: a row per
    group, however many documents it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        found = []
        for batch in batches:
            own = pc.is_valid(batch.column("doc_id"))
            done = batch.filter(own)
            for i, k, body in zip(*[done.column(c).to_pylist() for c in ("doc_id", "text_key", "body")]):
                starts = np.frombuffer(body, np.int32)
                found.append(np.stack([np.full(len(starts), i), np.full(len(starts), k), starts], axis=1))
            rest = batch.filter(pc.invert(own))
            for b, body in zip(rest.column("bucket").to_pylist(), rest.column("body").to_pylist()):
                held.setdefault(b, []).append(body)
        for b in sorted(held):
            found.append(_repeats_of(held.pop(b), width))
        hits = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        rows = []
        for g, at in packing.by_bucket((mix(hits[:, 0].astype(np.uint64)) % np.uint64(groups)).astype(np.uint32)):
            mine = hits[at]
            rows.append((g, packing.pack([mine[:, 0], mine[:, 1].astype(np.uint32), mine[:, 2].astype(np.int32)])))
        g, body = zip(*rows) if rows else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(body, pa.binary())], ["group", "body"])

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with all its repeats; a document's group is in one partition."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for g, body in zip(batch.column("group").to_pylist(), batch.column("body").to_pylist()):
            held.setdefault(g, []).append(body)
    for g in sorted(held):
        parts = [packing.unpack(body) for body in held.pop(g)]
        ids, keys, starts = [np.concatenate([packing.inflate(p[i], kind) for p in parts]) for i, kind in enumerate((np.int64, np.uint32, np.int32))]
        order = np.lexsort((starts, keys, ids))
        ids, keys, starts = ids[order], keys[order], starts[order]
        cut = np.flatnonzero((ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])) + 1
        cuts = np.concatenate(([0], cut, [len(ids)]))
        head = cuts[:-1]
        yield pa.RecordBatch.from_arrays([pa.array(ids[head]), pa.array(keys[head].astype(np.int64)), packing.binary_rows(starts, cuts)], ["doc_id", "text_key", "starts"])


@shipped
def repeated_windows(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """``doc_id``, ``text_key`` (low half of the text's hash) and ``starts``: packed 32-bit start words
    of the repeated windows of that text."""
    spark = docs.sparkSession
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = packing.bucket_count(spark, total)
    width = packing.digest_width(total // 5, buckets)
    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_key"))
    sent = texts.mapInArrow(_hash_windows(size, buckets, width), _EXCHANGE).repartition(buckets, "bucket")
    hits = sent.mapInArrow(_compare(width, buckets), "group int, body binary").repartition(buckets, "group")
    return hits.mapInArrow(_gather, "doc_id long, text_key long, starts binary")


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                n_words, n_removed, spans, kept = [], [], [], []
                for text, starts in zip(part.column("text"), part.column("starts")):
                    words = (text.as_py() or "").encode().split()
                    n_words.append(len(words))
                    if not starts.is_valid:
                        n_removed.append(0)
                        spans.append([])
                    else:
                        at = np.frombuffer(starts.as_py(), np.int32)
                        cover = np.zeros(len(words) + 1, np.int64)
                        np.add.at(cover, at, 1)
                        np.add.at(cover, at + size, -1)
                        gone = np.cumsum(cover[:-1]) > 0
                        edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
                        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
                        n_removed.append(int(gone.sum()))
                        words = compress(words, ~gone)
                    kept.append(b" ".join(words).decode())
                span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())],
                    ["doc_id", "n_words", "n_removed", "spans", "kept_text"],
                )

    return run


@shipped
def remove_repeats(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, spans (removed word ranges), kept_text."""
    found = repeated_windows(docs, size).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "starts")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    same = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text").bitwiseAND(F.lit(0xFFFFFFFF)) == F.col("_key"))
    joined = texts.join(found, same, "left").select("doc_id", "text", "starts")
    return joined.mapInArrow(_cut(size), "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept_text string")
