"""Exact Jaccard self-join of word-shingle sets by universe partitioning and the pigeonhole principle.

Two sets are similar at t = 85 % if |X ^ Y| is at most H = 15 (|X| + |Y|) / 185.  Sizes fall into bands
in which only neighbours can be similar.  For each band the universe of shingles is hashed into
segments; segment-wise differences add up to at most H, so with enough segments similar sets agree
on some segment, or differ by one shingle there.  A set sends the hash of each segment subset, and
for some segments also the subset without each one of its shingles (one-deletion neighbourhood).
How many segments of either kind a band gets is chosen by a cost model (``plan_for``): digests
sent against expected chance meetings.  Of its exact segments a set leaves out a number: empty ones, then those
whose digests most other sets hold, as counted over the whole table.  The plan holds as many segments more, and since
the order of leaving out depends on the subset alone, similar sets share one digest more than either leaves out.  So
common passages, which make up some segments of very many sets, join none of them, and clusters do not
grow together as the table grows.

Sets that share a digest that both keep form candidate clusters (connected components of "same as the first in
the bucket").  Each cluster is verified exactly: its shingle sets meet in one task, or, for a large
cluster, in one task per two neighbouring size bands (and per pair of blocks, where those are large too), and a
search over neighbourhoods finds the linked sets without listing pairs.  Components of those links are the result.

Defined cases: null and wordless texts have an empty set and link with nothing (their own class); a
text with fewer words than a shingle is one shingle; equal sets link, also under one doc_id; rows with
equal doc_id give one row each and share their least class (different texts under one doc_id take part
each for itself, under numbers of their own); rows without doc_id give a row each with
null component and take no part; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm import graph, ordering, packing, scratch
from meterlake.llm.shipping import shipped
from meterlake.llm.wordhash import Words, mix, slices, windows

SHINGLE = 4
PERCENT = 85
BATCH_BYTES = 2 << 20
#: Rows of a table that may be sent to every executor (16 bytes each).
BROADCAST_ROWS = 1_000_000
#: Shingles verified together in one task; larger clusters are cut into blocks.
CLUSTER_SHINGLES = 2_000_000
#: Digests held by more rows than this (and than a 100,000th of all rows) are at most so many as can be broadcast.
HOT_COPIES, HOT_DIGESTS = 1_000, 100_000
#: Cost model: price of a light subset, which meets others by chance, in digests sent.
_MEETING = 4.0


def difference_limit(a: int, b: int, percent: int = PERCENT) -> int:
    """Largest |X ^ Y| of similar sets of sizes a and b."""
    return (100 - percent) * (a + b) // (100 + percent)


@functools.lru_cache(maxsize=8)
def band_starts(top: int, percent: int = PERCENT) -> np.ndarray:
    """Least size of each band up to ``top``; the next band starts where similarity with it ends."""
    out = [1]
    while out[-1] <= top:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out)


@functools.lru_cache(maxsize=4096)
def plan_for(band: int, percent: int = PERCENT) -> tuple[int, int, int]:
    """(exact segments, one-deletion segments, exact segments a set leaves out) of a band's scheme.

    With d one-deletion segments, each of which must differ twice to be missed, and e left out,
    H - 2 d + 1 + e exact segments are enough.  Either all segments are exact, or all are
    one-deletion and half as many, with subsets twice as large: the cheaper of the two.
    """
    starts = [1]
    while len(starts) <= band + 1:
        starts.append(starts[-1] * 100 // percent + 1)
    low, high = starts[band], starts[band + 1] - 1
    limit = difference_limit(high, high * 100 // percent, percent)
    best = None
    for deletions in (0, (limit + 2) // 2):
        needed = max(0, limit - 2 * deletions + 1)
        spare, exact = 0, needed
        for _ in range(3 if needed > 1 else 0):  # room for the empty segments of nearly every set of the band
            empty = exact * math.exp(-low / exact)
            spare = math.ceil(empty + 3 * math.sqrt(empty))
            exact = needed + spare
        load = low / (exact + deletions)
        light = math.exp(-load) * (1 + load)  # a subset of one shingle or none
        cost = exact - spare + deletions * (1 + load) + _MEETING * (needed + deletions) * light
        if best is None or cost < best[0]:
            best = (cost, exact, deletions, spare)
    return best[1:]


class Sets:
    """Shingle sets of a batch of texts: ``items`` sorted within each set, ``first`` their bounds."""

    def __init__(self, texts: pa.Array, size: int = SHINGLE):
        words = Words(texts, lower=True)
        hashed = words.hashes()
        start, h = windows(words, hashed, size)
        n = words.counts()
        doc = np.searchsorted(words.first, start, side="right") - 1 if len(start) else np.zeros(0, np.int64)
        short = np.flatnonzero((n > 0) & (n < size))
        if len(short):  # the whole sequence as one shingle, told apart by its length
            whole = np.array([mix(_fold(hashed[words.first[d] : words.first[d + 1]]))[0] for d in short], np.uint64)
            doc, h = np.concatenate((doc, short)), np.concatenate((h, whole))
        order = np.argsort(h)
        order = order[np.argsort(doc[order].astype(np.uint16 if len(n) < 1 << 16 else np.int64), kind="stable")]
        doc, h = doc[order], h[order]
        keep = np.ones(len(h), bool)
        keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        self.items, self.doc = h[keep], doc[keep]
        self.first = np.searchsorted(self.doc, np.arange(len(n) + 1))
        self.sizes = np.diff(self.first)

    def digests(self) -> np.ndarray:
        """128 bits of each set, independent of the order of its items."""
        out = np.zeros((len(self.sizes), 2), np.uint64)
        for lane in range(2):
            np.add.at(out[:, lane], self.doc, mix(self.items ^ np.uint64(0xA0761D6478BD642F * (lane + 1) & (2**64 - 1))))
        return out


def numbered_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Shingle sets as numbers that are equal for equal shingles only, among these texts."""
    words = Words(texts, lower=True)
    ids, counts, first = words.ids(), words.counts(), words.first
    windows_of = np.maximum(counts - size + 1, 0)
    start = np.arange(int(windows_of.sum())) + np.repeat(first[:-1] - (np.cumsum(windows_of) - windows_of), windows_of)
    found = ids[start]
    for k in range(1, size):  # a run of k words has its number; with the next word it is a pair of numbers
        found = np.unique(found << 32 | ids[start + k], return_inverse=True)[1].astype(np.int64)
    bounds = np.concatenate(([0], np.cumsum(windows_of)))
    out = [np.unique(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    whole: dict[tuple, int] = {}
    for d in np.flatnonzero((counts > 0) & (counts < size)):  # whole sequences, numbered below zero
        key = tuple(ids[first[d] : first[d + 1]].tolist())
        out[d] = np.array([-1 - whole.setdefault(key, len(whole))])
    return out


def _fold(hashed: np.ndarray) -> np.ndarray:
    out = np.array([len(hashed)], np.uint64)
    for h in hashed:
        out = mix(out + h)
    return out


def signatures(sets: Sets, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the segment subsets of all sets of a batch, and the set each belongs to."""
    return counted_signatures(sets, percent)[:2]


def counted_signatures(sets: Sets, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``signatures``, and how many digests each set may leave out yet: of even schemes, and of odd ones.

    The last bit of a digest tells which, so the two schemes of a set are kept apart.
    """
    late = np.zeros((len(sets.sizes), 2), np.int64)
    starts = band_starts(int(sets.sizes.max(initial=1)), percent)
    band = np.searchsorted(starts, sets.sizes, side="right") - 1
    all_sig, all_doc = [], []
    for back in (0, 1):
        scheme = band - back
        # A set is the larger one in the scheme of the band below, if a partner is that small.
        use = (sets.sizes > 0) & (scheme >= 0)
        if back:
            use &= sets.sizes <= (starts[np.maximum(band, 0)] - 1) * 100 // percent
        if not use.any():
            continue
        plans = np.array([plan_for(int(k), percent) if k >= 0 else (0, 0, 0) for k in range(-1, int(band.max()) + 1)])
        exact, deletions, spare = plans[np.where(use, scheme, -1) + 1].T
        count = exact + deletions
        base = np.concatenate(([0], np.cumsum(count)))
        mine = use[sets.doc]
        doc, items = sets.doc[mine], sets.items[mine]
        seed = mix(scheme.astype(np.int64).astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(17))
        spread = mix(items ^ seed[doc])
        seg = ((spread >> np.uint64(32)) * count[doc].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        place = base[doc] + seg
        load = mix(spread + np.uint64(0x51))
        total = np.zeros(base[-1], np.uint64)
        np.add.at(total, place, load)
        weight = np.bincount(place, minlength=base[-1])
        owner = np.repeat(np.arange(len(count)), count)
        number = np.arange(base[-1]) - base[owner]
        tag = mix(seed[owner] + number.astype(np.uint64) * np.uint64(0xE7037ED1A0B428DB))
        is_exact = number >= deletions[owner]
        # Empty exact segments go first, by number: every set that has one too shares them.
        empty = is_exact & (weight == 0)
        rank = np.cumsum(empty) - empty
        rank -= np.concatenate((rank, [0]))[base[:-1]][owner]
        gone = empty & (rank < spare[owner])
        late[np.arange(len(count)), scheme & 1] += spare - np.bincount(owner[gone], minlength=len(count))
        kept = np.flatnonzero(~gone)
        odd = (scheme & 1).astype(np.uint64)
        all_sig.append(mix(total[kept] + tag[kept]) & ~np.uint64(1) | odd[owner[kept]])
        all_doc.append(owner[kept])
        without = np.flatnonzero(seg < deletions[doc])
        at = place[without]
        all_sig.append(mix(total[at] - load[without] + tag[at]) & ~np.uint64(1) | odd[doc[without]])
        all_doc.append(doc[without])
    if not all_sig:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), late
    return np.concatenate(all_sig), np.concatenate(all_doc), late


_ROW = "kind int, bucket int, doc_id long, other long, size long, body binary"
_NAMES = ["kind", "bucket", "doc_id", "other", "size", "body"]


def _rows(kind: int, bucket=None, doc_id=None, other=None, size=None, body=None) -> pa.RecordBatch:
    n = next(len(x) for x in (bucket, doc_id, other, size, body) if x is not None)
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    cols = [pa.array(x, t) if x is not None else pa.nulls(n, t) for x, t in zip((bucket, doc_id, other, size, body), kinds)]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *cols], _NAMES)


def _bucket_of_id(ids: np.ndarray, buckets: int) -> np.ndarray:
    """Ids with a stride fall into all buckets."""
    return (mix(ids.astype(np.int64).astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _packed(bucket: np.ndarray, ids: np.ndarray, sig: np.ndarray, *more: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of kind 2: the ids and digests of each bucket, and what else belongs to them."""
    out = []
    for k, at in packing.by_bucket(bucket):
        at = at[np.argsort(ids[at], kind="stable")]
        out.append((k, packing.pack([np.diff(ids[at], prepend=0), sig[at].tobytes(), *(x[at] for x in more)])))
    for i in range(0, len(out), 2000):
        k, bodies = zip(*out[i : i + 2000])
        yield _rows(2, bucket=k, body=bodies)


def _unpacked(blobs: list[bytes], *more: type) -> list[np.ndarray]:
    cols: list[list[np.ndarray]] = [[] for _ in range(2 + len(more))]
    for blob in blobs:
        i, sig, *rest = packing.unpack(blob)
        for col, x in zip(cols, (np.cumsum(packing.inflate(i, np.int64)), np.frombuffer(sig, np.uint64), *map(packing.inflate, rest, more))):
            col.append(x)
    return [np.concatenate(c) for c in cols]


def _send(buckets: int, size: int, percent: int):
    """kind 0: a document (doc_id, digest as body, size, digests to leave out as other); 2: digests of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False)
                sets = Sets(part.column("text"), size)
                both = sets.digests()
                sig, doc, late = counted_signatures(sets, percent)
                body = packing.binary_rows(both.view(np.uint8).reshape(-1), np.arange(len(ids) + 1) * 16)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.zeros(len(ids), np.int32)), pa.array(_bucket_of_id(ids, buckets)), pa.array(ids),
                    pa.array(late[:, 0] | late[:, 1] << 32), pa.array(sets.sizes.astype(np.int64)), body,
                ], _NAMES)
                # Of equal sets one sends digests: they have the same head later.
                first = np.zeros(len(ids), bool)
                first[np.unique(both, axis=0, return_index=True)[1]] = True
                mine = first[doc]
                sig, doc = sig[mine], doc[mine]
                if len(sig):
                    yield from _packed(packing.bucket_of(sig, buckets), ids[doc], sig)

    return run


def _by_kind(batches: Iterator[pa.RecordBatch], docs: list[pa.RecordBatch], held: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Sort rows into documents and digests by bucket."""
    for batch in batches:
        mine = batch.filter(pc.equal(batch.column("kind"), 0))
        if len(mine):
            docs.append(mine)
            yield mine
        rest = batch.filter(pc.equal(batch.column("kind"), 2))
        for b, body in zip(rest.column("bucket").to_pylist(), rest.column("body").to_pylist()):
            held.setdefault(b, []).append(body)


def _count(buckets: int):
    """Digests held by several documents go back to those, with the number of their holders."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in _by_kind(batches, [], held):
            yield batch
        for b in sorted(held):
            ids, sig = _unpacked(held.pop(b))
            order = np.lexsort((ids, sig))
            ids, sig = ids[order], sig[order]
            once = np.ones(len(ids), bool)
            once[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
            ids, sig = ids[once], sig[once]
            at = np.concatenate(([0], np.flatnonzero(sig[1:] != sig[:-1]) + 1, [len(sig)]))
            holders = np.repeat(np.diff(at), np.diff(at))
            many = holders > 1
            ids, sig, holders = ids[many], sig[many], holders[many]
            yield from _packed(_bucket_of_id(ids, buckets), ids, sig, holders)

    return run


def _leave_out(buckets: int):
    """Of each scheme a document leaves out its commonest digests, ties by digest; the others go to their buckets.

    kind 1: edges between the documents of a bucket that share a digest here already.  The least
    one of those so connected stands for all, so a large group is sent once a bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        docs: list[pa.RecordBatch] = []
        for batch in _by_kind(batches, docs, held):
            yield batch
        if not held:
            return
        late = pa.Table.from_batches(docs).select(["doc_id", "other"])
        known, first = np.unique(late.column("doc_id").to_numpy(), return_index=True)
        both = late.column("other").to_numpy()[first]
        for b in sorted(held):
            ids, sig, holders = _unpacked(held.pop(b), np.int64)
            odd = (sig & np.uint64(1)).astype(np.int64)
            order = np.lexsort((sig, -holders, odd, ids))
            ids, sig, odd = ids[order], sig[order], odd[order]
            head = np.ones(len(ids), bool)
            head[1:] = (ids[1:] != ids[:-1]) | (odd[1:] != odd[:-1])
            start = np.flatnonzero(head)
            rank = np.arange(len(ids)) - start[np.cumsum(head) - 1]
            keep = rank >= (both[np.searchsorted(known, ids)] >> 32 * odd & 0xFFFFFFFF)
            ids, sig = ids[keep], sig[keep]
            root, node = _forest(_stars(sig, ids))
            if len(node):
                yield _rows(1, doc_id=root, other=node)
                order = np.argsort(node)
                root, node = root[order], node[order]
                at = np.minimum(np.searchsorted(node, ids), len(node) - 1)
                ids = np.where(node[at] == ids, root[at], ids)
                order = np.lexsort((ids, sig))
                ids, sig = ids[order], sig[order]
                once = np.ones(len(ids), bool)
                once[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
                ids, sig = ids[once], sig[once]
            if len(ids):
                yield from _packed(packing.bucket_of(sig, buckets), ids, sig)

    return run


def _stars(key: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Edges (least id, other id) within each key."""
    order = np.lexsort((ids, key))
    k, i = key[order], ids[order]
    head = np.ones(len(k), bool)
    head[1:] = k[1:] != k[:-1]
    least = i[np.flatnonzero(head)][np.cumsum(head) - 1] if len(k) else i
    far = i != least
    return np.stack([least[far], i[far]], axis=1)


def _forest(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (least node of its component, node) that connect what ``edges`` connect."""
    nodes, ends = np.unique(edges, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        nxt = root.copy()
        for end in (a, b):
            np.minimum.at(nxt, root[end], low)
        while (nxt[nxt] != nxt).any():
            nxt = nxt[nxt]
        if (nxt == root).all():
            break
        root = nxt[root]
    far = root != np.arange(len(nodes))
    return nodes[root[far]], nodes[far]


def _meet(buckets: int):
    """Edges between documents that share a digest of a bucket, to the bucket of their least id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for _ in _by_kind(batches, [], held):
            pass
        edges = [_stars(*_unpacked(held.pop(b))[::-1]) for b in sorted(held)]
        if edges:
            a, b = _forest(np.concatenate(edges))
            yield from _packed(_bucket_of_id(a, buckets), a, b.view(np.uint64))

    return run


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A pair meets in many buckets: one edge of it is left."""
    held: dict[int, list[bytes]] = {}
    for _ in _by_kind(batches, [], held):
        pass
    for k in sorted(held):
        a, b = _unpacked(held.pop(k))
        yield _edges(np.stack(_forest(np.stack([a, b.view(np.int64)], axis=1)), axis=1))


def _linked(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges that join every set to the first one of its component.

    A similar set shares at least percent of a set's items, so it holds one of the set's rarest
    items, of which one more than the rest is looked up.  Sets found there are compared in full;
    each set is looked up once, among those not reached yet.
    """
    sizes = np.array([len(s) for s in sets])
    _, items, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    first = np.concatenate(([0], np.cumsum(sizes)))
    mine = [items[a:b] for a, b in zip(first[:-1], first[1:])]
    holders = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(items, kind="stable")]
    at = np.concatenate(([0], np.cumsum(counts)))
    mark = np.zeros(len(counts), bool)
    open_ = np.ones(len(sizes), bool)
    left = len(sizes)
    edges = []
    for root in range(len(sizes)):
        if not open_[root]:
            continue
        open_[root] = False
        left -= 1
        queue = [root]
        while queue and left:
            x = queue.pop()
            n = int(sizes[x])
            rare = mine[x][np.argsort(counts[mine[x]], kind="stable")[: n + (-n * percent) // 100 + 1]]
            rare = rare[counts[rare] > 1]
            if not len(rare):
                continue
            met = np.unique(np.concatenate([holders[at[i] : at[i + 1]] for i in rare]))
            met = met[open_[met]]
            met = met[(100 * sizes[met] >= percent * n) & (percent * sizes[met] <= 100 * n)]
            if not len(met):
                continue
            mark[mine[x]] = True
            hits = np.array([np.count_nonzero(mark[mine[y]]) for y in met])
            mark[mine[x]] = False
            found = met[100 * hits >= percent * (n + sizes[met] - hits)]
            open_[found] = False
            left -= len(found)
            edges.extend((int(ids[root]), int(ids[y])) for y in found)
            queue.extend(found.tolist())
    return edges


def _verify(size: int, percent: int):
    """Rows come sorted by (cluster, part, left, right); each run of equal keys is verified together."""

    def solve(key, parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        return _linked(rows.column("doc_id").to_numpy(), numbered_sets(rows.column("text"), size), percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, out = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cluster", "part", "lo", "hi")], axis=1)
            cut = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            for a, b in zip(cut[:-1], cut[1:]):
                if b == a:
                    continue
                mine = tuple(keys[a])
                if parts and mine != key:
                    out.extend(solve(key, parts))
                    parts = []
                key = mine
                parts.append(batch.slice(a, b - a).select(["doc_id", "text"]))
            if len(out) > 10_000:
                yield _edges(out)
                out = []
        if parts:
            out.extend(solve(key, parts))
        yield _edges(out)

    return run


def _edges(pairs: list[tuple[int, int]] | np.ndarray) -> pa.RecordBatch:
    a, b = np.array(pairs, np.int64).reshape(-1, 2).T
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if counted to be small; otherwise the planner shuffles both sides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _own_numbers(texts: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``texts`` with a doc_id that stands for one text only, and what the new ids stand for.

    Rows that share a doc_id but not the text get numbers that no row uses.  None: there are no such rows.
    """
    key = F.xxhash64("text")
    odd = texts.groupBy("doc_id").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi")).where("_lo <> _hi").select("doc_id")
    odd = scratch.write(odd, "setjoin-odd")
    if odd.isEmpty():
        return texts, None
    low, high = texts.agg(F.min("doc_id"), F.max("doc_id")).first()
    keyed = texts.withColumn("_key", key)
    each = keyed.join(_small(odd), "doc_id", "left_semi").select("doc_id", "_key").distinct()
    # Above the greatest id, or below the least where there is more room.
    up = high < -low
    placed = ordering.positions(each, [F.col("doc_id"), F.col("_key")], {})
    own = (F.lit(high) + 1 + F.col("_before")) if up else (F.lit(low) - 1 - F.col("_before"))
    numbers = scratch.write(placed.select("doc_id", "_key", own.alias("_own")), "setjoin-numbers")
    named = keyed.join(_small(numbers), ["doc_id", "_key"], "left").select(F.coalesce("_own", "doc_id").alias("doc_id"), "text")
    return named, numbers.select("_own", F.col("doc_id").alias("_true"))


def _true_ids(df: DataFrame, numbers: DataFrame | None, columns: list[str]) -> DataFrame:
    """``df`` with the ids of the documents in place of the numbers above."""
    for c in columns if numbers is not None else ():
        back = numbers.withColumnRenamed("_own", c)
        df = df.join(_small(back), c, "left").withColumn(c, F.coalesce("_true", c)).drop("_true")
    return df


def _with_heads(rows: DataFrame) -> DataFrame:
    """``head``: the least doc_id with the same set.  Digests of very many rows are looked up without a shuffle."""
    heads = rows.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("head"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    heads = scratch.write(heads, "setjoin-heads")
    hot = F.col("_n") > max(HOT_COPIES, rows.count() // HOT_DIGESTS)
    common = heads.where(hot).select("digest", F.col("head").alias("_common"))  # at most HOT_DIGESTS rows
    rows = rows.join(F.broadcast(common), "digest", "left")
    rare = rows.where("_common IS NULL").drop("_common").join(heads.where(~hot).drop("_n"), "digest", "left")
    out = rare.unionByName(rows.where("_common IS NOT NULL").withColumnRenamed("_common", "head"))
    return out.select("doc_id", "n_shingles", F.coalesce("head", "doc_id").alias("head"))


@shipped
def components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (least doc_id reachable by links)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = packing.bucket_count(spark, total)
    texts, numbers = _own_numbers(docs.where("doc_id IS NOT NULL"))
    sent = texts.mapInArrow(_send(buckets, shingle, percent), _ROW).repartition(buckets, "bucket")
    shared = sent.mapInArrow(_count(buckets), _ROW).repartition(buckets, "bucket")
    met = scratch.write(shared.mapInArrow(_leave_out(buckets), _ROW), "setjoin-met")
    rows = met.where("kind = 0").select("doc_id", F.col("body").alias("digest"), F.col("size").alias("n_shingles"))

    # One document stands for all with the same set.
    classes = scratch.write(_with_heads(rows), "setjoin-classes")
    one = classes.groupBy("doc_id").agg(F.min("head").alias("head"))
    near = met.where("kind = 2").repartition(buckets, "bucket").mapInArrow(_meet(buckets), _ROW)
    near = near.repartition(buckets, "bucket").mapInArrow(_unite, "a long, b long")
    near = near.union(met.where("kind = 1").select("doc_id", "other")).distinct()
    near = near.join(one.toDF("a", "ha"), "a").join(one.toDF("b", "hb"), "b").select(F.col("ha").alias("a"), F.col("hb").alias("b"))
    clusters = graph.components(near).toDF("doc_id", "cluster")

    # Large clusters are cut by size first: only sets of neighbouring bands can be similar, so a set goes to
    # two groups at most.  Groups that are still large are cut into blocks, and every two blocks meet.
    sized = clusters.join(classes.where("doc_id = head").select("doc_id", "n_shingles").groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles")), "doc_id")
    top = classes.agg(F.coalesce(F.max("n_shingles"), F.lit(1))).first()[0]
    starts = F.array(*[F.lit(int(x)) for x in band_starts(top, percent)])
    band = F.size(F.filter(starts, lambda x: x <= F.col("n_shingles")))
    total = sized.groupBy("cluster").agg(F.sum("n_shingles").alias("_total"))
    groups = F.when(F.col("_total") < CLUSTER_SHINGLES, F.array(F.lit(0))).otherwise(F.array(band, band + 1))
    grouped = sized.join(total, "cluster").withColumn("part", F.explode(groups))
    load = grouped.groupBy("cluster", "part").agg(
        (F.floor(F.sum("n_shingles") / F.lit(CLUSTER_SHINGLES // 2)) + 1).cast("int").alias("blocks")
    )
    load = load.withColumn("blocks", F.when(F.col("blocks") <= 2, 1).otherwise(F.col("blocks")))
    where = grouped.select("doc_id", "cluster", "part").join(load, ["cluster", "part"])
    where = where.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    where = scratch.write(where, "setjoin-clusters")
    held = texts.join(_small(where), "doc_id")
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.expr("filter(sequence(0, blocks - 1), x -> x <> block)")))
    met_in = held.withColumn("other", other).select(
        "doc_id", "text", "cluster", "part", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")
    )
    parts = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = met_in.repartition(parts, "cluster", "part", "lo", "hi").sortWithinPartitions("cluster", "part", "lo", "hi")
    links = scratch.write(dealt.mapInArrow(_verify(shingle, percent), "a long, b long"), "setjoin-links")
    # Rows that share a doc_id share its class, and copies belong to their head.
    copies = classes.where("doc_id <> head").select(F.col("doc_id").alias("a"), F.col("head").alias("b"))
    found = graph.components(_true_ids(links.union(copies.distinct()), numbers, ["a", "b"]))
    scratch.drop(met, where)
    nulls = docs.where("doc_id IS NULL")
    out = _true_ids(classes, numbers, ["doc_id"]).join(found.toDF("doc_id", "component_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
    return out.union(_without_id(nulls, shingle))


def _without_id(docs: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BATCH_BYTES):
                n = pa.array(Sets(part.column("text"), shingle).sizes.astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), n, pa.nulls(len(n), pa.int64())], ["doc_id", "n_shingles", "component_id"])

    return docs.select("text").mapInArrow(run, "doc_id long, n_shingles long, component_id long")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document, that of the least doc_id, from each component; of rows with
    that doc_id, the one whose text hashes least.  Documents without doc_id stay."""
    found = components(docs, **options).where("doc_id = component_id").select(F.col("doc_id").alias("_id")).distinct()
    # All columns travel in one struct, so that none can clash.
    rows = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_key"), F.struct("*").alias("_row"))
    kept = rows.join(found, F.col("_doc") == F.col("_id"), "left_semi")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"))
    if not ids.isEmpty():
        once = kept.join(ids, F.col("_doc") == F.col("_id"), "left_anti")
        many = kept.join(ids, F.col("_doc") == F.col("_id"), "left_semi")
        # Rows that are equal under one doc_id: any of them.
        kept = once.union(many.groupBy("_doc").agg(F.min("_key").alias("_key"), F.min_by("_row", "_key").alias("_row")))
    return kept.union(rows.where("_doc IS NULL")).select("_row.*")
