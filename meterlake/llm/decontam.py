"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

A document is contaminated by an item if some passage of it is within n // 5 word edits (insert,
delete, replace) of the item's n words, compared with A-Z lower-cased: similarity 0.8 or more.

The CGK embedding walks over a word sequence: at each step it emits the word under the pointer,
and a random bit of (step, word) says whether the pointer moves on.  Sequences at small edit
distance fall back into step, so their walks differ in few places and a few sampled places agree
with known probability.  Walks start at every word of a document, for every length class of items.
How many samples are drawn is calibrated on the items themselves: copies at the largest allowed
distance have to be found with the target recall.  Long items are cut into parts with walks of their
own: of a passage within n // 5 edits at least one part is within its share.  Windows that meet an item are verified exactly,
by the best fit of the item into the passage around them.

Before walking, windows are screened by a condition every match satisfies: at most n // 5 of its
words, and twice as many of its word pairs, are foreign to all items (an edit makes at most one
new word and two new pairs).  That loses nothing, and leaves few windows in ordinary text.

The items are a query set of stated size: they are read in blocks (by bytes and by number, in
order of item_id), and each block is matched against all documents in one pass without a shuffle.

Defined cases: null and wordless texts match nothing, nor do null and wordless items; items too
short for an edit match word for word; repeated documents and items give a result each;
documents without doc_id are judged like others; empty tables give empty results; other columns
are kept by ``clean_documents`` and ignored by ``matches``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shipping import shipped
from meterlake.llm.wordhash import Words, mix, slices

#: Items of a block, and their bytes: what is sent to the executors at once.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20
BATCH_BYTES = 4 << 20
RECALL = 0.97
#: Words sampled per digest, and the walks that samples are drawn from.
SAMPLED, WALKS = 2, 6
_TABLE_BITS = 22
#: Words of a part, at most, and samples after which further walks are drawn from.
PART_WORDS = 100
_FIRST_SAMPLES, _WALK_SAMPLES = 96, 16
_ODD = 0x9E3779B97F4A7C15
_STEP = np.uint64(_ODD)


def edit_limit(words: int) -> int:
    return words // 5


@dataclass
class LengthClass:
    least: int
    most: int
    members: list[int]  # numbers of its parts
    samples: list[tuple[int, tuple[int, ...]]]  # (walk, steps)
    keys: list[np.ndarray]  # per sample: sorted digests of the members
    owners: list[np.ndarray]  # per sample: the member of each digest

    @property
    def steps(self) -> int:
        return walk_steps(self.least)


def walk_steps(least: int) -> int:
    """Steps in which a walk of about half a word per step stays inside the shortest item."""
    return max(1, int(1.8 * least))


def emitted(words: np.ndarray, start: np.ndarray, end: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """Words under the pointer of walks from ``start``, by step; 0 beyond ``end``."""
    pointer = start.copy()
    out = np.zeros((steps, len(start)), np.uint64)
    padded = np.append(words, np.uint64(0))
    for t in range(steps):
        here = padded[np.where(pointer < end, pointer, len(words))]
        out[t] = here
        bit = mix(here ^ (np.uint64((walk * 1_000_003 + t + 1) * _ODD % 2**64))) & np.uint64(1)
        pointer = pointer + bit.astype(np.int64)
    return out


def sample_digest(trail: np.ndarray, steps: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(trail.shape[1], np.uint64)
    for t in steps:
        out = mix(out + trail[t] + _STEP)
    return out


def _edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    out = words.tolist()
    for _ in range(edits):
        at, kind = int(rng.integers(len(out) + 1)), int(rng.integers(3))
        fresh = int(rng.integers(1, 1 << 62))
        if kind == 0 or at == len(out):
            out.insert(at, fresh)
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out[at] = fresh
    return np.array(out, np.uint64)


def _calibrate(items: list[np.ndarray], least: int, recall: float) -> list[tuple[int, tuple[int, ...]]]:
    """Samples that find ``recall`` of random copies at the largest allowed distance."""
    rng = np.random.default_rng(least)
    steps = walk_steps(least)
    size = min(SAMPLED, steps)
    trials = []
    for i in range(120):
        item = items[i % len(items)]
        trials.append((item, _edited(item, edit_limit(len(item)), rng)))
    both = [w for pair in trials for w in pair]
    flat = np.concatenate(both)
    ends = np.cumsum([len(w) for w in both])
    starts = ends - [len(w) for w in both]
    trails: dict[int, np.ndarray] = {}
    missed = np.ones(len(trials), bool)
    samples: list[tuple[int, tuple[int, ...]]] = []
    while missed.mean() > 1 - recall:
        more = len(samples) - _FIRST_SAMPLES
        walk = len(samples) % WALKS if more < 0 else WALKS + more // _WALK_SAMPLES
        if walk not in trails:
            trails[walk] = emitted(flat, starts, ends, walk, steps)
        # Early steps agree more often than late ones; half of the samples come from the first half.
        reach = steps if len(samples) % 2 else max(size, steps // 2)
        chosen = tuple(sorted(rng.choice(reach, size, replace=False).tolist()))
        digest = sample_digest(trails[walk], chosen)
        missed &= digest[0::2] != digest[1::2]
        samples.append((walk, chosen))
    return samples


def _slot(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def _pair(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one."""
    return mix(words[:-1] * np.uint64(0xD1342543DE82EF95) + words[1:])


class Index:
    """Samples and digests of a block of items, by length class."""

    def __init__(self, ids: list, texts: list[str | None], recall: float = RECALL):
        words = Words(pa.array(texts, pa.large_string()), lower=True)
        hashed = words.hashes() | np.uint64(1)
        self.ids = ids
        self.items = [hashed[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[_slot(hashed)] = True
        self.parts: list[np.ndarray] = []
        self.part_of: list[tuple[int, int]] = []  # per part its item, and the words before it
        for i, x in enumerate(self.items):
            cuts = np.linspace(0, len(x), -(-len(x) // PART_WORDS) + 1).astype(int)
            self.parts += [x[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            self.part_of += [(i, int(a)) for a in cuts[:-1]]
        lengths = sorted({len(x) for x in self.parts})
        # Pairs of neighbouring words of one item.
        self.pairs = np.zeros(1 << _TABLE_BITS, bool)
        for x in self.items:
            self.pairs[_slot(_pair(x))] = True
        self.classes = []
        while lengths:
            least = lengths[0]
            most = max(n for n in lengths if n <= max(least, int(least * 1.1)))
            lengths = [n for n in lengths if n > most]
            members = [i for i, x in enumerate(self.parts) if least <= len(x) <= most]
            mine = [self.parts[i] for i in members]
            samples = _calibrate(mine, least, recall)
            flat = np.concatenate(mine)
            ends = np.cumsum([len(x) for x in mine])
            starts = ends - [len(x) for x in mine]
            trails = {w: emitted(flat, starts, ends, w, walk_steps(least)) for w in {s[0] for s in samples}}
            keys, owners = [], []
            for walk, steps in samples:
                digest = sample_digest(trails[walk], steps)
                order = np.argsort(digest, kind="stable")
                keys.append(digest[order])
                owners.append(np.array(members)[order])
            self.classes.append(LengthClass(least, most, members, samples, keys, owners))
        self.vocabulary = [np.unique(x) for x in self.items]

    def candidates(self, hashed: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(start word, part) pairs whose walks agree in a sample, passing the part's own words."""
        n = len(hashed)
        foreign = np.concatenate(([0], np.cumsum(~self.table[_slot(hashed)], dtype=np.int32)))
        new_pairs = np.concatenate(([0], np.cumsum(~self.pairs[_slot(_pair(hashed))], dtype=np.int32))) if n else foreign
        found = []
        for c in self.classes:
            span = max(1, c.least - edit_limit(c.least))
            if n < span:
                continue
            limit = edit_limit(c.most)
            ok = foreign[span:] - foreign[:-span] <= limit
            ok &= new_pairs[span - 1 :] - new_pairs[: n - span + 1] <= 2 * limit
            start = np.flatnonzero(ok)
            if not len(start):
                continue
            end = first[np.searchsorted(first, start, side="right")]
            inside = start + span <= end
            start, end = start[inside], end[inside]
            for i in range(0, len(start), 200_000):
                s, e = start[i : i + 200_000], end[i : i + 200_000]
                trails: dict[int, np.ndarray] = {}
                for (walk, steps), keys, owners in zip(c.samples, c.keys, c.owners):
                    if walk not in trails:
                        trails[walk] = emitted(hashed, s, e, walk, c.steps)
                    digest = sample_digest(trails[walk], steps)
                    a, b = np.searchsorted(keys, digest, "left"), np.searchsorted(keys, digest, "right")
                    hit = np.flatnonzero(b > a)
                    if len(hit):
                        times = b[hit] - a[hit]
                        which = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(a[hit], times)
                        found.append(np.stack([np.repeat(s[hit], times), owners[which]], axis=1))
        if not found:
            return np.zeros((0, 2), np.int64)
        return np.unique(np.concatenate(found), axis=0)

    def matches(self, texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
        """(row, item number, distance, start word, end word) of the best fit per row and item."""
        words = Words(texts, lower=True)
        hashed = words.hashes() | np.uint64(1)
        pairs = self.candidates(hashed, words.first)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        if not len(pairs):
            return []
        row = np.searchsorted(words.first, pairs[:, 0], side="right") - 1
        part_of = np.array(self.part_of)[pairs[:, 1]]
        begin = pairs[:, 0] - part_of[:, 1]  # where the item would begin
        order = np.lexsort((begin, part_of[:, 0], row))
        done: tuple[int, int] | None = None
        reach = -1
        for k in order:
            start, item, r = int(begin[k]), int(part_of[k, 0]), int(row[k])
            n, limit = len(self.items[item]), edit_limit(len(self.items[item]))
            part = len(self.parts[pairs[k, 1]])
            slack = limit + (edit_limit(part) if part < n else 0)
            low, high = int(words.first[r]), int(words.first[r + 1])
            if done != (r, item):
                done, reach = (r, item), -1
            if min(high, start + n + slack) <= reach:  # inside a passage that was fitted already
                continue
            a, b = max(low, start - slack), min(high, start + n + slack)
            held = np.isin(hashed[a:b], self.vocabulary[item], assume_unique=False)
            if int(held.sum()) < n - limit:
                continue
            # One fit covers the starts that follow closely.
            b = min(high, b + 2 * n)
            reach = b
            distance, s, e = best_fit(self.items[item], hashed[a:b])
            if distance <= limit:
                here = (distance, a + s - low, a + e - low)
                best[r, item] = min(best.get((r, item), here), here)
        return [(r, i, *v) for (r, i), v in sorted(best.items())]


def best_fit(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to a part of ``passage``, and the bounds of that part."""

    def ends(x: np.ndarray, y: np.ndarray, free: bool) -> np.ndarray:
        place = np.arange(len(y) + 1)
        row = np.zeros(len(y) + 1, np.int64) if free else place.copy()
        for w in x:
            nxt = row + 1
            nxt[1:] = np.minimum(nxt[1:], row[:-1] + (y != w))
            row = np.minimum.accumulate(nxt - place) + place
        return row

    forward = ends(item, passage, True)
    end = int(forward.argmin())
    back = ends(item[::-1], passage[:end][::-1], False)
    return int(forward[end]), end - int(back.argmin()), end


def blocks(bench: DataFrame) -> Iterator[Index]:
    """Indexes of the items, block by block; only one block is on the driver at a time."""
    items = bench.where("text IS NOT NULL").select("item_id", "text", F.octet_length("text").alias("n"))
    rows, held = [], 0
    for r in items.orderBy("item_id", "text").toLocalIterator():
        if rows and (len(rows) >= BLOCK_ITEMS or held + r["n"] > BLOCK_BYTES):
            yield Index([x[0] for x in rows], [x[1] for x in rows])
            rows, held = [], 0
        rows.append((r["item_id"], r["text"]))
        held += r["n"]
    if rows:
        yield Index([x[0] for x in rows], [x[1] for x in rows])


_FOUND = "doc_id long, item_id long, distance int, item_words int, start_word long, end_word long"


@shipped
def matches(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """Per contaminated row and item: doc_id, item_id, distance, item_words, start_word, end_word."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in blocks(bench):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            names = ["doc_id", "item_id", "distance", "item_words", "start_word", "end_word"]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            for batch in batches:
                for part in slices(batch, "text", BATCH_BYTES):
                    found = index.matches(part.column("text"))
                    ids = part.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                    cols = [[index.ids[f[1]] for f in found], [f[2] for f in found], [len(index.items[f[1]]) for f in found], [f[3] for f in found], [f[4] for f in found]]
                    yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, k) for c, k in zip(cols, kinds)]], names)

        part = texts.mapInArrow(run, _FOUND)
        out = part if out is None else out.union(part)
    return docs.sparkSession.createDataFrame([], _FOUND) if out is None else out


@shipped
def clean_documents(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item matches, with all their columns."""
    for index in blocks(bench):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text", BATCH_BYTES):
                    keep = np.ones(len(part), bool)
                    keep[[f[0] for f in index.matches(part.column("text"))]] = False
                    yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
