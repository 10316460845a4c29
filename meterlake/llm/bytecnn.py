"""Quality classifier: a byte-level convolutional network in numpy.

A text is a row of symbols: its UTF-8 bytes.  Learned filters slide over the symbols; each chunk of two blocks (every block is in two chunks)
keeps the largest response of each filter; the mean over all chunks of the whole text goes
through one logistic unit.  A filter over one-hot symbols is a sum of table rows, so scoring is
a few lookups per byte.

Training: at most ``SAMPLE`` labelled rows, those of least md5, outside the held-out fold, and of
those as many as have ``SAMPLE_BYTES`` bytes together (the first always); about ``STEPS`` steps of Adam on
the logistic loss over all chunks of their whole texts.  Only these bounded rows reach the driver, as bytes;
responses are held for ``PIECE`` chunks at a time, however long a text is.
Training and scoring cover every byte of a text.

Defined cases: a null text counts as empty, which is one chunk of padding; labels that are null
or neither 0 nor 1 are left out, and of repeated labels of one doc_id the smaller counts; without
usable labels every score is 0.5; rows repeat as often as in ``docs``; other columns are kept by
``score`` unless they are named like its results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shipping import shipped
from meterlake.llm.wordhash import slices

SAMPLE = 4000
SAMPLE_BYTES = 24 << 20
STEPS = 1000
BATCH = 48
PIECE = 512
WIDTH = 6
FILTERS = 12
BLOCK = 128
PAD = 256
CUT = 0.3
FOLDS = 5
_SPAN = 1 << 19


@dataclass
class Network:
    taps: np.ndarray  # WIDTH x symbols x FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    def responses(self, symbols: np.ndarray) -> np.ndarray:
        """Filter responses at each position that has WIDTH symbols."""
        n = len(symbols) - WIDTH + 1
        total = np.take(self.taps[0], symbols[:n], axis=0)
        for k in range(1, WIDTH):
            total += np.take(self.taps[k], symbols[k : k + n], axis=0)
        return total

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        z = pooled @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def symbol_rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, one after another, and the bounds of each text; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.zeros(0, np.int16), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.astype(np.int16), offsets - offsets[0]


def _block_peaks(net: Network, symbols: np.ndarray) -> np.ndarray:
    """Largest response of each filter in each block of one text."""
    n = max(1, len(symbols))
    padded = np.full(n + WIDTH - 1, PAD, np.int16)
    padded[: len(symbols)] = symbols
    out = []
    for i in range(0, n, _SPAN):
        part = net.responses(padded[i : min(n, i + _SPAN) + WIDTH - 1])
        out.append(np.maximum.reduceat(part, np.arange(0, len(part), BLOCK), axis=0))
    return np.concatenate(out)


def _pool(net: Network, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Mean over chunks of the pooled, rectified responses, for each text."""
    sizes = np.diff(bounds)
    if len(symbols) > 4 * _SPAN:  # one very long text: block by block
        peaks = [_block_peaks(net, symbols[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        blocks = np.array([len(p) for p in peaks])
        peak = np.concatenate(peaks)
    else:
        room = np.maximum(sizes, 1) + WIDTH - 1
        place = np.concatenate(([0], np.cumsum(room)))
        padded = np.full(place[-1], PAD, np.int16)
        padded[np.arange(len(symbols)) + np.repeat(place[:-1] - bounds[:-1], sizes)] = symbols
        all_responses = net.responses(padded)
        blocks = -(-np.maximum(sizes, 1) // BLOCK)
        first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
        starts = np.repeat(place[:-1], blocks) + (np.arange(blocks.sum()) - np.repeat(first, blocks)) * BLOCK
        # Close each text, so that its last block does not take in the padding between texts.
        marks = np.empty(len(starts) + len(room), np.int64)
        order = np.arange(len(starts)) + np.repeat(np.arange(len(room)), blocks)
        marks[order] = starts
        closing = np.cumsum(blocks) + np.arange(len(room))
        marks[closing] = np.minimum(place[:-1] + np.maximum(sizes, 1), len(all_responses) - 1)
        peak = np.maximum.reduceat(all_responses, marks, axis=0)[order]
        last = order[-1]
        peak[-1] = all_responses[marks[last] : place[-2] + max(1, sizes[-1])].max(axis=0)
    peak = np.maximum(peak + net.bias, 0)
    first = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    chunk = peak.copy()
    tail = np.zeros(len(peak), bool)
    tail[first + blocks - 1] = True
    inner = np.flatnonzero(~tail)
    chunk[inner] = np.maximum(peak[inner], peak[inner + 1])
    # A text of several blocks has one chunk less than blocks.
    weight = np.where(tail & np.repeat(blocks > 1, blocks), 0.0, 1.0)
    return np.add.reduceat(chunk * weight[:, None], first, axis=0) / np.add.reduceat(weight, first)[:, None]


def _pieces(chunks: list[np.ndarray], most: int) -> Iterator[np.ndarray]:
    """The chunks of all texts, one after another, at most so many at a time."""
    held, n = [], 0
    for rows in chunks:
        for a in range(0, len(rows), most):
            part = rows[a : a + most]
            if n + len(part) > most:
                yield np.concatenate(held)
                held, n = [], 0
            held.append(part)
            n += len(part)
    yield np.concatenate(held)


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Network:
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.25, (WIDTH, PAD + 1, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.3, FILTERS).astype(np.float32), 0.0
    )
    params = [net.taps, net.bias, net.out, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(-(-STEPS * BATCH // len(texts))):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            docs = order[i : i + BATCH]
            chunks = [chunks_of(texts[d]) for d in docs]
            owner = np.repeat(np.arange(len(docs)), [len(c) for c in chunks])
            peaks, under = [], []
            for rows in _pieces(chunks, PIECE):
                span = rows.shape[1] - WIDTH + 1
                resp = np.take(params[0][0], rows[:, :span], axis=0)
                for k in range(1, WIDTH):
                    resp += np.take(params[0][k], rows[:, k : k + span], axis=0)
                at = resp.argmax(axis=1)
                peaks.append(np.take_along_axis(resp, at[:, None, :], 1)[:, 0])
                rows_at = np.arange(len(rows))[:, None]
                under.append(np.stack([rows[rows_at, at + k] for k in range(WIDTH)]))
            peak = np.concatenate(peaks) + params[1]
            symbols = np.concatenate(under, axis=1)  # under each filter at its peak: WIDTH x chunks x FILTERS
            live = peak > 0
            peak = np.where(live, peak, 0)
            share = 1 / np.bincount(owner, minlength=len(docs))
            pooled = np.zeros((len(docs), FILTERS), np.float32)
            np.add.at(pooled, owner, peak)
            pooled *= share[:, None].astype(np.float32)
            p = 1 / (1 + np.exp(-np.clip(pooled @ params[2] + params[3][0], -40, 40)))
            err = ((p - labels[docs]) / len(docs)).astype(np.float32)
            back = (err[owner] * share[owner].astype(np.float32))[:, None] * params[2] * live
            g_taps = np.zeros_like(params[0])
            which = np.broadcast_to(np.arange(FILTERS), peak.shape)
            for k in range(WIDTH):
                np.add.at(g_taps[k], (symbols[k], which), back)
            grads = [g_taps, back.sum(0), pooled.T @ err, np.array([err.sum()], np.float32)]
            step += 1
            for q, g, m, v in zip(params, grads, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                q -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(params[0], params[1], params[2], float(params[3][0]))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def chunks_of(text: bytes) -> np.ndarray:
    """All chunks of a text, each with the symbols that its last filters reach into."""
    width = 2 * BLOCK + WIDTH - 1
    n = max(1, -(-len(text) // BLOCK) - 1)
    padded = np.full((n - 1) * BLOCK + width, PAD, np.int16)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, width)[::BLOCK]


@shipped
def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network | None:
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    order = F.md5(F.col("doc_id").cast("string"))
    picked = known.orderBy(order, "doc_id").limit(sample)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_key"))
    # One text of each doc_id; sizes come first, at most ``sample`` rows of four numbers.
    near = texts.join(F.broadcast(picked), "doc_id")
    sized = near.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min(F.struct("text_key", F.octet_length("text").alias("n"))).alias("_t"))
    rows = sized.select("doc_id", "quality", "_t.text_key", "_t.n", order.alias("place")).collect()
    rows.sort(key=lambda r: (r["place"], r["doc_id"]))
    total = np.cumsum([r["n"] for r in rows])
    rows = [r for i, r in enumerate(rows) if i == 0 or total[i] <= SAMPLE_BYTES]
    if not rows:
        return None
    chosen = docs.sparkSession.createDataFrame([(r["doc_id"], r["text_key"]) for r in rows], "doc_id long, text_key long")
    found = texts.join(F.broadcast(chosen), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    # As bytes: a str takes up to four bytes a character.
    whole = {r["doc_id"]: bytes(r["text"]) for r in found.select("doc_id", F.col("text").cast("binary")).collect()}
    rows.sort(key=lambda r: r["doc_id"])
    return train([whole[r["doc_id"]] for r in rows], np.array([r["quality"] for r in rows], np.float32))


@shipped
def score(docs: DataFrame, net: Network | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    if net is None:
        return docs.select(*keep, F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                p = net.probability(_pool(net, *symbol_rows(part.column("text"))))
                cols = [part.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(p.astype(float)), pa.array((p >= CUT).astype(np.int32))], [*keep, "score", "predicted"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["score double", "predicted int"])
    return docs.select(*keep).mapInArrow(run, schema)


@shipped
def keep_good(docs: DataFrame, net: Network | None) -> DataFrame:
    """The rows of ``docs`` that the network does not reject, with all their columns."""
    if net is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                p = net.probability(_pool(net, *symbol_rows(part.column("text"))))
                yield part.filter(pa.array(p >= CUT))

    return docs.mapInArrow(run, docs.schema)
