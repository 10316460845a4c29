"""Approximate nearest neighbours by shifted space-filling curves, with exact rerank.

Equal vectors are searched once, as a class.  Vectors are dealt to bands of about equal norm
(factor ``BAND``, below the largest norm), and each band has curves of its own, so that long vectors
do not press the others together; a query asks every band.  In a band vectors are lifted so that the
largest inner product becomes the smallest angle (one more coordinate levels their norms), projected
at random to a few dimensions, shifted at random and put in the order of a Hilbert curve; this is done
for several curves.  Spark range-partitions each curve by key; runs of the order form blocks, a query
sees its own block and the two beside it, and the best of every block merge, each scored exactly on the
original vectors in double precision.  Bands too small for three blocks are searched whole, together.

The block is a share of the band, since what a curve keeps together is a share of the space; a
block with more than ``TASK_ROWS`` vectors is cut by hash and its queries go to every cut.  The
projections are scaled by the mean and spread of all vectors of the band.

Defined cases: vectors that are null, zero, or hold a null or non-finite component take no part;
shorter vectors count as padded with zeros; rows that repeat vec_id and vector count once, and one
vec_id with several vectors stands for each, without finding itself; null ids take no part; ties go to
the smaller vec_id; fewer candidates than ``k`` are all returned if they are found; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm import ordering, scratch
from meterlake.llm.sharding import _curve_steps
from meterlake.llm.shipping import shipped

CURVES = 26
DIMS, BITS = 6, 30
#: Bits of each dimension in one word of a key.
WORD_BITS = 10
BLOCK_SHARE, BLOCK_LEAST = 0.012, 200
TASK_ROWS = 50_000
#: Largest quotient of two norms in a band.
BAND = 1.25
NEAREST = 20
_CLOSE = 1e-9
_WORDS = [f"key{i}" for i in range(BITS // WORD_BITS)]


def usable(vector: str = "embedding") -> Column:
    return F.expr(
        f"{vector} IS NOT NULL AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        f" AND exists({vector}, x -> x <> 0)"
    )


class Curves:
    """Random projections and shifts, the same for a seed everywhere; each band has its own top norm and scale."""

    def __init__(self, width: int, tops: np.ndarray, curves: int = CURVES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.width, self.tops, self.count = width, tops, curves
        self.dims = min(DIMS, width + 1)
        self.steps = np.array(_curve_steps(self.dims), np.int64)
        turns = [(np.linalg.qr(rng.normal(size=(width + 1, self.dims)))[0], rng.random(self.dims)) for _ in range(curves)]
        self.axes, self.shift = np.stack([t[0] for t in turns]), np.stack([t[1] for t in turns])
        self.mean = self.spread = np.zeros((len(tops), curves, self.dims))

    def lift(self, x: np.ndarray, band: np.ndarray | None) -> np.ndarray:
        """Vectors as members of their bands, or as queries."""
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        if band is None:
            return np.hstack([x / norm, np.zeros_like(norm)])
        top = self.tops[band][:, None]
        return np.hstack([x / top, np.sqrt(np.maximum(0, 1 - (norm / top) ** 2))])

    def scale(self, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> None:
        """Take mean and spread from sums over each band; rounded, as sums depend on their order."""
        n = counts[:, None, None]
        self.mean = (sums / n).astype(np.float32).astype(float)
        self.spread = np.sqrt(np.maximum(0, squares / n - (sums / n) ** 2)).astype(np.float32).astype(float) + 1e-9

    def keys(self, seen: np.ndarray, band: np.ndarray | int, curve: int) -> list[np.ndarray]:
        """Place on the curve of projected vectors, the leading word first.

        The many bits also tell members of a tight group apart, however small a part of the range it fills."""
        z = (seen - self.mean[band, curve]) / self.spread[band, curve]
        level = 0.5 * (1 + np.tanh(0.8 * z))  # close to the normal distribution function
        cell = np.minimum((level + self.shift[curve]) / 2 * (1 << BITS), (1 << BITS) - 1).astype(np.int64)
        size = 1 << self.dims
        state, key, words = np.zeros(len(cell), np.int64), np.zeros(len(cell), np.int64), []
        for b in range(BITS - 1, -1, -1):
            octant = ((cell >> b & 1) << np.arange(self.dims)).sum(axis=1)
            found = self.steps[state * size + octant]
            key = key * size + found % size
            state = found // size
            if b % WORD_BITS == 0:
                words.append(key)
                key = np.zeros(len(cell), np.int64)
        return words


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    lengths = np.asarray(pc.list_value_length(column))
    values = np.asarray(column.flatten(), dtype=np.float64)
    if (lengths == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(column), width))
    row = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = values
    return out


def _moments(curves: Curves):
    """Sums and sums of squares of the projections, by band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        flat = np.concatenate(list(curves.axes), axis=1)
        for batch in batches:
            x, band = _matrix(batch.column("embedding"), curves.width), batch.column("band").to_numpy()
            seen = curves.lift(x, band) @ flat
            for b in np.unique(band).tolist():
                mine = seen[band == b]
                total[b] = total.get(b, 0) + np.stack([mine.sum(axis=0), (mine**2).sum(axis=0)])
        for b, (s, q) in total.items():
            n = len(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, b, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(s), pa.array(q)], ["band", "at", "s", "q"])

    return run


def _place(curves: Curves):
    """Per class and curve of its band its key.  A query has a row in every band, and one more where it is a
    member itself: among near-copies shorter than the band's top that is where its like are."""
    names = ["curve", *_WORDS, "h1", "h2", "is_query"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, band = _matrix(batch.column("embedding"), curves.width), batch.column("band").to_numpy()
            asks = np.asarray(batch.column("asks").to_numpy(zero_copy_only=False), bool)
            h1, h2 = batch.column("h1").to_numpy(), batch.column("h2").to_numpy()
            inside = np.flatnonzero(band >= 0)
            own = np.flatnonzero(asks[inside])
            held, asking = curves.lift(x[inside], band[inside]), curves.lift(x[asks], None)

            def rows(curve, words, at, is_query):
                hashes = [pa.array(h1[at]), pa.array(h2[at])]
                return pa.RecordBatch.from_arrays([pa.array(curve, pa.int32()), *map(pa.array, words), *hashes, pa.array(is_query)], names)

            for c in range(curves.count):
                words = curves.keys(held @ curves.axes[c], band[inside], c)
                at = np.concatenate((inside, inside[own]))
                yield rows(band[at] * curves.count + c, [np.concatenate((w, w[own])) for w in words], at, np.arange(len(at)) >= len(inside))
                seen, at = asking @ curves.axes[c], np.flatnonzero(asks)
                for b in range(len(curves.tops) if len(at) else 0):
                    yield rows(np.full(len(at), b * curves.count + c), curves.keys(seen, b, c), at, np.ones(len(at), bool))

    return run


def _best(query: np.ndarray, q_rows: np.ndarray, cand: np.ndarray, c_rows: np.ndarray, k: int):
    """(query row, candidate row, score) of the k best for each query, ties to the smaller row."""
    out = []
    for i in range(0, len(query), 256):
        scores = query[i : i + 256] @ cand.T
        if len(cand) > k:
            least = np.partition(scores, len(cand) - k, axis=1)[:, len(cand) - k]
            a, b = np.nonzero(scores >= (least - _CLOSE * (1 + np.abs(least)))[:, None])
        else:
            a, b = np.nonzero(np.ones_like(scores, bool))
        exact = (query[i + a] * cand[b]).sum(axis=1)
        out.append((q_rows[i + a], c_rows[b], exact))
    return [np.concatenate(x) for x in zip(*out)]


def _top(q: np.ndarray, c: np.ndarray, s: np.ndarray, k: int):
    """The k best different candidates of each query, ties to the smaller candidate."""
    order = np.lexsort((c, -s, q))
    q, c, s = q[order], c[order], s[order]
    fresh = np.ones(len(q), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
    q, c, s = q[fresh], c[fresh], s[fresh]
    head = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q))))
    keep = rank < k
    return q[keep], c[keep], s[keep]


def _rerank(width: int, k: int):
    """Rows come sorted by (curve, block, cut, query last); each run is one matrix product."""
    names = ["q_id", "q_h", "c_id", "c_h", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, int], int] = {}
        label: list[tuple[int, int]] = []
        held: list[list[np.ndarray]] = [[], [], []]

        def number(ids, hs) -> np.ndarray:
            out = np.empty(len(ids), np.int64)
            for i, x in enumerate(zip(ids, hs)):
                n = known.get(x)
                if n is None:
                    n = known[x] = len(label)
                    label.append(x)
                out[i] = n
            return out

        def solve(parts):
            rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            asks = rows.column("is_query").to_numpy(zero_copy_only=False)
            if not asks.any() or asks.all():
                return
            x = _matrix(rows.column("embedding"), width)
            ids, hs = rows.column("id").to_numpy(), rows.column("h1").to_numpy()
            names_ = np.arange(len(ids))
            order = np.lexsort((hs, ids))  # ties to the smaller id
            names_[order] = np.arange(len(ids))
            q, c, s = _best(x[asks], np.flatnonzero(asks), x[~asks], np.flatnonzero(~asks), k + 1)
            q, c, s = _top(q, names_[c], s, k + 1)
            c = order[c]
            for place, values in zip(held, (number(ids[q].tolist(), hs[q].tolist()), number(ids[c].tolist(), hs[c].tolist()), s)):
                place.append(values)

        def merged() -> pa.RecordBatch | None:
            if not held[0]:
                return None
            q, c, s = [np.concatenate(x) for x in held]
            ids = np.array([x[0] for x in label], np.int64)
            rank = np.empty(len(ids), np.int64)
            order = np.lexsort((np.array([x[1] for x in label], np.int64), ids))
            rank[order] = np.arange(len(ids))
            q, c, s = _top(q, rank[c], s, k + 1)
            c = order[c]
            hs = np.array([x[1] for x in label], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(hs[q]), pa.array(ids[c]), pa.array(hs[c]), pa.array(s)], names)

        key, parts = None, []
        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy() for n in ("curve", "block", "cut")], axis=1).astype(np.int64)
            cuts = np.concatenate(([0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                mine = tuple(keys[a])
                if parts and mine != key:
                    solve(parts)
                    parts = []
                key = mine
                parts.append(batch.slice(a, b - a))
            if sum(map(len, held[0])) > 2_000_000:
                out = merged()
                held[:] = [[], [], []]
                known.clear()
                label.clear()
                yield out
        if parts:
            solve(parts)
        out = merged()
        if out is not None:
            yield out

    return run


def _whole(banded: DataFrame, n: int) -> DataFrame:
    """Members of no band with curves, cut by hash, and every query to every cut: curve, block, cut, h1, h2, is_query."""
    cuts = -(-n // BLOCK_LEAST)
    here = [F.lit(-1).alias("curve"), F.lit(0).alias("block")]
    members = banded.where("band < 0").select(*here, F.pmod("h2", F.lit(max(1, cuts))).cast("int").alias("cut"), "h1", "h2", F.lit(False).alias("is_query"))
    every = F.sequence(F.lit(0), F.lit(cuts - 1)) if cuts else F.array().cast("array<int>")
    return members.union(banded.where("asks").select(*here, F.explode(every).alias("cut"), "h1", "h2", F.lit(True).alias("is_query")))


def _near(banded: DataFrame, turns: Curves, bands: list, asking: int, share: float) -> DataFrame:
    """Blocks of the curves with their members, and the queries that see them: curve, block, cut, h1, h2, is_query."""
    keys = ", ".join(f"{w} long" for w in _WORDS)
    placed = banded.mapInArrow(_place(turns), f"curve int, {keys}, h1 long, h2 long, is_query boolean")
    sizes, first = [], 0
    for i, r in enumerate(bands):
        per_curve, block_rows = r["n"] + r["own"] + asking, max(BLOCK_LEAST, int(share * r["n"]))
        sizes.append((i, first, per_curve, block_rows, (per_curve - 1) // block_rows, -(-block_rows // TASK_ROWS)))
        first += per_curve * turns.count
    # Ties are in another order on each curve, so that each shows a query others of a crowded cell.
    order = [F.col("curve"), *map(F.col, _WORDS), F.xxhash64("curve", "h1", "h2"), F.col("is_query")]
    placed = ordering.positions(placed, order, {}, rows=first)
    sizes = placed.sparkSession.createDataFrame(sizes, "band int, first long, per_curve long, block_rows long, last int, cuts int")
    placed = placed.withColumn("band", F.floor(F.col("curve") / turns.count).cast("int")).join(F.broadcast(sizes), "band")  # one row per band
    placed = placed.withColumn("block", F.floor((F.col("_before") - F.col("first")) % F.col("per_curve") / F.col("block_rows")).cast("int"))
    near = F.when(F.col("is_query"), F.filter(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.col("block") + d), lambda b: (b >= 0) & (b <= F.col("last")))).otherwise(F.array("block"))
    cut = F.when(F.col("is_query"), F.sequence(F.lit(0), F.col("cuts") - 1)).otherwise(F.array(F.pmod("h2", "cuts").cast("int")))
    sent = placed.withColumn("near", near).select("curve", F.explode("near").alias("block"), "h1", "h2", "is_query", cut.alias("cut"))
    return sent.withColumn("cut", F.explode("cut"))


@shipped
def search(vectors: DataFrame, is_query: Column, k: int = NEAREST, curves: int = CURVES, share: float = BLOCK_SHARE) -> DataFrame:
    """query_id, rank, vec_id, score: for each query row the nearest other ids that are found."""
    spark = vectors.sparkSession
    h1, h2 = F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), F.col("embedding")).alias("h2")
    good = vectors.where("vec_id IS NOT NULL").where(usable()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("asks"), h1, h2)
    # Of each class of equal vectors: its least id, and as many ids as an answer can need.
    by = Window.partitionBy("h1", "h2").orderBy("vec_id")
    ids = good.select("vec_id", "h1", "h2").distinct().withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= k + 1).drop("_r")
    ids = scratch.write(ids, "ann-ids")
    classes = good.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.max("asks").alias("asks"), F.min_by("embedding", "vec_id").alias("embedding"))
    classes = scratch.write(classes, "ann-classes")
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, width, top, asking = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding")), F.max(F.sqrt(square)), F.count_if("asks")).first()
    shape = "query_id long, rank int, vec_id long, score double"
    if not n or not asking:
        return spark.createDataFrame([], shape)
    # Bands of norms, counted from the longest; those that hold more than three blocks get curves.
    step = F.floor(F.log(F.lit(top) / F.sqrt(square)) / math.log(BAND))
    counted = classes.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(square)).alias("top"), F.count_if("asks").alias("own"))
    bands = [r for r in counted.orderBy("step").collect() if r["step"] is not None and r["n"] > 3 * BLOCK_LEAST]
    number = spark.createDataFrame([(r["step"], i) for i, r in enumerate(bands)], "step long, band int")
    banded = classes.withColumn("step", step).join(F.broadcast(number), "step", "left")  # one row per band
    banded = banded.select("embedding", "asks", "h1", "h2", F.coalesce("band", F.lit(-1)).alias("band"))
    sent = _whole(banded, n - sum(r["n"] for r in bands))
    if bands:
        turns = Curves(width, np.array([r["top"] for r in bands]) * (1 + 1e-9), curves)
        sums = banded.where("band >= 0").select("embedding", "band").mapInArrow(_moments(turns), "band int, at int, s double, q double")
        sums = sums.groupBy("band", "at").agg(F.sum("s").alias("s"), F.sum("q").alias("q")).collect()
        moments = np.zeros((2, len(bands), curves * turns.dims))
        for r in sums:
            moments[:, r["band"], r["at"]] = r["s"], r["q"]
        turns.scale(np.array([r["n"] for r in bands]), *moments.reshape(2, len(bands), curves, turns.dims))
        sent = sent.unionByName(_near(banded, turns, bands, asking, share))
    sent = sent.join(classes.select("h1", "h2", "id", "embedding"), ["h1", "h2"])
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = sent.repartitionByRange(parts, "curve", "block", "cut").sortWithinPartitions("curve", "block", "cut")
    found = dealt.select("curve", "block", "cut", "is_query", "id", "h1", "embedding").mapInArrow(_rerank(width, k), "q_id long, q_h long, c_id long, c_h long, score double")
    found = found.distinct()
    best = Window.partitionBy("q_id", "q_h").orderBy(F.desc("score"), "c_id", "c_h")
    found = found.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k + 1).drop("_r")

    # From classes back to ids: every asking row, against the ids of the classes found.  The h1 of a
    # class with its least id tells it apart.
    asked = good.where("asks").select(F.col("vec_id").alias("query_id"), "h1", "h2").distinct()
    asked = asked.join(classes.select("h1", "h2", F.col("id").alias("q_id")), ["h1", "h2"]).select("query_id", "q_id", F.col("h1").alias("q_h"))
    members = ids.join(classes.select("h1", "h2", F.col("id").alias("c_id")), ["h1", "h2"]).select(F.col("vec_id"), "c_id", F.col("h1").alias("c_h"))
    wide_ = asked.join(found, ["q_id", "q_h"]).join(members, ["c_id", "c_h"]).where("vec_id <> query_id")
    wide_ = wide_.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return wide_.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
