"""Exact top-k by integer inner product, from an impact-ordered index read score at a time.

Each component of a vector is a posting of its dimension with an integer impact, ``floor(scale * x)``.
The vectors are dealt to shards by a hash of their id; a shard's index holds, for each dimension, its
postings in the order of impact, so that the postings of one impact form a segment.  A query takes the
segments of all dimensions together by descending size of what they add to a score, query component times
impact, and adds them to one accumulator per vector.  Both signs count: after each level no posting that
is left adds or takes more than the level, so a vector's score lies within (level x postings it has left) of its
accumulator.  The vectors with the best accumulators are scored in full, which gives a k-th best score that is
real; a vector whose bound lies below it is out, for sure.  The query stops once scoring all possible
members in full costs less than the next level, or no posting is left.  The rest is exact: ``rescored`` scores
are those of whole vectors, and what is left out is proven to be lower.

Every shard sees every query of a stated query set; queries stream past the index, which is all that a
task holds.  A query's best of all shards merge in one ranking of k rows a shard.  Vectors without structure need
most of their postings; with a few large components, few.

Defined cases: vectors null or holding a null or non-finite component take no part, nor do rows without
an id; zero and empty vectors score 0; shorter vectors count as padded with zeros; rows that repeat id and vector count once;
one id with several vectors is a candidate and a query with each, and never finds its own id; components beyond
2**24 after scaling are scored in whole numbers of any size; scores beyond a long end at its bounds, and rank
as such; ties go to the smaller id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.shipping import ship

SCALE, NEAREST = 256, 5
#: Vectors of a shard at most, and of one that is not worth cutting for more tasks.
SHARD_ROWS, SMALL_SHARD = 65_536, 8_192
#: Impacts up to here are indexed: products of 2**10 such components add up below 2**63.
LARGEST = 1 << 24
#: From level to level, and what scoring a component in full costs in postings.
_STEP, _FULL = 0.6, 0.25


def usable(vector: str) -> Column:
    """No null and no component that is not finite, before and after scaling."""
    return F.expr(f"{vector} IS NOT NULL AND forall({vector}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(double(x) * {SCALE}) < double('Infinity'))")


def impacts(vectors: pa.Array, width: int) -> np.ndarray:
    """One row of doubles, whole numbers, per vector."""
    size = np.diff(np.asarray(vectors.offsets))
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    out = np.zeros((len(vectors), width))
    row = np.repeat(np.arange(len(vectors)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def whole_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in integers of any size, ended at the bounds of a long."""
    q = [int(x) for x in query]
    top = (1 << 63) - 1
    return np.array([max(-top - 1, min(top, sum(int(x) * y for x, y in zip(r, q)))) for r in rows], np.int64)


class Index:
    """Postings of a shard by dimension and impact."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        n, self.width = self.rows.shape
        huge = np.abs(self.rows).max(axis=1, initial=0) > LARGEST
        self.huge = np.flatnonzero(huge)  # too large to add in machine numbers: always scored in full
        self.span = 2 * LARGEST + 2
        impact = np.where(huge[:, None], 0, self.rows).astype(np.int64)
        self.post = np.argsort(impact, axis=0, kind="stable").astype(np.int32).T.reshape(-1)
        sorted_ = np.take_along_axis(impact.T, self.post.reshape(self.width, n).astype(np.int64), axis=1) if n else impact.T
        self.base = np.arange(self.width) * self.span
        self.key = (sorted_ + self.base[:, None]).reshape(-1)  # ascends over all dimensions
        self.most = np.abs(sorted_).max(axis=1, initial=0)
        self.taken = self.scored = 0  # postings read and vectors scored in full, for measurements

    def _cuts(self, query: np.ndarray, used: np.ndarray, level: float) -> np.ndarray:
        """Per used dimension: postings up to the first bound, and from the second, add at least ``level``."""
        least = np.minimum(np.ceil(level / np.abs(query[used])), LARGEST + 1).astype(np.int64)
        return np.stack([
            np.searchsorted(self.key, self.base[used] - least, side="right"), np.searchsorted(self.key, self.base[used] + least, side="left"),
        ])

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows with another id, best first."""
        n = len(self.ids)
        mine = np.zeros(n, bool)
        mine[np.searchsorted(self.ids, own, side="left") : np.searchsorted(self.ids, own, side="right")] = True
        if np.abs(query).max(initial=0) > LARGEST:
            return self._best(np.flatnonzero(~mine), query, k, whole=True)
        used = np.flatnonzero((query != 0) & (self.most > 0))
        total, left = np.zeros(n), np.full(n, float(len(used)))
        total[mine] = -np.inf
        total[self.huge] = -np.inf
        floor = -np.inf  # a score that k rows reach
        possible = np.flatnonzero(~mine)
        if len(used):
            level = float((np.abs(query[used]) * self.most[used]).max())
            edge = np.stack([used * n, (used + 1) * n])  # nothing is taken yet
            cut = self._cuts(query, used, level)
            while True:
                start = np.concatenate((edge[0], cut[1]))
                size = np.concatenate((cut[0] - edge[0], edge[1] - cut[1]))
                at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                row = self.post[at]
                weight, base = np.tile(query[used], 2), np.tile(self.base[used], 2)
                total += np.bincount(row, (self.key[at] - np.repeat(base, size)) * np.repeat(weight, size), n)
                left -= np.bincount(row, minlength=n)
                self.taken += len(at)
                edge = cut
                if n > k:
                    lead = np.argpartition(total, n - min(n, 4 * k))[n - min(n, 4 * k) :]
                    lead = lead[np.isfinite(total[lead])]
                    if len(lead) >= k:
                        floor = max(floor, np.partition(self.rows[lead] @ query, len(lead) - k)[len(lead) - k])
                        self.scored += len(lead)
                possible = np.flatnonzero(total + left * level >= floor)
                possible = possible[np.isfinite(total[possible])]
                if level <= 1:
                    break
                level = max(1.0, level * _STEP)
                cut = self._cuts(query, used, level)
                ahead = int((cut[0] - edge[0]).sum() + (edge[1] - cut[1]).sum())
                if len(possible) * self.width * _FULL <= ahead:
                    break
            possible = np.union1d(possible, self.huge[~mine[self.huge]])
        return self._best(possible, query, k)

    def _best(self, at: np.ndarray, query: np.ndarray, k: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        self.scored += len(at)
        if whole or np.isin(at, self.huge).any():
            score = whole_products(self.rows[at], query)
        else:
            score = self.rows[at].astype(np.int64) @ query.astype(np.int64)
        order = np.lexsort((self.ids[at], ~score))[:k]  # ~x is -x - 1: it falls as x grows, without overflow
        return self.ids[at[order]], score[order]


_FOUND = "query_id long, query_key long, vec_id long, score long"


def _search(width: int, k: int):
    """Rows come sorted by (shard, kind): the vectors of a shard, then all queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, ids, rows, index = None, [], [], None
        for batch in batches:
            number = batch.column("shard").to_numpy()
            kind = batch.column("kind").to_numpy()
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(number)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if number[a] != shard:
                    shard, ids, rows, index = number[a], [], [], None
                vectors = impacts(part.column("vector"), width)
                if kind[a] == 0:
                    ids.append(part.column("vec_id").to_numpy())
                    rows.append(vectors)
                    continue
                if index is None:
                    if not ids:
                        continue
                    index = Index(np.concatenate(ids), np.concatenate(rows))
                    ids, rows = [], []
                out = []
                for own, key, query in zip(part.column("vec_id").to_pylist(), part.column("key").to_pylist(), vectors):
                    found, score = index.search(own, query, k)
                    out.append((np.full(len(found), own), np.full(len(found), key), found, score))
                cols = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["query_id", "query_key", "vec_id", "score"])

    return run


def search(vectors: DataFrame, is_query: Column, vector: str = "embedding", k: int = NEAREST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best candidates of every row that ``is_query`` holds for."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.withColumn("_asks", is_query).where("vec_id IS NOT NULL").where(usable(vector))
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"), F.coalesce("_asks", F.lit(False)).alias("asks"))
    n, width, ids = rows.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.count_distinct("vec_id")).first()
    if ids < n:  # some id repeats
        rows = rows.dropDuplicates(["vec_id", "vector"])
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-n // shard_rows), min(tasks, -(-n // SMALL_SHARD)))
    held = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), "vec_id", F.lit(0).cast("long").alias("key"), "vector")
    asked = rows.where("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", F.xxhash64("vector").alias("key"), "vector"
    )
    met = held.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    found = met.mapInArrow(_search(width or 0, k), _FOUND)
    by = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
