import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import impact_index

SCHEMA = "vec_id long, embedding array<float>, label int"
TOP = (1 << 63) - 1


def brute(rows, k=5, every=50):
    seen, usable = set(), []
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = tuple(math.floor(256 * float(np.float32(x))) for x in v)
        key = (i, tuple(np.float32(x).item() for x in v))
        if key not in seen:
            seen.add(key)
            usable.append((i, w))
    out = []
    for i, q in usable:
        if i % every == 0:
            scored = [(max(-TOP - 1, min(TOP, sum(a * b for a, b in zip(q, w)))), j) for j, w in usable if j != i]
            best = sorted(scored, key=lambda s: (-s[0], s[1]))[:k]
            out += [(i, r, j, s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out)


def found(df, k=5, every=50, **kw):
    rows = impact_index.search(df, F.col("vec_id") % every == 0, k=k, **kw).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    plain = rng.normal(size=(500, 16))
    plain /= np.linalg.norm(plain, axis=1, keepdims=True)
    plain[100:180] = plain[100]  # copies
    plain[200:260] = plain[200] + rng.normal(size=(60, 16)) * 0.002  # near copies
    plain[300:310] = 0
    plain[320] *= 1000
    return [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(plain)]


@pytest.mark.parametrize("shard_rows", [64, 10_000])
def test_against_all_products(spark, vectors, shard_rows):
    df = spark.createDataFrame(vectors, SCHEMA).repartition(4)
    assert found(df, shard_rows=shard_rows) == brute(vectors)
    assert found(df, k=40, every=100, shard_rows=shard_rows) == brute(vectors, 40, 100)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], 0), (50, [-1.0], 0), (100, [], 0), (1, None, 0), (2, [1.0, None], 0), (3, [nan, 1.0], 0), (4, [inf, 1.0], 0),
        (None, [1.0, 1.0], 0), (5, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (5, [2.0, 2.0], 0), (6, [0.0, 0.0, 5.0], 0), (7, [1e30, 1.0], 0),
        (8, [-1e30, -1.0], 0), (9, [3e8, 0.0], 0), (150, [1e30, -1e30, 2.0], 0), (-50, [0.001, -0.001], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("kind", "shard", "key", "vector", "score", "rank")})
    assert found(df) == brute(rows)
    assert found(df, k=100) == brute(rows, 100)


def test_few_vectors_and_none(spark):
    rows = [(0, [1.0, 2.0], 0), (1, [1.0, 0.0], 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute(rows)
    assert found(df.where("vec_id = 0")) == [] and found(df.where("false")) == []
    assert found(df.where("vec_id = 1")) == []


def test_stops_before_all_postings():
    """Heavy-tailed components: a few segments prove the rest away."""
    rng = np.random.default_rng(1)
    rows = np.floor(rng.standard_t(1.3, size=(20_000, 32)).clip(-10**4, 10**4) * 20)
    index = impact_index.Index(np.arange(20_000), rows)
    for q in range(0, 20_000, 1000):
        ids, score = index.search(q, rows[q], 5)
        exact = (rows @ rows[q]).astype(np.int64)
        exact[q] = -TOP
        best = np.lexsort((np.arange(20_000), -exact))[:5]
        assert ids.tolist() == best.tolist() and score.tolist() == exact[best].tolist()
    assert index.taken < 0.15 * 20 * rows.size and index.scored < 0.15 * 20 * len(rows)


def test_unstructured_vectors_still_save_work():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(20_000, 64))
    rows = np.floor(rows / np.linalg.norm(rows, axis=1, keepdims=True) * 256)
    index = impact_index.Index(np.arange(20_000), rows)
    for q in range(0, 20_000, 2000):
        ids, score = index.search(q, rows[q], 5)
        exact = (rows @ rows[q]).astype(np.int64)
        exact[q] = -TOP
        assert ids.tolist() == np.lexsort((np.arange(20_000), -exact))[:5].tolist()
    assert index.taken + 64 * impact_index._FULL * index.scored < 0.9 * 10 * rows.size
