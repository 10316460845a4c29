import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import neighbours

def brute(rows, k):
    good = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max(map(lambda r: len(r[1]), good))
    full = [(i, np.pad(np.array(v, np.float32).astype(float), (0, width - len(v)))) for i, v in good]
    out = {}
    for i, q in full:
        if i % 20 == 0:
            best = {}
            for j, v in full:
                if j != i:
                    best[j] = max(best.get(j, -1e9), float((q * v).sum()))
            for j, s in best.items():
                old = out.setdefault(i, {})
                old[j] = max(old.get(j, -1e9), s)
    return {i: sorted(b.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k] for i, b in out.items()}


def found(spark, rows, k=20, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("id", "h1", "rank", "asks", "block")})
    out = {}
    for r in neighbours.search(df.repartition(4), F.col("vec_id") % 20 == 0, k, **kw).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.2, 3)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[20][1]) for i in range(60)]  # copies of a query, more than an answer holds
    rows += [(40, rows[41][1]), (40, rows[41][1]), (500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None]), (504, [float("nan")] * 8), (505, [float("inf")] * 8)]
    rows += [(None, [1.0] * 8), (520, [0.5, 0.5])]
    got, wanted = found(spark, rows), brute(rows, 20)
    assert got.keys() == wanted.keys()
    for i in wanted:
        assert [j for j, _ in got[i]] == [j for j, _ in wanted[i]], i
        assert np.allclose([s for _, s in got[i]], [s for _, s in wanted[i]], atol=1e-9)


def test_recall(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(6000, 32)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    monkeypatch.setattr(neighbours, "TASK_ROWS", 60)
    got = found(spark, rows, 20)
    hits = 0
    for i in range(0, 6000, 20):
        s = x.astype(float) @ x[i].astype(float)
        s[i] = -1e9
        hits += len(set(np.argsort(-s)[:20].tolist()) & {j for j, _ in got[i]})
    assert hits / (300 * 20) >= 0.9


@pytest.mark.parametrize("rows", [[], [(1, [1.0])], [(20, [1.0])], [(20, None)]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows) == {}


def recall(spark, x, queries, **kw):
    """Mean recall of the given queries at 20 neighbours."""
    number = np.arange(len(x)) * 20 + 1
    number[queries] -= 1
    got = found(spark, [(int(i), v.tolist()) for i, v in zip(number, x)], 20, **kw)
    hits = 0
    for q in queries:
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        hits += len(set(number[np.argsort(-s)[:20]].tolist()) & {j for j, _ in got[int(number[q])]})
    return hits / (20 * len(queries))


def directions(rng, n, width=64):
    x = rng.normal(size=(n, width))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("norms", ["one", "heavy"])
def test_recall_of_unequal_norms(spark, norms):
    rng = np.random.default_rng(4)
    x = directions(rng, 20000)
    if norms == "one":
        x[7] *= 1e6
    else:
        x *= rng.pareto(1.0, size=(len(x), 1)) + 1
    queries = rng.choice(len(x), 150, replace=False)
    assert recall(spark, x.astype(np.float32), queries) >= 0.9


# A shorter group lies away from its queries' places, a tight one fills a small part of one cell.
@pytest.mark.parametrize("radius, norm", [(0.003, 1.0), (0.003, 0.6), (0.0001, 1.0)])
def test_recall_of_near_copies(spark, radius, norm):
    rng = np.random.default_rng(5)
    x = directions(rng, 24000)
    group = np.arange(0, len(x), 3)
    x[group] = norm * (x[0] + radius * directions(rng, len(group)) * rng.random((len(group), 1)))
    queries = rng.choice(group, 150, replace=False)
    assert recall(spark, x.astype(np.float32), queries) >= 0.9
