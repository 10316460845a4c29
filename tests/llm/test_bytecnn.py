import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterlake.llm import bytecnn


@pytest.fixture(scope="module")
def fitted(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    return docs, labels, bytecnn.fit(docs, labels, sample=1500)


def test_held_out_accuracy(fitted):
    docs, labels, net = fitted
    rows = bytecnn.score(docs.select("doc_id", "text"), net).join(labels, "doc_id").where(bytecnn.held_out(F.col("doc_id"))).collect()
    assert len(rows) > 500
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.97
    assert (good >= bytecnn.CUT).mean() > 0.98 and (bad < bytecnn.CUT).mean() > 0.9


def test_reruns_agree(spark, fitted):
    docs, labels, net = fitted
    again = bytecnn.fit(docs.repartition(5), labels.repartition(3), sample=1500)
    assert (again.taps == net.taps).all() and (again.out == net.out).all()


def direct(net, text):
    """Chunk by chunk, as the definition says."""
    symbols, _ = bytecnn.symbol_rows(pa.array([text]))
    n = max(1, len(symbols))
    padded = np.full(n + bytecnn.WIDTH - 1, bytecnn.PAD, np.int16)
    padded[: len(symbols)] = symbols
    resp = sum(net.taps[k][padded[k : k + n]] for k in range(bytecnn.WIDTH))
    starts = range(0, n, bytecnn.BLOCK)
    last = max(1, len(starts) - 1)
    pooled = [np.maximum(resp[s : s + 2 * bytecnn.BLOCK].max(0) + net.bias, 0) for s in list(starts)[:last]]
    return float(net.probability(np.mean(pooled, axis=0)[None])[0])


def test_whole_texts_chunk_by_chunk(fitted, odd_docs, odd_rows, monkeypatch):
    net = fitted[2]
    keys = [r for r in odd_rows if r[0] is not None and r[0] != 14 and r[0] != 3]
    for span in (bytecnn._SPAN, 1024):
        monkeypatch.setattr(bytecnn, "_SPAN", span)
        symbols, bounds = bytecnn.symbol_rows(pa.array([r[1] for r in keys], pa.string()))
        p = net.probability(bytecnn._pool(net, symbols, bounds))
        assert np.allclose(p, [direct(net, r[1]) for r in keys], atol=1e-5)


def test_odd_rows(fitted, odd_docs, no_docs):
    net = fitted[2]
    scored = bytecnn.score(odd_docs, net)
    assert set(scored.columns) == {*odd_docs.columns, "predicted"} and scored.count() == odd_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scored.collect())
    assert bytecnn.score(no_docs, net).count() == 0
    assert bytecnn.keep_good(odd_docs, net).columns == odd_docs.columns


def test_without_labels(odd_docs, spark):
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 7, 0)], "doc_id long, quality int, toxic int")
    assert bytecnn.fit(odd_docs, labels) is None
    assert {r["score"] for r in bytecnn.score(odd_docs, None).collect()} == {0.5}
    assert bytecnn.keep_good(odd_docs, None).count() == odd_docs.count()


def test_chunks_cover_whole_texts():
    for n in (0, 1, 127, 128, 129, 256, 257, 1000, 5000):
        text = bytes(range(256)) * (n // 256 + 1)
        chunks = bytecnn.chunks_of(text[:n])
        assert len(chunks) == max(1, -(-n // bytecnn.BLOCK) - 1)
        seen = np.concatenate([chunks[0], *[c[-bytecnn.BLOCK :] for c in chunks[1:]]])
        assert bytes(seen[:n].astype(np.uint8)) == text[:n] and (seen[n:] == bytecnn.PAD).all()


def test_the_end_of_a_long_text_teaches(spark):
    """Labels that only the last bytes of long texts tell apart."""
    import random

    from samples import sentence

    rng = random.Random(6)
    rows = [(i, sentence(rng, 1500) + (" zzqzz!" if i % 2 else " plain."), i % 2) for i in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    net = bytecnn.fit(docs, spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int"))
    p = net.probability(bytecnn._pool(net, *bytecnn.symbol_rows(pa.array([r[1] for r in rows]))))
    y = np.array([r[2] for r in rows])
    assert (p[y == 1][:, None] > p[y == 0][None, :]).mean() > 0.9


def test_training_memory_does_not_follow_the_longest_text(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(bytecnn, "STEPS", 1)
    texts = [b"good plain words " * 60_000, b"bad", b""]  # the first has 7,968 chunks: 98 MB of responses
    tracemalloc.start()
    bytecnn.train(texts, np.array([1, 0, 0], np.float32))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20


def test_pieces_do_not_change_the_training(monkeypatch):
    monkeypatch.setattr(bytecnn, "STEPS", 3)
    texts = [b"good plain words " * 300, b"", "é bad \U0001f600".encode() * 200, b"x" * 256]
    nets = []
    for most in (1, 7, 10_000):
        monkeypatch.setattr(bytecnn, "PIECE", most)
        nets.append(bytecnn.train(texts, np.array([1, 0, 0, 1], np.float32)))
    assert all((n.taps == nets[0].taps).all() and (n.out == nets[0].out).all() for n in nets)
