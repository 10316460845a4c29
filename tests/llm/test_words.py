import numpy as np
import pyarrow as pa

from meterlake.llm import packing
from meterlake.llm import wordhash as W


def test_words_equal_bytes_split(odd_rows):
    texts = [r[1] for r in odd_rows]
    words = W.Words(pa.array(texts, pa.string()))
    expected = [(t or "").encode().split() for t in texts]
    assert words.counts().tolist() == [len(x) for x in expected]
    got = [bytes(words.data[a:b]) for a, b in zip(words.start, words.end)]
    assert got == [w for x in expected for w in x]


def test_equal_words_hash_equal_and_others_do_not(odd_rows, monkeypatch):
    texts = pa.array([r[1] for r in odd_rows], pa.string())
    words = W.Words(texts)
    whole = words.hashes()
    monkeypatch.setattr(W, "BLOCK", 64)
    assert (W.Words(texts).hashes() == whole).all()
    names = [bytes(words.data[a:b]) for a, b in zip(words.start, words.end)]
    assert len(set(zip(names, whole.tolist()))) == len(set(names)) == len(set(whole.tolist()))


def test_windows_are_equal_where_words_are(monkeypatch):
    words = W.Words(pa.array(["a b c a b c d", "x a b c", "a", None]))
    start, h = W.windows(words, words.hashes(), 3)
    assert start.tolist() == [0, 1, 2, 3, 4, 7, 8]
    assert h[0] == h[3] == h[6] and len(set(h.tolist())) == 5
    monkeypatch.setattr(W, "BLOCK", 2)
    assert (W.windows(words, words.hashes(), 3)[1] == h).all()


def test_slices_cover_a_batch_once():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["aaaa", None, "b" * 50, "", "cc"]), "n": [1, 2, 3, 4, 5]})
    parts = list(W.slices(batch, "text", 8))
    assert [x for p in parts for x in p.column("n").to_pylist()] == [1, 2, 3, 4, 5]
    assert max(p.num_rows for p in parts) > 1


def test_gaps_and_digests_round_trip():
    rng = np.random.default_rng(1)
    place = np.unique(rng.integers(0, 100_000, 500))
    place = np.concatenate((place, place[-1] + 1 + np.array([0, 254, 509, 1020])))
    assert (packing.decode_gaps(packing.encode_gaps(place)) == place).all()
    low, high = rng.integers(0, 2**63, 10).astype(np.uint64), rng.integers(0, 2**63, 10).astype(np.uint64)
    a, b = packing.read_digests(packing.digest_planes(low, high, 11), 11)
    assert (a == low).all() and (b == high & np.uint64(0xFFFFFF)).all()
    assert packing.digest_width(10**13, 10**6) > packing.digest_width(10**6, 10)


def doubled(n):
    """Two words of 2**n bytes, each built by doubling and swapping, equal under every odd base modulo 2**64."""
    a, b = "a", "b"
    for _ in range(n):
        a, b = a + b, b + a
    return a, b


def test_words_built_by_doubling_differ():
    for n in (1, 5, 10, 12):
        words = W.Words(pa.array([" ".join(doubled(n))]))
        for lane in (0, 1):
            a, b = words.hashes(lane)
            assert a != b
        assert words.ids().tolist() == [0, 1]


def test_ids_of_words(odd_rows):
    words = W.Words(pa.array([r[1] for r in odd_rows], pa.string()))
    names = [bytes(words.data[a:b]) for a, b in zip(words.start, words.end)]
    assert len(set(zip(names, words.ids().tolist()))) == len(set(names)) == len(set(words.ids().tolist()))
    assert W.Words(pa.array([None, ""], pa.string())).ids().tolist() == []
