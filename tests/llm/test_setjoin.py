import random

import numpy as np
import pyarrow as pa
import pytest

from samples import sentence

from meterlake.llm import setjoin

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text, size):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(rows, size=4, percent=85):
    sets = [(r[0], shingles(r[1], size)) for r in rows if r[0] is not None]
    parent = {i: i for i, _ in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    out = [(i, len(s), root(i)) for i, s in sets]
    out += [(None, len(shingles(r[1], size)), None) for r in rows if r[0] is None]
    return sorted(out, key=str)


def found(df, **kw):
    return sorted((tuple(r) for r in setjoin.components(df, **kw).select("doc_id", "n_shingles", "component_id").collect()), key=str)


def family(rng, i, n, copies, edits):
    words = sentence(rng, n, 5000).split()
    for c in range(copies):
        w = list(words)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        yield (i + c, " ".join(w), None, None, None)


@pytest.fixture(scope="module")
def families():
    rng = random.Random(4)
    rows, i = [], 0
    for n in (2, 4, 6, 9, 14, 22, 40, 75, 140, 400):
        for _ in range(4):
            rows += family(rng, i, n, 6, max(1, n // 40))
            i += 10
    rng.shuffle(rows)
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_odd_rows(odd_docs, odd_rows):
    assert found(odd_docs) == brute(odd_rows)


def test_families_at_both_settings(spark, families):
    df = spark.createDataFrame(families, SCHEMA).repartition(5)
    assert found(df) == brute(families)
    assert found(df, shingle=5, percent=80) == brute(families, 5, 80)


def test_clusters_cut_into_blocks(spark, families, monkeypatch):
    monkeypatch.setattr(setjoin, "CLUSTER_SHINGLES", 200)
    monkeypatch.setattr(setjoin, "BROADCAST_ROWS", 0)
    assert found(spark.createDataFrame(families, SCHEMA)) == brute(families)


@pytest.mark.parametrize("limit", [50, 2_000])
def test_large_clusters_are_cut_by_size(spark, monkeypatch, limit):
    """One chain of growing texts: each links with the next, over many bands of sizes, and one cluster holds all."""
    monkeypatch.setattr(setjoin, "CLUSTER_SHINGLES", limit)
    words, rows, n = [f"w{i}" for i in range(2000)], [], 10
    while n < 1500:
        rows.append((1000 - len(rows), " ".join(words[:n])))
        n += max(1, n // 8)
    rows += [(2000 + i, " ".join(words[i * 40 : i * 40 + 90])) for i in range(20)]  # shared passages, not similar
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_every_similar_pair_shares_a_digest(percent):
    """The pigeonhole argument, on pairs at the very limit of similarity."""
    rng = np.random.default_rng(percent)
    for n in [*range(1, 60), 100, 233, 500, 1200]:
        for _ in range(6):
            items = rng.integers(1, 2**63, n + 400).astype(np.uint64)
            m = int(rng.integers(n, n * 100 // percent + 1))
            limit = setjoin.difference_limit(n, m, percent)
            lost = (limit - (m - n)) // 2
            a, b = items[:n], np.concatenate((items[lost:n], items[n : n + (m - n) + lost]))
            both = setjoin.Sets.__new__(setjoin.Sets)
            both.items = np.concatenate((np.sort(a), np.sort(b)))
            both.sizes = np.array([len(a), len(b)])
            both.doc = np.repeat([0, 1], both.sizes)
            both.first = np.array([0, len(a), len(a) + len(b)])
            union = len(np.union1d(a, b))
            assert 100 * (len(a) + len(b) - union) >= percent * union
            sig, doc = setjoin.signatures(both, percent)
            assert set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist()) or set(a.tolist()) == set(b.tolist()), (n, m)



@pytest.mark.parametrize("percent", [80, 85])
def test_a_digest_is_left_that_both_keep(percent):
    """Even where what similar sets share is commoner than all that they do not."""
    rng = np.random.default_rng(percent + 1)
    left_out = 0
    for n in [*range(1, 60), 100, 233, 500, 1200]:
        for _ in range(6):
            items = rng.integers(1, 2**63, n + 400).astype(np.uint64)
            m = int(rng.integers(n, n * 100 // percent + 1))
            lost = (setjoin.difference_limit(n, m, percent) - (m - n)) // 2
            if not lost and m == n:
                continue
            pair = items[:n], np.concatenate((items[lost:n], items[n : n + (m - n) + lost]))
            both = setjoin.Sets.__new__(setjoin.Sets)
            both.items = np.concatenate([np.sort(x) for x in pair])
            both.sizes = np.array([len(x) for x in pair])
            both.doc = np.repeat([0, 1], both.sizes)
            both.first = np.concatenate(([0], np.cumsum(both.sizes)))
            sig, doc, late = setjoin.counted_signatures(both, percent)
            shared = set(sig[doc == 0].tolist()) & set(sig[doc == 1].tolist())
            kept = []
            for d in (0, 1):
                for odd in (0, 1):
                    mine = sorted((x for x in sig[doc == d].tolist() if x % 2 == odd), key=lambda x: (x not in shared, x))
                    kept.append(set(mine[late[d, odd] :]))
                    left_out += int(late[d, odd])
            assert kept[0] & kept[2] or kept[1] & kept[3], (n, m)
    assert left_out > 1000


def test_common_passages_make_no_clusters(spark, monkeypatch):
    """Texts that share passages with many others, but are not similar, do not grow together."""
    rng = random.Random(12)
    common = [sentence(rng, 16, 5000) for _ in range(6)]

    def text(i):
        parts = rng.sample(common, 2) + [" ".join(f"w{i}x{j}x{k}" for k in range(20)) for j in range(rng.randrange(4, 7))]
        rng.shuffle(parts)
        return " ".join(parts)

    rows = [(i, text(i)) for i in range(600)]
    for i in range(0, 60, 2):  # near copies of some
        w = rows[i][1].split()
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((1000 + i, " ".join(w)))
    sent, write = [], setjoin.scratch.write

    def spy(df, name):
        out = write(df, name)
        if name == "setjoin-clusters":
            sent.extend(r["doc_id"] for r in out.collect())
        return out

    monkeypatch.setattr(setjoin.scratch, "write", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df, shingle=5, percent=80) == brute(rows, 5, 80)
    assert {i for k in range(0, 60, 2) for i in (k, 1000 + k)} <= set(sent)
    assert len(sent) < 120, len(sent)

def test_sets_of_a_batch():
    texts = ["a b c d e", "A B C D a b c d", "x y", "Y x", "", None, "a"]
    s = setjoin.Sets(pa.array(texts))
    assert s.sizes.tolist() == [len(shingles(t, 4)) for t in texts]
    digests = setjoin.Sets(pa.array(["p q r s t", "p q r s t", "t s r q p"])).digests()
    assert (digests[0] == digests[1]).all() and (digests[0] != digests[2]).any()


def test_one_of_each(odd_docs, odd_rows):
    kept = setjoin.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    heads = sorted({c for _, _, c in brute(odd_rows) if c is not None})
    assert sorted(i for i in ids if i is not None) == heads and ids.count(None) == 2


def test_empty_table(no_docs):
    assert setjoin.components(no_docs).count() == 0 and setjoin.one_of_each(no_docs).count() == 0


def test_one_id_with_several_texts(spark):
    """A link to the second text of a doc_id is a link to that doc_id."""
    rng = random.Random(9)
    t1, t2 = sentence(rng, 120, 5000), sentence(rng, 120, 5000)
    near = t2.split()
    near[60] = "other"
    rows = [(3, t1), (5, t1), (5, t2), (9, " ".join(near)), (20, sentence(rng, 30)), (2**62, "a b"), (-7, "")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    low = [(-(2**62), t1), *rows]
    assert found(spark.createDataFrame(low, "doc_id long, text string")) == brute(low)


def test_words_built_by_doubling(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rows = [(1, f"{a} " * 3 + f"{a} {b} {b} {a}"), (2, f"{b} " * 3 + f"{b} {a} {a} {b}"), (3, f"x {a}"), (4, f"x {b}"), (5, f"X {a}")]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_hot_copies_and_ids_with_a_stride(spark, families, monkeypatch):
    monkeypatch.setattr(setjoin, "HOT_COPIES", 3)
    rows = [(r[0] * 2000, r[1]) for r in families] + [(10**6 * i, families[0][1]) for i in range(1, 30)]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)
    spread = np.bincount(setjoin._bucket_of_id(np.arange(100_000) * 2000, 200), minlength=200)
    assert spread.min() > 300 and spread.max() < 700
