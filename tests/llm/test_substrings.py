import hashlib
import random

from samples import sentence

from meterlake.llm import packing, substrings


def brute(rows, size):
    """Windows that also start under a smaller doc_id, row by row."""
    first = {}
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        if i is not None:
            for s in range(len(words) - size + 1):
                key = tuple(words[s : s + size])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, text, *_ in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        if i is not None:
            for s in range(len(words) - size + 1):
                if first[tuple(words[s : s + size])] < i:
                    gone[s : s + size] = [True] * size
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df, size):
    rows = []
    for r in substrings.remove_repeats(df, size).collect():
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["spans"])
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
        rows.append((r["doc_id"], r["n_words"], r["n_removed"], hashlib.sha256(r["kept_text"].encode()).hexdigest()))
    return sorted(rows, key=str)


def test_odd_rows(odd_docs, odd_rows):
    small = [r for r in odd_rows if r[0] != 12]
    df = odd_docs.where("doc_id IS NULL OR doc_id <> 12")
    assert found(df, 50) == brute(small, 50)
    assert found(df.repartition(6), 5) == brute(small, 5)


def test_long_repetitive_text(odd_docs):
    rows = {r[0]: r for r in found(odd_docs.where("doc_id IN (7, 12)"), 50)}
    assert rows[12][1:3] == (40_000, 0)


def test_planted_passages(spark, monkeypatch):
    monkeypatch.setattr(substrings, "BATCH_BYTES", 4000)
    monkeypatch.setattr(packing, "BUCKET_BYTES", 2000)
    rng = random.Random(8)
    shared = [sentence(rng, rng.randrange(20, 90), 9000) for _ in range(4)]
    rows = [(i, " ".join(x for k in range(3) for x in (sentence(rng, 15, 9000), rng.choice(shared))), None, None, None) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    assert found(df, 50) == brute(rows, 50)
    assert found(df, 12) == brute(rows, 12)


def test_empty_table(no_docs):
    assert substrings.remove_repeats(no_docs).count() == 0


def test_words_built_by_doubling_stay(spark):
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    rest = [f"w{i}" for i in range(59)]
    rows = [(1, " ".join([*rest[:30], a, *rest[30:]])), (2, " ".join([*rest[:30], b, *rest[30:]]))]
    cut = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r["n_removed"] for r in cut.orderBy("doc_id").collect()] == [0, 0]
