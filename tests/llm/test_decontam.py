import random

import numpy as np
import pytest

from samples import sentence

from meterlake.llm import decontam


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def fit(item, text):
    """Least edit distance of the item to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(6)
    items = [(i, sentence(rng, rng.randrange(8, 60), 4000)) for i in range(25)] + [(90, None), (91, ""), (3, None), (92, "Short one"), (93, "w1 w2 w3 w4 w5 w6")]
    docs = []
    for i in range(120):
        words = sentence(rng, rng.randrange(20, 150), 4000).split()
        if i % 2:
            part = rng.choice(items[:25])[1].upper().split()
            for _ in range(rng.randrange(len(part) // 5 + 3)):
                k = rng.randrange(len(part))
                part[k : k + rng.randrange(2)] = [] if rng.random() < 0.3 else [f"n{rng.randrange(999)}"]
            at = rng.randrange(len(words))
            words[at:at] = part
        docs.append((i, " ".join(words)))
    docs += [(500, None), (501, ""), (502, docs[1][1]), (502, docs[1][1]), (None, docs[1][1]), (503, "so short ONE it is")]
    return docs, items


def frames(spark, planted):
    docs, items = planted
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_against_brute_force(spark, planted):
    docs, items = planted
    df, bench = frames(spark, planted)
    got = {(r["doc_id"], r["item_id"]): r for r in decontam.matches(df, bench).collect()}
    wanted = {}
    for i, text in docs:
        words = (text or "").lower().split()
        for j, item in items:
            target = (item or "").lower().split()
            if target and words and (d := fit(target, words)) <= len(target) // 5:
                wanted[i, j] = d
    assert set(got) <= set(wanted)  # nothing that exact distance does not confirm
    assert len(got) >= 0.95 * len(wanted)
    assert {k for k, d in wanted.items() if d == 0} <= set(got)
    texts = {i: (t or "").lower().split() for i, t in docs}
    names = {i: (t or "").lower().split() for i, t in items if t}
    for (i, j), r in got.items():
        assert r["distance"] == wanted[i, j] == edits(names[j], texts[i][r["start_word"] : r["end_word"]])


def test_repeated_rows_are_all_found(spark, planted):
    df, bench = frames(spark, planted)
    found = [r["doc_id"] for r in decontam.matches(df, bench).collect()]
    assert found.count(502) == 2 * found.count(1) and found.count(None) == found.count(1) and 503 in found


def test_blocks_of_items_agree(spark, planted, monkeypatch):
    df, bench = frames(spark, planted)
    whole = sorted(map(str, decontam.matches(df, bench).select("doc_id", "item_id").collect()))
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 4)
    cut = sorted(map(str, decontam.matches(df, bench).select("doc_id", "item_id").collect()))
    assert len(set(cut) ^ set(whole)) <= 0.1 * len(whole)


def test_clean_documents(spark, planted, odd_docs, no_docs):
    df, bench = frames(spark, planted)
    bad = {r["doc_id"] for r in decontam.matches(df, bench).collect()}
    kept = [r["doc_id"] for r in decontam.clean_documents(df, bench).collect()]
    assert sorted(map(str, kept)) == sorted(str(i) for i, _ in planted[0] if i not in bad)
    assert decontam.clean_documents(odd_docs, bench).columns == odd_docs.columns
    assert decontam.clean_documents(no_docs, bench).count() == 0
    empty = bench.where("false")
    assert decontam.clean_documents(odd_docs, empty).count() == odd_docs.count() and decontam.matches(odd_docs, empty).count() == 0


def test_best_fit():
    rng = np.random.default_rng(1)
    for _ in range(40):
        item, text = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(1, 20))
        d, a, b = decontam.best_fit(item, text)
        assert d == fit(item.tolist(), text.tolist()) == edits(item.tolist(), text[a:b].tolist())


def test_long_items(spark):
    rng = random.Random(8)
    items = [(i, sentence(rng, n, 50_000)) for i, n in enumerate((1000, 3000) * 3)]
    docs = []
    for i, text in items:
        for j in range(2):
            words = text.split()
            for k in sorted(rng.sample(range(len(words)), len(words) // 5), reverse=True):
                words[k : k + rng.randrange(2)] = [] if rng.random() < 0.3 else [f"n{rng.randrange(999)}"]
            docs.append((10 * i + j, f"{sentence(rng, 200, 50_000)} {' '.join(words)} {sentence(rng, 200, 50_000)}"))
    df, bench = frames(spark, (docs, items))
    got = {(r["doc_id"], r["item_id"]) for r in decontam.matches(df, bench).collect()}
    assert got <= {(d, d // 10) for d, _ in docs}
    assert len(got) >= 0.95 * len(docs)
