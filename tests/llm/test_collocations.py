import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from samples import sentence

from meterlake.llm import collocations

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def pieces(text):
    for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
        words = re.findall(r"[^ \t]+", piece)
        if words:
            yield words


def brute(rows, least, longest=5, most=2000):
    f = defaultdict(Counter)
    for _, text, lang, *_ in rows:
        for w in pieces(text):
            for m in range(1, longest + 1):
                f["und" if lang is None else lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, count in f.items():
        n = sum(a for p, a in count.items() if len(p) == 1)
        common = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        covered = set()
        for q, b in common.items():
            for x in range(len(q)):
                for y in range(x + 2, len(q) + 1):
                    p = q[x:y]
                    if len(p) < len(q) and 100 * b >= 100 * common[p]:
                        covered.add(p)
        found = []
        for p, a in common.items():
            if p in covered:
                continue
            cuts = [(1000 * a * n // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:most], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(8)
    shared = sentence(rng, 25, 4000)
    rows = []
    for i in range(120):
        text = sentence(rng, rng.randrange(0, 60), 12) + rng.choice([". ", ",\t", "\n", "  \t "]) + sentence(rng, rng.randrange(0, 30), 300)
        if i % 4 == 0:
            text += rng.choice(["; ", " "]) + shared + rng.choice(["!", ""])
        rows.append((i, text.replace("w1", "W1"), [None, "und", "en", "日本", ""][i % 5], None, None))
    rows.append((200, "ha " * 30 + "HA", "en", None, None))
    return rows + rows[:20]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("least", [2, 6])
def test_against_every_phrase_of_every_piece(spark, prose, least):
    df = spark.createDataFrame(prose, SCHEMA).repartition(3)
    assert found(collocations.collocations(df, least=least)) == brute(prose, least)


def test_small_bit_tables_change_nothing(spark, prose):
    """Tables with many words and pairs in a slot screen less, and that is all."""
    df = spark.createDataFrame(prose, SCHEMA)
    words = collocations.word_counts(df)
    table = collocations.bit_table(spark.range(1 << 15).selectExpr("id AS slot").union(spark.range(3, 2**16, 40000).toDF("slot")), 16)
    assert table[: 1 << 12] == b"\xff" * (1 << 12) and table[(1 << 12) :].count(0) == (1 << 12) - 1
    full = b"\xff" * (1 << 12)
    graph = collocations.edges_and_ends(df, full, full)
    few = collocations.contract(collocations.levels(graph), 4)
    many = collocations.contract(collocations.levels(collocations.edges_and_ends(df, *collocations.frequent_pairs(df, words, 4))), 4)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert found(collocations.collocations(df, least=4, most=7, bits=(15, 15))) == brute(prose, 4, most=7)


def test_odd_rows(odd_docs, odd_rows):
    assert found(collocations.collocations(odd_docs, least=3)) == brute(odd_rows, 3)


def test_unary_paths_reach_the_ends_of_a_passage(spark):
    rng = random.Random(2)
    passage = [f"p{i}" for i in range(37)]
    rows = [(i, " ".join([f"x{rng.randrange(10**6)}", *passage, f"y{rng.randrange(10**6)}"]), "en", None, None) for i in range(9)]
    rows += [(100 + i, " ".join(passage[20:30]), "en", None, None) for i in range(4)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = collocations.collocations(df, least=5, paths=True).collect()
    spans = {r["phrase"]: r["path_words"] for r in got if len(r["phrase"].split()) == 5}
    # Flow grows where the short copies begin and falls where they end.
    assert spans["p0 p1 p2 p3 p4"] == 24 and spans["p20 p21 p22 p23 p24"] == 10 and spans["p32 p33 p34 p35 p36"] == 11
    assert found(collocations.collocations(df, least=5)) == brute(rows, 5)


def test_scores_beyond_64_bits(spark):
    rows = [(10**12, 3 * 10**12, 2 * 10**12, 10**16), (7, 7, 7, 7), (100, 10**16, 10**16, 10**17), (2, 3, 5, 7)]
    df = spark.createDataFrame(rows, "a long, l long, r long, n long").selectExpr("a", "l", "r", "n", f"{collocations.SCORE} AS score")
    assert [r["score"] for r in df.collect()] == [1000 * a * n // (left * right) for a, left, right, n in rows]


def test_phrases_are_joined_by_one_space():
    p = collocations.Pieces(pa.array(["A \t b.c  É d", None, "e"]), pa.array(["en", None, None], pa.string()))
    assert p.joined.tolist() == [True, False, True, True, False, False]
    assert p.phrases(np.array([0, 2, 5]), np.array([1, 4, 5])).to_pylist() == ["a b", "c É d", "e"]


def test_no_number_for_each_byte():
    """Words and phrases of a batch take a few bytes for each byte of text, not several 64-bit numbers."""
    rng = random.Random(5)
    p = collocations.Pieces(pa.array([sentence(rng, 400, 10**9) + "; É" for _ in range(400)]), pa.array(["en"] * 400))
    first = np.arange(0, len(p) - 5, 2)
    size = len(p.data)
    for taken in (p.names, lambda: p.phrases(first, first + 4)):
        tracemalloc.start()
        found = taken()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 16 * size, (peak, size)
    words = [bytes(p.data[a:b]).decode() for a, b in zip(p.start, p.end)]
    assert found.to_pylist() == [" ".join(words[i : i + 5]) for i in first]
    assert [x.decode() for x in p.names().dictionary_decode().to_pylist()] == words


def test_empty_table(no_docs):
    assert collocations.collocations(no_docs, paths=True).count() == 0
