import random
import zlib

import pytest
from tokenizers import Tokenizer

from meterlake.llm import token_prefix as T
from meterlake.llm.entries import vocabulary_path

ODD = [
    "don't  we'll\n\n  go '' 's 'x  ", "a<|endoftext|>b <|endoftext|>", "<|endoftext|><|endoftext|> x", "   ", "x   y\t\t z　　q",
    "日本語テキスト ①②３ ٣٤ ŉ", "a" * 700, " " * 150 + "z", "'ll'llx 'd", "\r\n\r\n x  y", "!!''s '", "👍🏽👩‍👧 zz\x1c\x1cz\x85q", "<|endof", "",
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    return lambda s: len(t.encode(s, add_special_tokens=False).ids)


def test_every_prefix_counts_like_the_library(library, odd_rows):
    table = T.PrefixCounter(vocabulary_path())
    rng = random.Random(2)
    for text in ODD + [r[1] for r in odd_rows if r[1] and len(r[1]) < 5000]:
        d = table.deltas(text)
        assert len(d) == len(text)
        cuts = range(len(text) + 1) if len(text) < 200 else rng.sample(range(len(text) + 1), 25)
        for k in cuts:
            assert T.count_at(d, k) == library(text[:k]), (text[:k][-20:], k)
        for budget in (0, 1, 7, 10**6):
            n = T.longest_prefix(d, budget)
            assert library(text[:n]) <= budget
            assert all(T.count_at(d, k) > budget for k in range(n + 1, len(text) + 1))


def test_stores_do_not_change_results(monkeypatch):
    whole = T.PrefixCounter(vocabulary_path())
    for name in ("UNITS", "PAIRS", "STATES"):
        monkeypatch.setattr(T, name, 3)
    monkeypatch.setattr(T, "UNIT_CHARS", 4)
    small = T.PrefixCounter(vocabulary_path())
    for text in ODD:
        assert small.deltas(text) == whole.deltas(text)


def test_table(odd_docs, odd_rows, no_docs, library):
    rows = T.prefix_table(odd_docs.drop("starts"), vocabulary_path()).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"], T.count_at(zlib.decompress(r["prefixes"]), 10**9)) for r in rows)
    wanted = sorted((str(r[0]), len((r[1] or "").encode()), library(r[1] or ""), library(r[1] or "")) for r in odd_rows)
    assert got == wanted
    assert T.prefix_table(no_docs, vocabulary_path()).count() == 0


def test_white_space_before_apostrophes(library):
    table = T.PrefixCounter(vocabulary_path())
    rng = random.Random(3)
    signs = ["'", "''", "'s", "'t", "'m", "'d", "'re", "'ve", "'ll", " ", "\n", "\t", "\r", "\xa0", "\u3000", "\x1c", "a", "s", "r", "l", "1", "!", "é"]
    texts = ["x\n's", "x\t't", "a\n\n'm", "x\xa0's", "x\n 's", "x \n're", "\n'small", "\n''s"]
    texts += ["".join(rng.choices(signs, k=rng.randrange(1, 9))) for _ in range(3000)]
    for text in texts:
        d = table.deltas(text)
        for k in range(len(text) + 1):
            assert T.count_at(d, k) == library(text[:k]), (text, k)


def test_answers_come_from_the_store(odd_docs, odd_rows, no_docs, library):
    docs = odd_docs.drop("starts").select("doc_id", "text")
    for budget in (3, 1024):
        rows = T.read_counts(T.prefix_table(docs, vocabulary_path()), budget).collect()
        want = sorted((r[0] or 0, library(r[1] or "")) for r in odd_rows)
        assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == want
        assert all(r["over_limit"] == (r["n_tokens"] > budget) for r in rows)
    assert T.read_counts(T.prefix_table(no_docs.select("doc_id", "text"), vocabulary_path()), 7).count() == 0
