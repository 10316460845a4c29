import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from meterlake.llm import mixing


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes):
    """Share again what full sources leave, until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in full)
        live = sum(weight[s] for s in names if s not in full)
        share = {s: rest * weight[s] / live for s in names if s not in full} if live else {}
        above = {s for s, t in share.items() if t >= 2 * sizes[s]}
        if not above:
            return {s: share.get(s, 2.0 * sizes[s]) for s in names}
        full |= above


def test_targets_and_exact_budgets(odd_docs, odd_rows):
    sizes = defaultdict(int)
    for r in odd_rows:
        sizes[r[3]] += size(r[1])
    wanted = targets(sizes)
    taken, seen = Counter(), Counter()
    rows = mixing.plan(odd_docs).collect()
    for r in rows:
        assert abs(r["target"] - wanted[r["source"]]) < 1e-6 * max(1, wanted[r["source"]])
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        seen[r["doc_id"], r["size"]] += 1
    assert seen == Counter((r[0], size(r[1])) for r in odd_rows)
    for s, t in wanted.items():
        assert taken[s] == int(t + 1e-9)


def test_reruns_and_partitions_agree(odd_docs):
    once = sorted(map(str, mixing.plan(odd_docs).collect()))
    assert sorted(map(str, mixing.plan(odd_docs.repartition(7)).collect())) == once


def test_the_mix_holds_the_words_that_were_taken(odd_docs):
    plan = {}
    for r in mixing.plan(odd_docs).groupBy("source").agg(F.sum("taken").alias("n")).collect():
        plan[r["source"]] = r["n"]
    mix = mixing.mixed_documents(odd_docs)
    assert mix.columns == odd_docs.columns
    got = defaultdict(int)
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r["doc_id"], []).append(r["text"])
    for r in mix.collect():
        got[r["source"]] += size(r["text"])
        assert any((t or "").startswith(r["text"] or "") for t in texts[r["doc_id"]])
    assert {s: n for s, n in got.items() if n} == {s: n for s, n in plan.items() if n}


def test_empty_table(no_docs):
    assert mixing.plan(no_docs).count() == 0
    assert mixing.mixed_documents(no_docs).count() == 0
