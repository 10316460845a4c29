from collections import Counter

import pytest

import corpus_pipeline
from meterlake.llm import bytecnn, decontam, mixing, scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark, sf_dir):
    """Each stage against a plain computation over its own input."""
    from test_decontam import fit
    from test_setjoin import brute

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5

    def step(name, df):
        return scratch.write(stages[name](spark, df, sf_dir), "test-stage")

    good = step("quality classifier", docs)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    right = [i in kept for i, q in labels.items() if q == 1] + [i not in kept for i, q in labels.items() if q == 0]
    assert good.columns == COLUMNS and sum(right) / len(right) > 0.95

    one = step("n-gram Jaccard join", good)
    rows = [tuple(r) for r in good.collect()]
    assert one.columns == COLUMNS and sorted(r["doc_id"] for r in one.collect()) == sorted({c for _, _, c in brute(rows, 5, 80)})

    clean = step("benchmark decontamination", one)
    items = [r["text"].lower().split() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    left = {r["doc_id"] for r in clean.collect()}
    for r in one.collect():
        words = r["text"].lower().split()
        near = [i for i in items if len(set(i) & set(words)) >= 0.7 * len(set(i))]
        leaked = any(fit(i, words) <= len(i) // 5 for i in near)
        assert clean.columns == COLUMNS and (r["doc_id"] not in left) == leaked

    mix = step("mixing sources to target weights", clean)
    taken = {r["doc_id"]: r["taken"] for r in mixing.plan(clean).collect()}
    words = Counter()
    for r in mix.collect():
        words[r["doc_id"]] += len(r["text"].encode().split())
    assert mix.columns == COLUMNS and words == Counter({i: n for i, n in taken.items() if n})

    last = step("sharding", mix)
    counts = Counter(r["shard"] for r in last.collect())
    assert sum(counts.values()) == mix.count() and max(counts.values()) - min(counts.values()) <= 1
    assert len(held) == docs.count()


def test_run_and_registration(spark, sf_dir):
    import __spark_entry__ as entry

    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.count() > 0 and {"doc_id", "shard", "slot"} <= set(rows.columns)
    names = entry.queries()
    assert "pipeline" in names and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13


@pytest.mark.parametrize("name", ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding"])
def test_odd_and_empty_input(spark, sf_dir, odd_docs, no_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (odd_docs, no_docs):
        out = stage(spark, docs, sf_dir)
        out.collect()
        assert name == "sharding" or out.columns == docs.columns


def test_limits_are_parameters():
    assert bytecnn.SAMPLE == 4000 and decontam.RECALL >= 0.95
