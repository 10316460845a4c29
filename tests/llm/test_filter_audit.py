import itertools
import random

import pytest
from pyspark.sql import functions as F

from samples import sentence

from meterlake.llm import filter_audit

SPACE = bytes([0x20, *range(9, 14)])


def words(text):
    out, now = [], ""
    for c in text:
        if ord(c) < 128 and ord(c) in SPACE:
            out, now = out + ([now] if now else []), ""
        else:
            now += c
    return out + ([now] if now else [])


def brute(rows, labels):
    """The report, filter by filter and document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    docs = []
    for i, text, lang, *_ in rows:
        t = text or ""
        w = words(t)
        failed = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > least[t],
        }
        docs.append((lang or "", {k for k, v in failed.items() if v}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d[1:] for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            live = mine
            gone = []
            for step, f in enumerate(order, 1):
                here = [d for d in live if f in d[0]]
                shapley[f] += len(here)
                redundant = sum(f in d[0] for d in gone)
                live = [d for d in live if f not in d[0]]
                gone = gone + here
                alone = sum(d[0] == {f} for d in mine)
                out[part, "".join(order), step] = [len(live), len(here), redundant, alone, sum(d[1] for d in here), sum(d[2] for d in here)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def found(df):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in cols] for r in df.collect()}


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, 1 if i % 7 == 0 else None) for i in range(-20, 130, 3)] + [(3, None, 1), (3, 1, 0), (None, 1, 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def written(df, path, files):
    """One file a write, so that each comes in an order of its own."""
    for part in files:
        df.where(part).coalesce(1).write.mode("append").parquet(path)
    return path


def test_odd_rows_in_any_order_of_files(spark, odd_docs, odd_rows, labels, tmp_path):
    rows, table = labels
    expected = brute(odd_rows, rows)
    thirds = [F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(3)) == k for k in (2, 0, 1)]
    path = written(odd_docs, str(tmp_path / "thirds"), thirds)
    assert found(filter_audit.audit(spark, path, table)) == expected


def test_smaller_ids_retract(spark, labels, tmp_path):
    """Copies that arrive from the greatest id to the smallest: each moves the one before."""
    rng = random.Random(3)
    texts = [sentence(rng, 120, 5000), "A few # words", sentence(rng, 110, 20)]
    rows = [(i, texts[i % 3], "en" if i % 2 else None) for i in range(40)] + [(1, texts[1], "de"), (1, texts[1], "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = written(df, str(tmp_path / "down"), [F.col("doc_id").between(k, k + 9) for k in (30, 20, 10, 0)])
    told = filter_audit.changes(spark, path, labels[1], batches=4)
    assert told.where("delta < 0").count() > 0
    assert found(filter_audit.interactions(filter_audit.counters(told))) == brute(rows, labels[0])


def test_one_batch_and_a_single_file(spark, labels, tmp_path):
    rng = random.Random(4)
    rows = [(i, sentence(rng, rng.choice([0, 5, 150]), 400) + ("|" if i % 5 == 0 else ""), "en") for i in range(30)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = written(df, str(tmp_path / "one"), [F.lit(True)])
    assert found(filter_audit.audit(spark, path, labels[1], batches=1)) == brute(rows, labels[0])
    file = spark.read.parquet(path).inputFiles()[0]
    assert found(filter_audit.audit(spark, file, labels[1])) == brute(rows, labels[0])


def test_empty_tables(spark, no_docs, labels, tmp_path):
    path = written(no_docs, str(tmp_path / "none"), [F.lit(True)])
    assert filter_audit.audit(spark, path, labels[1]).count() == 0
    rows = [(1, "A b", "en")]
    path = written(spark.createDataFrame(rows, "doc_id long, text string, lang string"), str(tmp_path / "some"), [F.lit(True)])
    assert found(filter_audit.audit(spark, path, labels[1].where("false"))) == brute(rows, [])
