import random

import pytest

from samples import sentence

EXTRA = ("size", "score", "taken", "_id", "_row", "_key", "component_id", "shard", "target", "starts")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows and ids, odd white space."""
    rng = random.Random(5)
    base = sentence(rng, 400)
    near = base.split()
    near[200] = "other"
    shared = sentence(rng, 70)
    rows = [
        (1, base, "en", "src1", 1), (2, " ".join(near), "en", "src1", 2), (3, base, "de", None, 3), (3, base, "de", None, 3),
        (4, None, "en", "src2", None), (5, "", None, "src2", 0), (6, " \t\x0b\n", "en", "src2", 4), (7, "one", "en", "src3", 3),
        (8, "Two Words", "en", "src3", 9), (9, "two words", "fr", "src3", 9), (None, base, "en", "src1", 5), (None, None, None, None, None),
        (10, sentence(rng, 90) + "\n" + shared + " " + sentence(rng, 40), "en", "src4", 7), (11, sentence(rng, 30) + " " + shared, "es", "src4", 8),
        (12, "a b " * 20_000, "en", "src1", 80_000), (13, "é x y  <|endoftext|> 日本", "fr", "src5", 12),
        (14, sentence(rng, 120), "en", "src1", 1), (14, sentence(rng, 60), "en", "src1", 1), (-15, shared, "en", "src9", 1),
    ]
    rows += [(100 + i, sentence(rng, rng.randrange(5, 200)), "en", f"src{i % 4}", i) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The rows above with columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.withColumns({c: F.lit(c) for c in EXTRA})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
