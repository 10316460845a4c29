import zlib
from itertools import product

from pyspark.sql import functions as F

from meterlake.llm import sharding


def test_curve_visits_every_cell_by_single_steps(spark):
    for dims, bits in ((2, 3), (3, 2)):
        cells = list(product(range(1 << bits), repeat=dims))
        names = [f"c{i}" for i in range(dims)]
        df = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
        rows = df.withColumn("h", sharding.hilbert_index([F.col(n) for n in names], bits)).orderBy("h").collect()
        assert [r["h"] for r in rows] == list(range(len(cells)))
        for a, b in zip(rows, rows[1:]):
            assert sum(abs(a[n] - b[n]) for n in names) == 1


def test_shards_are_even_and_slots_gapless(odd_docs, odd_rows):
    rows = sharding.shards(odd_docs).collect()
    assert len(rows) == len(odd_rows)
    held = [sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(8)]
    assert max(map(len, held)) - min(map(len, held)) <= 1
    assert all(h == list(range(len(h))) for h in held)
    bodies = {(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in odd_rows}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == bodies
    order = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in order] == sorted(r["curve"] for r in rows)


def test_fewer_rows_than_shards_and_none(odd_docs, no_docs):
    assert sorted(r["shard"] for r in sharding.shards(odd_docs.where("doc_id IN (7, 8, 9)")).collect()) == [0, 1, 2]
    assert sharding.shards(no_docs).count() == 0


def test_written_shards(spark, odd_docs, tmp_path):
    unique = odd_docs.drop("shard").where("doc_id > 90")
    sharding.write_shards(unique, sharding.shards(unique), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == unique.count() and back.select("shard").distinct().count() == 8
