"""Shards along a Hilbert curve over several metadata dimensions, in DataFrame expressions only.

Size, source and language are quantised to a grid, the grid cell gets its index on a Hilbert
curve, rows are sorted by it, and runs of the order become shards.  A shard then covers a compact
box of every dimension, so the minima and maxima of its files prune queries on any of them.

Defined cases: a null text counts as empty (size 1, CRC 0); a null source or language takes cell 0
of its dimension; ties on the curve are ordered by text hash, so that equal texts meet, then by
doc_id; equal rows may swap slots; an empty table gives an empty result; other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm import ordering

BITS = 5
SHARDS = 8


def _curve_steps(dims: int) -> list[int]:
    """One step of the curve from every orientation, packed: digit, then the next orientation.

    An orientation is an entry corner and a direction.  The octant is turned into the frame of
    the orientation, its rank along the Gray code is the digit, and the subcube's own
    orientation is composed with the present one.
    """
    size = 1 << dims

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & (size - 1)

    gray = [i ^ (i >> 1) for i in range(size)]
    rank = {g: i for i, g in enumerate(gray)}

    def ones(x: int) -> int:  # length of the run of ones at the low end
        n = 0
        while x & 1:
            x >>= 1
            n += 1
        return n

    out = []
    for entry in range(size):
        for way in range(dims):
            for octant in range(size):
                digit = rank[turn(octant ^ entry, -(way + 1))]
                inner = gray[2 * ((digit - 1) // 2)] if digit else 0
                heading = 0 if digit == 0 else ones(digit - 1 if digit % 2 == 0 else digit) % dims
                nxt = entry ^ turn(inner, way + 1)
                out.append((nxt * dims + (way + heading + 1) % dims) * size + digit)
    return out


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Index on the Hilbert curve of a cell given by integer coordinates below 2**bits."""
    dims = len(cells)
    size = 1 << dims
    steps = F.array(*[F.lit(v) for v in _curve_steps(dims)])

    def step(acc: Column, level: Column) -> Column:
        octant = F.lit(0)
        for d, c in enumerate(cells):
            octant = octant + F.lit(1 << d) * (F.floor(c / F.pow(F.lit(2.0), level)).cast("int") % 2)
        found = F.element_at(steps, acc["state"] * size + octant + 1)
        return F.struct(
            F.floor(found / size).cast("int").alias("state"),
            (acc["index"] * size + found % size).cast("long").alias("index"),
        )

    levels = F.array(*[F.lit(b) for b in range(bits - 1, -1, -1)])
    start = F.struct(F.lit(0).cast("int").alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(levels, start, step, lambda acc: acc["index"])


def curve_of(docs: DataFrame, bits: int = BITS) -> Column:
    """Curve index of a document by size (logarithmic), source and language."""
    top = (1 << bits) - 1
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    cells = [F.least(F.lit(top), F.floor(F.log2(size) * 1.5).cast("int"))]
    for name in ("source", "lang"):
        known = F.pmod(F.xxhash64(name), F.lit(top)).cast("int") + 1
        cells.append(F.when(F.col(name).isNull(), 0).otherwise(known))
    return hilbert_index(cells, bits)


def shards(docs: DataFrame, count: int = SHARDS) -> DataFrame:
    """Law ``rows``: doc_id, size, text_crc32, curve, shard, slot; shard sizes differ by one row at most."""
    body = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.xxhash64("text").alias("_text"),
        curve_of(docs).alias("curve"),
    )
    placed = ordering.positions(narrow, [F.col(c) for c in ("curve", "_text", "text_crc32", "doc_id")], {})
    total = placed.agg(F.count(F.lit(1)).alias("_total"))
    placed = placed.join(F.broadcast(total))  # one row
    # The first (total mod count) shards hold one row more.
    small, extra = F.floor(F.col("_total") / count), F.col("_total") % count
    in_large = F.col("_before") < extra * (small + 1)
    past = F.col("_before") - extra * (small + 1)
    shard = F.when(in_large, F.floor(F.col("_before") / (small + 1))).otherwise(extra + F.floor(past / F.greatest(small, F.lit(1))))
    slot = F.when(in_large, F.col("_before") % (small + 1)).otherwise(past % F.greatest(small, F.lit(1)))
    return placed.select("doc_id", "size", "text_crc32", "curve", shard.cast("int").alias("shard"), slot.cast("long").alias("slot"))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Store ``docs`` as one folder per shard, each sorted by slot.  ``assigned``: from ``shards``,
    over documents whose doc_id is unique."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    rows = docs.select(F.col("doc_id").alias("_doc"), F.struct(*kept).alias("_row"))  # one struct: no name can clash
    out = rows.join(assigned.select(F.col("doc_id").alias("_of"), "shard", "slot"), F.col("_doc") == F.col("_of")).select("_row.*", "shard", "slot")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
