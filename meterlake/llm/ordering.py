"""Positions and running sums over a total order, without any single task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm import scratch

#: Rows of one range; ranges are counted from the rows so a task stays small at any size.
RANGE_ROWS = 400_000


def positions(df: DataFrame, order: list[Column], sums: dict[str, str], rows: int | None = None) -> DataFrame:
    """Add ``_before`` (rows before, a long) and, for each ``name: column`` of ``sums``, the
    sum of that long column over all rows before.

    The rows are range-partitioned by ``order``, stored with the number of their range, and each
    range adds the totals of the ranges before it: one row per range, so that table is small.
    ``order`` has to end in something that tells rows apart, or ties are placed arbitrarily; rows
    equal in all columns may swap.  Pass narrow rows: they are shuffled twice.  ``rows``: their number,
    if known.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(df.count() if rows is None else rows) // RANGE_ROWS))
    cut = df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id())
    cut = scratch.write(cut, "ranges")
    totals = cut.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()]
    )
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_b_n"),
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums],
    )
    inside = Window.partitionBy("_range").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.select(
        "*",
        (F.row_number().over(inside) - 1).alias("_i_n"),
        *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(f"_i_{n}") for n, c in sums.items()],
    )
    joined = placed.join(F.broadcast(base), "_range")  # one row per range
    return joined.select(
        *[c for c in cut.columns if c != "_range"],
        (F.col("_b_n") + F.col("_i_n")).alias("_before"),
        *[(F.col(f"_b_{n}") + F.col(f"_i_{n}")).alias(n) for n in sums],
    )
