"""Split oversized groups into ordered slices.

``Window.partitionBy(meter).orderBy(ts)`` puts one meter into one task.  If one
meter holds a third of the readings, so does that task.  ``measure`` finds such
hot groups with one narrow aggregate.  Their rows are then range-partitioned by
the whole order, of any columns, with a number of its own for each row as the last
of them: so a time that repeats without end and readings without a time are cut
like any others.  Each range is a slice; it is stored, so that every branch of a plan sees the
same slices.  Where the cuts fall only affects balance, never results: slices are
contiguous in the ordering, and the operators in ``ordered`` carry what crosses a cut.

The driver only receives hot keys, bounded by ``SplitPolicy.max_groups`` at any data
size.  Ordinary data has no hot group: then one count is all it costs, and plans
are the plain windows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import config
from meterlake.plans.staging import stage

SLICE = "_slice"
_ROW = "_row_number"


def null_safe(left: DataFrame, right: DataFrame, pairs) -> Column:
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & left[a].eqNullSafe(right[b])
    return cond


@dataclass(frozen=True)
class Splits:
    """Hot groups of one (keys, order) pair, and into how many slices their rows go."""

    keys: tuple[str, ...]
    order: str
    rows: tuple = ()
    schema: T.StructType | None = field(default=None, compare=False)
    slices: int = 1
    policy: config.SplitPolicy = config.SPLIT
    #: Rows of the measured table.
    total: int = 0

    @property
    def any(self) -> bool:
        return bool(self.rows)

    def _joined(self, df: DataFrame, how: str) -> DataFrame:
        """``df`` with the hot keys, named k0, k1, ...; at most max_groups rows."""
        table = F.broadcast(df.sparkSession.createDataFrame(list(self.rows), self.schema))
        on = null_safe(df, table, [(k, f"k{i}") for i, k in enumerate(self.keys)])
        return df.join(table, on, how).select(df.columns)

    def hot_rows(self, df: DataFrame) -> DataFrame:
        return self._joined(df, "inner")

    def hot(self, df: DataFrame, order=None) -> DataFrame:
        """The rows of hot groups with the number of their slice, stored."""
        order = list(order or [self.order])
        rows = self.hot_rows(df).withColumn(_ROW, F.monotonically_increasing_id())
        cut = rows.repartitionByRange(self.slices, *self.keys, *order, _ROW).drop(_ROW)
        return stage(cut.withColumn(SLICE, F.spark_partition_id()), "slices")

    def cold(self, df: DataFrame) -> DataFrame:
        return self._joined(df, "left_anti") if self.any else df


def none(keys, order: str, total: int = 0) -> Splits:
    return Splits(tuple(keys), order, total=total)


def group_sizes(df: DataFrame, keys) -> tuple[int, int]:
    """Rows of the table and of its largest group: one narrow aggregate."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, largest = counts.agg(F.sum("_n"), F.max("_n")).first()
    return total or 0, largest or 0


def measure(
    df: DataFrame, keys, order: str, policy: config.SplitPolicy = config.SPLIT
) -> Splits:
    """Find hot groups: a row count, and for large tables one narrow aggregate of group sizes."""
    keys = tuple(keys)
    rows = df.count()  # reads file footers only, where it can
    if rows <= policy.min_rows:
        return none(keys, order, rows)
    total, largest = group_sizes(df, keys)
    if largest <= policy.min_rows:
        return none(keys, order, total)
    limit = max(policy.min_rows, math.ceil(total / policy.max_groups))
    if largest <= limit:
        return none(keys, order, total)

    names = [f"k{i}" for i in range(len(keys))]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > limit).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_n").alias("_hot_rows"))
    found = hot.collect()
    # Ranges are cut by a sample; half as large ones leave room for its error.
    slices = min(policy.max_slices, math.ceil(2 * sum(r["_hot_rows"] for r in found) / limit))
    return Splits(keys, order, tuple(tuple(r) for r in found), hot.schema, slices, policy, total)
