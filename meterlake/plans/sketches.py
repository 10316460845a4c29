"""Approximate quantiles and distinct counts from stored, mergeable sketches.

Opt-in beside the exact forms.  A sketch of some kilobytes is stored for every group and day;
weeks, months and coarser groups merge the stored sketches and read no readings again.  Merging
is associative, so a new day is one more row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.plans.quantiles import quantile_name

#: KLL size: a normalised rank error of some 0.65 % for a single quantile.
KLL_SIZE = 400
#: HyperLogLog registers, as a power of two: a relative error of some 0.8 %.
HLL_BITS = 14


def daily_sketches(df: DataFrame, keys, time: str, column: str, size: int = KLL_SIZE) -> DataFrame:
    """keys, day, n, sketch: one KLL sketch of the values per group and day; days without a value have none."""
    value = F.col(column).cast("double")
    day = F.to_date(time).alias("day")
    return df.filter(value.isNotNull()).groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(value, F.lit(size)).alias("sketch")
    )


def merged(sketches: DataFrame, keys, size: int = KLL_SIZE) -> DataFrame:
    """keys, n, sketch: stored sketches merged over coarser groups."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, probs, name: str = "sketch") -> DataFrame:
    """The sketch replaced by its quantiles q05, q50, ...: values of the data, ranks within the error."""
    picks = {quantile_name(p): F.kll_sketch_get_quantile_double(name, F.lit(float(p))) for p in probs}
    return sketches.withColumns(picks).drop(name)


def rank_within(df: DataFrame, keys, column: str, quantiles: DataFrame, probs, tolerance: float = 0.01) -> DataFrame:
    """keys, n, within: whether each quantile's exact rank interval comes within ``tolerance`` of its probability.

    Quantiles are one row per group, so the check is one narrow aggregate over the readings.
    """
    names = [quantile_name(p) for p in probs]
    joined = df.filter(F.col(column).isNotNull()).join(quantiles.select(*keys, *names), list(keys))
    n = F.count(F.lit(1))
    ok = F.lit(True)
    for p, q in zip(probs, names):
        below, upto = F.count_if(F.col(column) < F.col(q)), F.count_if(F.col(column) <= F.col(q))
        ok = ok & (below / n - tolerance <= p) & (upto / n + tolerance >= p)
    return joined.groupBy(*keys).agg(n.alias("n"), ok.alias("within"))


def distinct_sketch(column, bits: int = HLL_BITS) -> Column:
    """Aggregate: a HyperLogLog sketch of a column's values, NULL left out."""
    return F.hll_sketch_agg(column, F.lit(bits))


def merged_distinct(sketches: DataFrame, keys, name: str, alias: str) -> DataFrame:
    """keys and the estimate over all sketches of a group; groups without a sketch count zero."""
    merged_one = F.hll_sketch_estimate(F.hll_union_agg(name, F.lit(True)))
    return sketches.groupBy(*keys).agg(F.coalesce(merged_one, F.lit(0)).alias(alias))
