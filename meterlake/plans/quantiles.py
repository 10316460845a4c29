"""Exact quantiles with linear interpolation.

Small groups use ``percentile``, which keeps a group's distinct values in one
aggregation buffer.  Where a group is too large for that, two passes bracket the
wanted ranks.  The first takes a mergeable sketch of each group and column, whose
rank error is bounded: it gives a lower and an upper value around every rank.  The
second counts what lies below the bracket and keeps only the values inside, both
combined before the shuffle, so of a group of n rows some n / 2,000 values move for each
rank.  The rank is then found among those by a running count.  If a bracket
missed its rank, all are widened and the second pass is repeated; the widest
bracket holds every value.  Both forms interpolate with the same arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake import config
from meterlake.plans import ordered
from meterlake.plans.splits import group_sizes, measure, null_safe
from meterlake.plans.staging import stage

COLUMN = "column_name"
#: Accuracy of the sketch (its rank error is n divided by it), and the first bracket in such errors.
ACCURACY, REACH = 10_000, 2


def quantile_name(p: float) -> str:
    return f"q{int(round(p * 100)):02d}"


def _pick(p: float, mine: Column) -> Column:
    """The quantile from the rows of its bracket; NULL if its ranks are not among their values."""
    n, v = F.col("_total"), F.col("_v")
    first, last = F.col("_cum") - F.col("_n"), F.col("_cum")
    pos = (n - 1).cast("double") * F.lit(float(p))
    low, high = F.floor(pos), F.ceil(pos)
    lo = F.max(F.when(mine & (first <= low) & (low < last), v))
    hi = F.max(F.when(mine & (first <= high) & (high < last), v))
    mixed = F.max(high - pos) * lo + F.max(pos - low) * hi
    return F.when(lo == hi, lo).otherwise(mixed)


def long_quantiles(
    df: DataFrame, keys, columns, probs, policy: config.SplitPolicy = config.SPLIT
) -> DataFrame:
    """One row per group and column: keys, column_name, q25, q50, ...

    NULLs are ignored; a group without any value gives a row of NULLs.
    """
    keys, columns = list(keys), list(columns)
    values = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    _, largest = group_sizes(values, keys)
    if largest <= policy.map_rows:
        return _by_value_map(values, keys, columns, probs)
    return _by_bracket(values, keys, columns, probs, policy)


def _by_value_map(values, keys, columns, probs) -> DataFrame:
    marks = F.array(*[F.lit(float(p)) for p in probs])
    wide = values.groupBy(*keys).agg(*[F.percentile(c, marks).alias(c) for c in columns])
    cells = [
        F.struct(
            F.lit(c).alias(COLUMN),
            *[F.get(F.col(c), F.lit(i)).alias(quantile_name(p)) for i, p in enumerate(probs)],
        )
        for c in columns
    ]
    return wide.select(*keys, F.explode(F.array(*cells)).alias("_r")).select(*keys, "_r.*")


def _brackets(values: DataFrame, keys, columns, probs, reach: int) -> DataFrame:
    """One row per group: the number of values of each column, and per probability a bracket of its rank."""
    step = reach / ACCURACY
    grid = [x for p in probs for x in (max(0.0, p - step), min(1.0, p + step))]
    if reach >= ACCURACY:
        grid = [0.0, 1.0] * len(probs)
    infinity = F.lit(float("inf"))
    aggs = []
    for i, c in enumerate(columns):
        # The sketch orders numbers; NaN stands above them and shares the place of infinity.
        aggs += [F.count(c).alias(f"_n{i}"), F.percentile_approx(F.nanvl(F.col(c), infinity), grid, ACCURACY).alias(f"_m{i}")]
    return stage(values.groupBy(*keys).agg(*aggs), "brackets")


def _inside(values: DataFrame, brackets: DataFrame, keys, columns, probs) -> DataFrame:
    """Per group, column and probability: values inside the bracket with their number, and
    one row without a value that counts those below."""
    names = [f"_g{i}" for i in range(len(keys))]
    right = brackets.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], *[f"_m{i}" for i in range(len(columns))])
    if keys:
        joined = values.join(right, null_safe(values, right, zip(keys, names)), "left")
    else:
        joined = values.crossJoin(F.broadcast(right))  # one row
    cells = []
    for i, c in enumerate(columns):
        for j in range(len(probs)):
            low, high = F.get(f"_m{i}", F.lit(2 * j)), F.get(f"_m{i}", F.lit(2 * j + 1))
            high = F.when(high == float("inf"), F.lit(float("nan"))).otherwise(high)
            cell = F.struct(F.lit(i).alias("_c"), F.lit(j).alias("_p"), F.when(F.col(c) >= low, F.col(c)).alias("_v"))
            cells.append(F.when(F.col(c) <= high, cell))
    long = joined.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_x")).select(*keys, "_x.*")
    return stage(long.groupBy(*keys, "_c", "_p", "_v").agg(F.count(F.lit(1)).alias("_n")), "bracketed")


def _by_bracket(values, keys, columns, probs, policy) -> DataFrame:
    groups = [*keys, "_c", "_p"]
    reach = REACH
    while True:
        brackets = _brackets(values, keys, columns, probs, reach)
        inside = _inside(values, brackets, keys, columns, probs)
        upto = ordered.running(inside, groups, ["_v"], {"_cum": F.col("_n")}, measure(inside, groups, "_v", policy))
        sizes = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(f"_n{i}").alias("_total")) for i in range(len(columns))])).alias("_s")
        totals = brackets.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], sizes).select(*[f"_g{i}" for i in range(len(keys))], "_s.*")
        totals = totals.withColumnRenamed("_c", "_tc")
        on = null_safe(upto, totals, [*[(k, f"_g{i}") for i, k in enumerate(keys)], ("_c", "_tc")])
        ranked = upto.join(totals, on, "inner").drop(*[f"_g{i}" for i in range(len(keys))], "_tc")
        picks = [_pick(p, F.col("_p") == j).alias(f"_q{j}") for j, p in enumerate(probs)]
        found = stage(ranked.groupBy(*keys, "_c").agg(*picks, F.max("_total").alias("_total")), "quantiles")
        missed = F.lit(False)
        for j in range(len(probs)):
            missed = missed | F.col(f"_q{j}").isNull()
        if found.filter(missed).isEmpty() or reach >= ACCURACY:
            break
        reach = 20 * max(1, reach)
    # One row per group and column: those without a value are put back.
    marks = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.lit(c).alias(COLUMN)) for i, c in enumerate(columns)])).alias("_r")
    every = brackets.select(*keys, marks).select(*keys, "_r.*")
    names = [f"_g{i}" for i in range(len(keys) + 1)]
    right = found.select(
        *[F.col(g).alias(n) for g, n in zip((*keys, "_c"), names)], *[F.col(f"_q{j}").alias(quantile_name(p)) for j, p in enumerate(probs)]
    )
    joined = every.join(right, null_safe(every, right, zip((*keys, "_c"), names)), "left")
    return joined.select(*keys, COLUMN, *[quantile_name(p) for p in probs])


def group_quantiles(df, keys, column, probs, **kw) -> DataFrame:
    """Quantiles of one column per group: keys, q25, q50, ..."""
    return long_quantiles(df, keys, [column], probs, **kw).drop(COLUMN)


def wide_quantiles(
    df: DataFrame, columns, probs, policy: config.SplitPolicy = config.SPLIT
) -> DataFrame:
    """One row for the whole table: {column}_q25, ..."""
    columns = list(columns)
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    if group_sizes(values, [])[1] <= policy.map_rows:
        marks = F.array(*[F.lit(float(p)) for p in probs])
        row = values.agg(*[F.percentile(c, marks).alias(c) for c in columns])
        return row.selectExpr(
            *[
                f"get(`{c}`, {i}) AS `{c}_{quantile_name(p)}`"
                for c in columns
                for i, p in enumerate(probs)
            ]
        )
    long = _by_bracket(values, [], columns, probs, policy)
    picks = [
        F.max(F.when(F.col(COLUMN) == c, F.col(quantile_name(p)))).alias(f"{c}_{quantile_name(p)}")
        for c in columns
        for p in probs
    ]
    return long.agg(*picks)
