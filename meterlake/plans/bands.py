"""Joins of values with bands [low, high), however many bands there are.

``join_bands`` lists each row with each of its bands, as many rows as there are such pairs: where bands
overlap, these grow with rows times bands.  With ``totals`` it attaches aggregates of those bands instead, and no
pair is ever made: the distinct values are numbered in order, a band is a range of numbers, and a range is
the union of a few nodes of a binary tree over them (at most two a level).  Bands are aggregated by node, and a value
merges the nodes above it, one a level.  So rows grow with bands and values times the depth of the tree.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.plans.staging import stage


#: Levels below the root of a tree whose nodes are joined by broadcast: at most 2**UPPER of the lowest of them.
UPPER = 12


def _bin(value, level: Column) -> Column:
    """Number of the bin of width 2**level that holds the value."""
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")


def _distinct_values(df: DataFrame, value: str) -> DataFrame:
    return stage(df.select(F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL AND NOT isnan(_v)").distinct(), "band-values")


def band_matches(df: DataFrame, bands: DataFrame, value: str, low: str = "_lo", high: str = "_hi") -> DataFrame:
    """``value`` and the columns of ``bands`` for each distinct value of ``df`` and each band that holds it.

    An equi-join over bins.  A band goes to the level whose bins are at least as wide as it is (one level
    up, as the logarithm is rounded), so it touches two bins at most, and a value looks up one bin for each level in use (a few tens at
    most: widths are powers of two).  Ends without a bound are cut to the values that occur.  Values
    are made distinct first, so one that many rows share is looked up once.
    """
    values = _distinct_values(df, value)
    least, most = values.filter(F.abs("_v") < float("inf")).agg(F.min("_v"), F.max("_v")).first()
    if least is None:
        least = most = 0.0
    top = math.nextafter(most, math.inf)
    a = F.greatest(F.coalesce(F.col(low).cast("double"), F.lit(least)), F.lit(least))
    b = F.least(F.coalesce(F.col(high).cast("double"), F.lit(top)), F.lit(top))
    # Bands keep their own ends for the comparison; the cut ones only say which bins they touch.
    cut = bands.withColumns({"_a": a, "_b": b}).filter("_a < _b")
    # Bins are numbered in longs, so they are no finer than the numbers at the far end allow.
    finest = math.ceil(math.log2(max(abs(least), abs(top), 1e-300))) - 60
    level = F.greatest(F.ceil(F.log2(F.col("_b") - F.col("_a"))) + 1, F.lit(finest)).cast("int")
    levelled = cut.withColumn("_level", level)
    touched = F.array_distinct(F.array(_bin(F.col("_a"), F.col("_level")), _bin(F.col("_b"), F.col("_level"))))
    levelled = stage(levelled.withColumn("_bin", F.explode(touched)).drop("_a", "_b"), "band-bins")
    levels = [r[0] for r in levelled.select("_level").distinct().collect()]  # at most some 2,000 exponents
    if not levels:
        return values.withColumnRenamed("_v", value).join(bands, F.lit(False))
    looked = values.filter(F.abs("_v") < float("inf")).withColumn("_level", F.explode(F.array(*[F.lit(x) for x in sorted(levels)])))
    looked = looked.withColumn("_bin", _bin(F.col("_v"), F.col("_level")))
    held = (F.col(low).isNull() | (F.col("_v") >= F.col(low))) & (F.col(high).isNull() | (F.col("_v") < F.col(high)))
    near = looked.join(levelled, ["_level", "_bin"]).filter(held).drop("_level", "_bin")
    # Infinite values lie in bands without that end, which are not cut into bins for them.
    far = values.filter(F.abs("_v") == float("inf"))
    if not far.isEmpty():  # two values at most
        near = near.unionByName(far.join(bands, held).select(near.columns))
    return near.withColumnRenamed("_v", value)


def _places(values: DataFrame, ends: DataFrame) -> DataFrame:
    """_x, _place: for each value and each end, how many distinct values are smaller."""
    marks = values.select(F.col("_v").alias("_x"), F.lit(1).alias("_own")).union(ends.select("_x", F.lit(0)))
    marks = marks.groupBy("_x").agg(F.max("_own").alias("_own")).repartitionByRange("_x")
    marks = stage(marks.withColumn("_part", F.spark_partition_id()), "band-marks")
    parts = marks.groupBy("_part").agg(F.sum("_own").alias("_all"))  # one row a partition
    before = parts.select("_part", (F.sum("_all").over(Window.orderBy("_part")) - F.col("_all")).alias("_before"))
    inside = F.sum("_own").over(Window.partitionBy("_part").orderBy("_x"))
    counted = marks.withColumn("_inside", inside).join(F.broadcast(before), "_part")
    return stage(counted.select("_x", (F.col("_before") + F.col("_inside") - F.col("_own")).alias("_place")), "band-places")


def band_totals(
    df: DataFrame, bands: DataFrame, value: str, totals: dict[str, tuple[Column, Callable]], low: str = "_lo", high: str = "_hi"
) -> DataFrame:
    """``value`` and the ``totals`` over all bands that hold it, for each distinct value of ``df`` in any band.

    ``totals``: by name, an aggregate over the columns of ``bands`` and the function that merges such aggregates.
    """
    values = _distinct_values(df, value)
    # An open end is below or above all values; NaN stands above them in Spark's order, as it does in comparisons.
    lo = F.coalesce(F.col(low).cast("double"), F.lit(float("-inf")))
    hi = F.coalesce(F.col(high).cast("double"), F.lit(float("nan")))
    parts = [first.alias(f"_t{i}") for i, (first, _) in enumerate(totals.values())]
    merged = [merge(F.col(f"_t{i}")).alias(f"_t{i}") for i, (_, merge) in enumerate(totals.values())]
    spans = stage(bands.withColumns({"_a": lo, "_b": hi}).groupBy("_a", "_b").agg(*parts), "band-spans")
    place = _places(values, spans.select(F.col("_a").alias("_x")).union(spans.select("_b")).distinct())
    at = lambda end, name: place.select(F.col("_x").alias(end), F.col("_place").alias(name))
    ranges = spans.join(at("_a", "_i"), "_a").join(at("_b", "_j"), "_b").filter("_i < _j").drop("_a", "_b")
    top = values.count().bit_length()
    # At level k the range holds whole nodes from l to r; an odd l and the one before an odd r are not in a node above that it holds.
    nodes = f"""filter(flatten(transform(sequence(0, {top}), k -> transform(
        array(named_struct('l', -shiftright(-_i, k), 'r', shiftright(_j, k))), x -> array(
            IF(x.l < x.r AND x.l % 2 = 1, named_struct('_level', k, '_node', x.l), NULL),
            IF(x.l < x.r AND x.r % 2 = 1, named_struct('_level', k, '_node', x.r - 1), NULL)))[0])), x -> x IS NOT NULL)"""
    held = ranges.withColumn("_n", F.explode(F.expr(nodes))).groupBy("_n._level", "_n._node").agg(*merged)
    held = stage(held, "band-nodes")
    looked = values.join(at("_v", "_place"), "_v")
    above = lambda first, last: looked.select(
        "_v", F.explode(F.expr(f"transform(sequence({first}, {last}), k -> named_struct('_level', k, '_node', shiftright(_place, k)))")).alias("_n")
    ).select("_v", "_n.*")
    cut = max(0, top - UPPER)
    found = above(cut, top).join(F.broadcast(held.filter(F.col("_level") >= cut)), ["_level", "_node"])
    if cut:
        found = found.union(above(0, cut - 1).join(held.filter(F.col("_level") < cut), ["_level", "_node"]))
    found = found.groupBy("_v").agg(*merged)
    return found.select(F.col("_v").alias(value), *[F.col(f"_t{i}").alias(name) for i, name in enumerate(totals)])


def join_bands(
    df: DataFrame, bands: DataFrame, value: str, low: str = "_lo", high: str = "_hi", totals: dict[str, tuple[Column, Callable]] | None = None
) -> DataFrame:
    """Every row of ``df`` with each band that holds its value, or with NULLs; with ``totals`` (see
    ``band_totals``) once, with these over its bands, or with NULLs."""
    if totals is None:
        found = band_matches(df, bands, value, low, high).withColumnRenamed(value, "_found").drop(low, high)
    else:
        found = band_totals(df, bands, value, totals, low, high).withColumnRenamed(value, "_found")
    return df.join(found, df[value].cast("double") == found["_found"], "left").drop("_found")
