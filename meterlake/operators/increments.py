"""A further delivery of readings into a stored star schema: only what it touches is written.

Facts lie in folders by reading date.  A delivery's rows are compared with the stored facts of their own
dates only, and those that are not there yet are appended.  Aggregates lie in folders of the same grain:
the days that got fresh facts are computed again from the stored facts of those days, the months from the stored
days of those months, and replace their folders; others are not opened.  Dimensions get their missing rows appended.

The steps are ordered so that a delivery can simply be given again after a failure: facts that arrived are
not fresh any more, and the dates of all its rows, fresh or not, are aggregated again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import star
from meterlake.plans.splits import null_safe
from meterlake.plans.staging import stage

#: What tells two readings apart.
READING = ["timestamp", "meter_id"]
#: Days named in a filter; a delivery with more is compared over the span of its days.
MOST_DATES = 5_000
#: Up to so many keys that come more than once in a delivery are treated apart from its other rows.
MOST_COPIED = 1_000_000


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
    return spark.read.parquet(path) if there else None


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])


def _same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return null_safe(left, right, [(k, f"_k{i}") for i, k in enumerate(keys)])


def one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key.

    Whole rows are sorted to fold copies, so this is only done where there are some: their keys are found by a
    count of the keys alone.  Rows of all other keys stay where they are.
    """
    copied = stage(_named(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), keys), "copied")
    found = copied.count()
    if not found:
        return df
    if found > MOST_COPIED:
        return df.dropDuplicates(keys)
    same = _same_key(df, copied, keys)
    return df.join(copied, same, "left_anti").union(df.join(copied, same, "left_semi").dropDuplicates(keys))


def append_absent(spark: SparkSession, new: DataFrame, path: str, keys, within: Column | None = None, by: str | None = None) -> DataFrame:
    """Append the rows of ``new`` whose key is not stored yet; returns them.

    One row for each key, a NULL in a key equal to another.  ``within`` names the stored rows that can match, so that only
    their folders are read.
    """
    keys = list(keys)
    fresh = one_of_each(new, keys)
    old = _stored(spark, path)
    if old is not None:
        held = _named(old if within is None else old.filter(within), keys)
        fresh = fresh.join(held, _same_key(fresh, held, keys), "left_anti")
    fresh = stage(fresh, "fresh")
    rows = fresh.hint("rebalance", by) if by else fresh
    writer = rows.write.mode("append")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return fresh


def replace_folders(df: DataFrame, path: str, by) -> None:
    """Write ``df`` over the folders whose ``by`` values it has; the others stay."""
    by = list(by)
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _day_filter(days: list, column: str) -> Column:
    known = sorted(d for d in days if d is not None)
    if len(known) > MOST_DATES:
        cond = F.col(column).between(known[0], known[-1])
    else:
        cond = F.col(column).isin(known)
    return (cond | F.col(column).isNull()) if len(known) < len(days) else cond


def merge_delivery(spark: SparkSession, df: DataFrame, path: str) -> dict[str, int]:
    """Merge featured readings into the star schema at ``path`` and return how many facts are fresh and
    how many days were aggregated.  The first delivery builds it."""
    fact = star.fact_table(df).withColumn("reading_date", F.to_date("timestamp"))
    days = [r[0] for r in fact.select("reading_date").distinct().collect()]  # one row a day
    if not days:
        return {"facts": 0, "days": 0}
    fact_path = f"{path}/fact_energy_reading"
    fresh = append_absent(spark, fact, fact_path, READING, _day_filter(days, "reading_date"), "reading_date")
    for name, rows, key in (
        ("dim_meter", star.dim_meter(df), "meter_id"), ("dim_zone", star.dim_zone(df), "zone_id"), ("dim_time", star.dim_time(df), "time_id"),
    ):
        append_absent(spark, rows, f"{path}/{name}", [key])

    stored = spark.read.parquet(fact_path)
    touched = stored.filter(_day_filter(days, "reading_date"))
    replace_folders(star.agg_daily_consumption(touched.drop("reading_date")), f"{path}/agg_daily_consumption", ["reading_date"])
    hourly = star.agg_hourly_zone_consumption(touched).withColumn("reading_date", F.to_date("reading_hour"))
    replace_folders(hourly, f"{path}/agg_hourly_zone_consumption", ["reading_date"])
    months = {(d.year, d.month) if d is not None else None for d in days}
    whole = F.lit(False)
    for m in months:
        if m is None:
            whole = whole | F.col("reading_date").isNull()
        else:
            first = F.make_date(F.lit(m[0]), F.lit(m[1]), F.lit(1))
            whole = whole | F.col("reading_date").between(first, F.last_day(first))
    daily = spark.read.parquet(f"{path}/agg_daily_consumption")
    monthly = star.agg_monthly_consumption(daily=daily.filter(whole))
    replace_folders(monthly, f"{path}/agg_monthly_consumption", ["year", "month"])
    return {"facts": fresh.count(), "days": len(days)}
