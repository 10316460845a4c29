"""Analyses and the datasets behind the usual charts; each returns a small DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions import calendar, electrical
from meterlake.functions.exact import exact_avg, exact_over, exact_sum, rounded
from meterlake.operators.clean import METER, TIME, iqr_bounds, outside_bounds, time_order
from meterlake.plans.joins import attach_to_rows, with_scalars
from meterlake.plans.quantiles import group_quantiles, wide_quantiles

POWER, ZONE = "Active_Power_kW", "Zone_ID"


def _std(c=POWER):
    return rounded(F.stddev_samp(c), 6)


def _ends(df: DataFrame, label: str, value: str, top: str, bottom: str) -> DataFrame:
    """Labels and values at both ends; the smallest label on ties."""
    best = F.min(F.struct((-F.col(value)).alias("v"), F.col(label).alias("l")))
    worst = F.min(F.struct(F.col(value).alias("v"), F.col(label).alias("l")))
    row = df.filter(F.col(value).isNotNull()).agg(best.alias("b"), worst.alias("w"))
    return row.select(
        F.col("b.l").alias(top),
        (-F.col("b.v")).alias(f"{top}_avg"),
        F.col("w.l").alias(bottom),
        F.col("w.v").alias(f"{bottom}_avg"),
    )


# --- peak hours ---------------------------------------------------------------


def hourly_stats(df: DataFrame) -> DataFrame:
    return df.groupBy(F.hour(TIME).alias("hour")).agg(
        exact_avg(POWER).alias("mean"),
        _std().alias("std"),
        F.min(POWER).alias("min"),
        F.max(POWER).alias("max"),
        F.count(POWER).alias("count"),
    )


def peak_hours(df: DataFrame) -> DataFrame:
    """One row: the busiest and the quietest hour with their means."""
    return _ends(hourly_stats(df), "hour", "mean", "peak_hour", "off_peak_hour")


def top_hours(df: DataFrame, n: int = 5) -> DataFrame:
    ordered = hourly_stats(df).orderBy(F.desc_nulls_last("mean"), "hour")
    return ordered.select("hour", "mean").limit(n)


# --- zones and meters -----------------------------------------------------------


def zone_stats(df: DataFrame) -> DataFrame:
    """Per zone: count, mean, std, min, max, total and exact quartiles."""
    zones = df.filter(F.col(ZONE).isNotNull())
    basics = zones.groupBy(ZONE).agg(
        F.count(POWER).alias("count"),
        exact_avg(POWER).alias("mean"),
        _std().alias("std"),
        F.min(POWER).alias("min"),
        F.max(POWER).alias("max"),
        F.coalesce(exact_sum(POWER), F.lit(0.0)).alias("total"),
    )
    quartiles = group_quantiles(zones, [ZONE], POWER, [0.25, 0.75])
    return basics.join(quartiles, ZONE, "left")


def zone_ends(df: DataFrame) -> DataFrame:
    means = df.filter(F.col(ZONE).isNotNull()).groupBy(ZONE).agg(exact_avg(POWER).alias("mean"))
    return _ends(means, ZONE, "mean", "highest_zone", "lowest_zone")


def top_consumers(df: DataFrame, n: int = 20) -> DataFrame:
    """Meters by mean power, with their first zone and the sum of the shown means."""
    first_zone = F.min_by(ZONE, F.when(F.col(ZONE).isNotNull(), F.struct(*time_order(df))))
    stats = df.filter(F.col(METER).isNotNull()).groupBy(METER).agg(
        F.count(POWER).alias("records"),
        exact_avg(POWER).alias("mean"),
        _std().alias("std"),
        F.min(POWER).alias("min"),
        F.max(POWER).alias("max"),
        first_zone.alias(ZONE),
    )
    top = stats.orderBy(F.desc_nulls_last("mean"), METER).limit(n)
    # n rows reach this window.
    return top.withColumn(
        "total_top_consumption", exact_over("mean", Window.partitionBy())
    )


# --- anomalies ------------------------------------------------------------------


def anomaly_summary(df: DataFrame) -> DataFrame:
    """One row: quartile fences of power, how many readings lie outside, their statistics."""
    joined = with_scalars(df, iqr_bounds(df, [POWER]))
    out = outside_bounds(POWER)
    hit = F.when(out, F.col(POWER))
    first = {k: F.first(f"{POWER}_{k}", ignorenulls=True) for k in ("q25", "q75", "lower", "upper")}
    row = joined.agg(
        F.count_if(out).alias("total_anomalies"),
        F.count(F.lit(1)).alias("_rows"),
        first["lower"].alias("lower_bound"),
        first["upper"].alias("upper_bound"),
        first["q25"].alias("q1"),
        first["q75"].alias("q3"),
        F.coalesce(exact_avg(hit), F.lit(0.0)).alias("anomaly_mean"),
        F.coalesce(F.min(hit), F.lit(0.0)).alias("anomaly_min"),
        F.coalesce(F.max(hit), F.lit(0.0)).alias("anomaly_max"),
    )
    return row.select(
        "total_anomalies",
        rounded(F.try_divide(F.col("total_anomalies") * 100.0, F.col("_rows")), 6).alias(
            "anomaly_rate"
        ),
        "lower_bound",
        "upper_bound",
        "q1",
        "q3",
        (F.col("q3") - F.col("q1")).alias("iqr"),
        "anomaly_mean",
        "anomaly_min",
        "anomaly_max",
    )


def anomalies_by_zone(df: DataFrame) -> DataFrame:
    joined = with_scalars(df, iqr_bounds(df, [POWER]))
    return (
        joined.filter(outside_bounds(POWER) & F.col(ZONE).isNotNull())
        .groupBy(ZONE)
        .agg(F.count(F.lit(1)).alias("count"))
    )


# --- seasons, power factor, load profile ------------------------------------------


def monthly_stats(df: DataFrame) -> DataFrame:
    stats = df.groupBy(F.month(TIME).alias("month")).agg(
        exact_avg(POWER).alias("mean"), _std().alias("std")
    )
    return stats.withColumn("month_name", calendar.month_name("month"))


def quarterly_stats(df: DataFrame) -> DataFrame:
    return df.groupBy(F.quarter(TIME).alias("quarter")).agg(
        exact_avg(POWER).alias("mean"), _std().alias("std")
    )


def month_ends(df: DataFrame) -> DataFrame:
    """Best and worst month; the earlier one on ties."""
    ends = _ends(monthly_stats(df), "month", "mean", "highest_month", "lowest_month")
    return ends.withColumns(
        {c: calendar.month_name(c) for c in ("highest_month", "lowest_month")}
    )


def power_factor_stats(df: DataFrame, poor: float = 0.85) -> DataFrame:
    work = df
    if "power_factor" not in df.columns:
        work = df.withColumn("power_factor", electrical.power_factor(clipped=False))
    pf = F.col("power_factor")
    row = work.agg(
        rounded(exact_avg(pf), 6).alias("mean_pf"),
        _std("power_factor").alias("std_pf"),
        F.min(pf).alias("min_pf"),
        F.max(pf).alias("max_pf"),
        F.count_if(pf < poor).alias("poor_pf_records"),
        F.count(F.lit(1)).alias("_rows"),
    )
    median = wide_quantiles(work, ["power_factor"], [0.5])
    return with_scalars(row, median).select(
        "mean_pf",
        F.col("power_factor_q50").alias("median_pf"),
        "std_pf",
        "min_pf",
        "max_pf",
        "poor_pf_records",
        rounded(F.try_divide(F.col("poor_pf_records") * 100.0, F.col("_rows")), 6).alias(
            "poor_pf_percentage"
        ),
    )


def load_profile(df: DataFrame) -> DataFrame:
    """Mean power by weekday (Monday = 0) and hour."""
    ts = F.col(TIME)
    return (
        df.filter(ts.isNotNull())
        .groupBy(
            calendar.weekday_monday0(ts).alias("day_of_week"),
            F.hour(ts).alias("hour"),
            calendar.day_name(ts).alias("day_name"),
        )
        .agg(exact_avg(POWER).alias("mean"))
    )


def weekday_weekend(df: DataFrame) -> DataFrame:
    day = calendar.weekday_monday0(TIME)
    return df.agg(
        exact_avg(F.when(day < 5, F.col(POWER))).alias("weekday_avg"),
        exact_avg(F.when(day >= 5, F.col(POWER))).alias("weekend_avg"),
    )


def run_all_analyses(df: DataFrame) -> dict[str, DataFrame]:
    """Every analysis, as lazy DataFrames by name."""
    return {
        "peak_hours": peak_hours(df),
        "top_hours": top_hours(df),
        "hourly_summary": hourly_stats(df),
        "zone_analysis": zone_stats(df),
        "zone_ends": zone_ends(df),
        "top_consumers": top_consumers(df),
        "anomalies": anomaly_summary(df),
        "anomalies_by_zone": anomalies_by_zone(df),
        "monthly": monthly_stats(df),
        "quarterly": quarterly_stats(df),
        "month_ends": month_ends(df),
        "power_factor": power_factor_stats(df),
        "load_profile": load_profile(df),
        "weekday_weekend": weekday_weekend(df),
    }


# --- datasets behind the charts ---------------------------------------------------


def hourly_band(df: DataFrame) -> DataFrame:
    """Hourly mean with one standard deviation either side."""
    stats = df.groupBy(F.hour(TIME).alias("hour")).agg(
        exact_avg(POWER).alias("mean"), _std().alias("std")
    )
    return stats.select(
        "hour",
        "mean",
        "std",
        rounded(F.col("mean") - F.col("std"), 6).alias("band_low"),
        rounded(F.col("mean") + F.col("std"), 6).alias("band_high"),
    )


def by_day_of_month(df: DataFrame) -> DataFrame:
    """Mean and count per day of month; the top day is marked (first on ties)."""
    stats = df.groupBy(F.dayofmonth(TIME).alias("day_of_month")).agg(
        exact_avg(POWER).alias("mean"), F.count(POWER).alias("count")
    )
    # At most 31 rows reach this window.
    first = F.row_number().over(Window.orderBy(F.desc_nulls_last("mean"), "day_of_month"))
    return stats.withColumn("is_top_day", (first == 1).cast("int"))


def by_date(df: DataFrame, n: int | None = 30, order: str = "first") -> DataFrame:
    """Mean power per date; ``order`` takes the first or the last ``n`` dates."""
    stats = df.groupBy(F.to_date(TIME).alias("date")).agg(exact_avg(POWER).alias("mean"))
    if n is None:
        return stats
    return stats.orderBy(F.asc("date") if order == "first" else F.desc("date")).limit(n)


def monthly_mean(df: DataFrame) -> DataFrame:
    return monthly_stats(df).select("month", "month_name", "mean")


def zone_mean_std(df: DataFrame) -> DataFrame:
    return df.filter(F.col(ZONE).isNotNull()).groupBy(ZONE).agg(
        exact_avg(POWER).alias("mean"), _std().alias("std")
    )


def peak_comparison(df: DataFrame, preset: str = "extended") -> DataFrame:
    """Peak and off-peak: mean, std, count and the five box-plot numbers with whiskers."""
    work = df.withColumn(
        "period", F.when(calendar.is_peak(F.hour(TIME), preset), "Peak").otherwise("Off-Peak")
    )
    return box_stats(work, "period")


def box_stats(df: DataFrame, key: str, value: str = POWER, multiplier=config.IQR_MULTIPLIER) -> DataFrame:
    """Quartiles and whiskers: the furthest values within 1.5 IQR of the box."""
    basics = df.groupBy(key).agg(
        exact_avg(value).alias("mean"), _std(value).alias("std"), F.count(value).alias("count")
    )
    q = group_quantiles(df, [key], value, [0.25, 0.5, 0.75])
    reach = multiplier * (F.col("q75") - F.col("q25"))
    inside = (F.col(value) >= F.col("q25") - reach) & (F.col(value) <= F.col("q75") + reach)
    whiskers = (
        attach_to_rows(df.select(key, value), q, [key])
        .groupBy(key)
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        )
    )
    return basics.join(q, key, "left").join(whiskers, key, "left")


def histogram(df: DataFrame, column: str = POWER, bins: int = 50) -> DataFrame:
    """Equal-width bins between the smallest and largest value; empty bins are kept."""
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).alias("_v"))
    ends = values.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = F.when(width > 0, F.floor((F.col("_v") - F.col("_lo")) / width)).otherwise(0)
    counts = (
        with_scalars(values, ends)
        .groupBy(F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    grid = ends.select(
        "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).filter(F.col("_lo").isNotNull())
    return grid.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("_lo") + width * F.col("bin")).alias("bin_low"),
        (F.col("_lo") + width * (F.col("bin") + 1)).alias("bin_high"),
        F.coalesce("_n", F.lit(0)).alias("count"),
    )


def five_statistics(df: DataFrame, column: str) -> DataFrame:
    """One row: mean, std, min, max and median of a column."""
    row = df.agg(
        exact_avg(column).alias("mean"),
        _std(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    median = wide_quantiles(df, [column], [0.5])
    return with_scalars(row, median).withColumnRenamed(f"{column}_q50", "median")


def anomaly_overview(df: DataFrame) -> DataFrame:
    """Per zone: flagged readings and their share of all flagged; uses a flag if present."""
    if "is_anomaly" in df.columns:
        flagged = df.filter(F.col("is_anomaly").cast("int") == 1)
    else:
        joined = with_scalars(df, iqr_bounds(df, [POWER]))
        flagged = joined.filter(outside_bounds(POWER))
    by_zone = flagged.groupBy(ZONE).agg(F.count(F.lit(1)).alias("anomaly_count"))
    share = F.col("anomaly_count") * 100.0 / F.sum("anomaly_count").over(Window.partitionBy())
    # One row per zone reaches the window.
    return by_zone.select(ZONE, "anomaly_count", rounded(share, 6).alias("share_percentage"))


def top_meters(df: DataFrame, n: int = 10) -> DataFrame:
    means = df.filter(F.col(METER).isNotNull()).groupBy(METER).agg(exact_avg(POWER).alias("mean"))
    return means.orderBy(F.desc_nulls_last("mean"), METER).limit(n)


def hourly_mean(df: DataFrame, column: str, name: str = "mean", how: str = "avg") -> DataFrame:
    agg = exact_avg(column) if how == "avg" else F.max(column)
    return df.groupBy(F.hour(TIME).alias("hour")).agg(agg.alias(name))


def reactive_pairs(df: DataFrame, fraction: float = 0.1, seed: int = config.SAMPLE_SEED) -> DataFrame:
    """Sampled active and reactive power pairs for a scatter chart."""
    pairs = df.select(POWER, "Reactive_Power_kW").dropna()
    return pairs if fraction >= 1 else pairs.sample(False, fraction, seed)


def overview(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total_records"), F.count_distinct(ZONE).alias("zones"))
