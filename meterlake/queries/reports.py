"""Queries on the star schema.

Facts are aggregated by their keys first; names are joined to the aggregate, so
no join moves the readings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.exact import exact_avg, exact_over, exact_sum, percentage, rounded
from meterlake.plans import ordered
from meterlake.plans.joins import with_group
from meterlake.plans.splits import measure
from meterlake.plans.staging import stage

P = "active_power_kw"


def _rows() -> Column:
    return F.count(F.lit(1))


def _anomalies() -> Column:
    return F.count_if(F.col("is_anomaly") == 1)


def _with_meter(df: DataFrame, meters: DataFrame) -> DataFrame:
    return with_group(df, meters.select("meter_id", "meter_name"), ["meter_id"])


def _with_zone(df: DataFrame, zones: DataFrame, *extra: str) -> DataFrame:
    return with_group(df, zones.select("zone_id", "zone_name", *extra), ["zone_id"])


# --- consumption ----------------------------------------------------------------


def daily_by_meter(fact: DataFrame, meters: DataFrame, zones: DataFrame) -> DataFrame:
    grouped = fact.groupBy(F.to_date("timestamp").alias("reading_date"), "meter_id", "zone_id").agg(
        exact_sum(P).alias("total_consumption_kwh"),
        exact_avg(P).alias("avg_power_kw"),
        F.max(P).alias("max_power_kw"),
        F.min(P).alias("min_power_kw"),
        rounded(F.stddev_samp(P), 6).alias("stddev_power_kw"),
        _rows().alias("reading_count"),
    )
    return _with_zone(_with_meter(grouped, meters), zones)


def monthly_trend(fact: DataFrame, meters: DataFrame, zones: DataFrame) -> DataFrame:
    """Monthly totals and the mean per day with readings; days are pre-aggregated."""
    dated = fact.filter(F.col("month").isNotNull() & F.col("year").isNotNull())
    days = dated.groupBy(
        "year", "month", "meter_id", "zone_id", F.to_date("timestamp").alias("_day")
    ).agg(exact_sum(P).alias("_s"), F.count(P).alias("_n"))
    months = days.groupBy("year", "month", "meter_id", "zone_id").agg(
        exact_sum("_s").alias("monthly_consumption_kwh"),
        F.try_divide(exact_sum("_s"), F.sum("_n")).alias("avg_power_kw"),
        F.count("_day").alias("days_in_month"),
    )
    out = months.withColumn(
        "avg_daily_kwh", F.try_divide("monthly_consumption_kwh", "days_in_month")
    )
    return _with_zone(_with_meter(out, meters), zones)


def year_over_year(fact: DataFrame, zones: DataFrame) -> DataFrame:
    """Monthly totals per zone, latest month first."""
    grouped = fact.groupBy("year", "month", "zone_id").agg(exact_sum(P).alias("monthly_kwh"))
    return _with_zone(grouped, zones).orderBy(F.desc("year"), F.desc("month"), "zone_id")


# --- peaks and load profile -------------------------------------------------------


def peak_by_season(fact: DataFrame, times: DataFrame) -> DataFrame:
    """Hour by season; facts are folded per timestamp before the time dimension joins."""
    v = F.col(P)
    folded = (
        fact.filter(F.col("hour_of_day").isNotNull())
        .groupBy("time_id", "hour_of_day")
        .agg(
            _rows().alias("_rows"),
            F.count(v).alias("_n"),
            exact_sum(v).alias("_s"),
            F.sum(v * v).alias("_q"),
            F.max(v).alias("_hi"),
            F.min(v).alias("_lo"),
            _anomalies().alias("_a"),
        )
    )
    joined = with_group(folded, times.select("time_id", "season"), ["time_id"])
    grouped = joined.groupBy("hour_of_day", "season").agg(
        F.sum("_rows").alias("reading_count"),
        F.sum("_n").alias("_n"),
        exact_sum("_s").alias("_s"),
        F.sum("_q").alias("_q"),
        F.max("_hi").alias("peak_load_kw"),
        F.min("_lo").alias("min_load_kw"),
        F.sum("_a").alias("anomaly_count"),
    )
    n, s = F.col("_n"), F.col("_s")
    spread = F.greatest(F.col("_q") - F.try_divide(s * s, n), F.lit(0.0))
    std = F.when(n > 1, F.sqrt(F.try_divide(spread, n - 1)))
    return grouped.select(
        "hour_of_day",
        "season",
        "reading_count",
        F.try_divide("_s", "_n").alias("avg_load_kw"),
        "peak_load_kw",
        "min_load_kw",
        rounded(std, 6).alias("stddev_load_kw"),
        "anomaly_count",
        percentage("anomaly_count", "reading_count").alias("anomaly_percentage"),
    ).orderBy("hour_of_day", "season")


def peak_share_by_meter(fact: DataFrame, meters: DataFrame) -> DataFrame:
    """Peak and off-peak totals with their share of the meter's total."""
    grouped = fact.groupBy("meter_id", "zone_id", "peak_hour_flag").agg(
        _rows().alias("reading_count"), exact_sum(P).alias("_s"), F.count(P).alias("_n")
    )
    # A few rows per meter reach this window.
    whole = exact_over("_s", Window.partitionBy("meter_id"))
    whole = F.when(F.col("meter_id").isNotNull(), whole)
    total = F.col("_s")
    out = grouped.select(
        "meter_id",
        "zone_id",
        F.when(F.col("peak_hour_flag") == 1, "Peak").otherwise("Off-Peak").alias("period_type"),
        "reading_count",
        total.alias("total_kwh"),
        F.try_divide(total, F.col("_n")).alias("avg_power_kw"),
        percentage(total, whole).alias("consumption_percentage"),
    )
    return _with_meter(out, meters)


def load_profile(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("hour_of_day").isNotNull() & F.col("day_of_week").isNotNull())
        .groupBy("hour_of_day", "day_of_week")
        .agg(
            _rows().alias("reading_count"),
            exact_avg(P).alias("avg_power_kw"),
            F.max(P).alias("max_power_kw"),
            F.min(P).alias("min_power_kw"),
        )
        .orderBy("day_of_week", "hour_of_day")
    )


# --- zones ------------------------------------------------------------------------


def zone_summary(fact: DataFrame, zones: DataFrame) -> DataFrame:
    per_meter = fact.groupBy("zone_id", "meter_id").agg(
        _rows().alias("_rows"),
        exact_sum(P).alias("_s"),
        F.count(P).alias("_n"),
        F.max(P).alias("_hi"),
        exact_sum("power_factor").alias("_pf"),
        F.count("power_factor").alias("_pfn"),
        exact_sum("frequency_hz").alias("_f"),
        F.count("frequency_hz").alias("_fn"),
    )
    grouped = per_meter.groupBy("zone_id").agg(
        F.count("meter_id").alias("meter_count"),
        F.sum("_rows").alias("total_readings"),
        exact_sum("_s").alias("total_consumption_kwh"),
        F.try_divide(exact_sum("_s"), F.sum("_n")).alias("avg_power_kw"),
        F.max("_hi").alias("peak_power_kw"),
        rounded(F.try_divide(exact_sum("_pf"), F.sum("_pfn")), 3).alias(
            "avg_power_factor"
        ),
        rounded(F.try_divide(exact_sum("_f"), F.sum("_fn")), 2).alias(
            "avg_frequency_hz"
        ),
    )
    return _with_zone(grouped, zones, "district")


def zone_by_hour(fact: DataFrame, zones: DataFrame) -> DataFrame:
    per_meter = (
        fact.filter(F.col("hour_of_day").isNotNull())
        .groupBy("zone_id", "hour_of_day", "meter_id")
        .agg(
            _rows().alias("_rows"),
            exact_sum(P).alias("_s"),
            F.count(P).alias("_n"),
            F.max(P).alias("_hi"),
        )
    )
    grouped = per_meter.groupBy("zone_id", "hour_of_day").agg(
        F.count("meter_id").alias("meter_count"),
        F.sum("_rows").alias("reading_count"),
        exact_sum("_s").alias("total_consumption_kwh"),
        F.try_divide(exact_sum("_s"), F.sum("_n")).alias("avg_power_kw"),
        F.max("_hi").alias("peak_power_kw"),
    )
    return _with_zone(grouped, zones).orderBy("zone_id", "hour_of_day")


def zone_comparison(summary: DataFrame) -> DataFrame:
    """Zones above or below the mean zone total.

    ``avg_consumption_per_meter`` keeps its established meaning, the zone's mean
    total; ``consumption_per_meter`` divides by the number of meters.
    """
    # One row per zone and district reaches the windows.
    zone = exact_over("total_consumption_kwh", Window.partitionBy("zone_id"))
    rows = F.count(F.lit(1)).over(Window.partitionBy("zone_id"))
    total = F.col("total_consumption_kwh")
    everywhere = Window.partitionBy()
    mean = F.try_divide(
        exact_over(total, everywhere), F.count("zone_id").over(everywhere)
    )
    return summary.select(
        "zone_id",
        "zone_name",
        "meter_count",
        "total_consumption_kwh",
        rounded(F.try_divide(zone, rows), 2).alias("avg_consumption_per_meter"),
        F.when(total > mean, "High").otherwise("Low").alias("consumption_level"),
        F.try_divide(total, F.col("meter_count")).alias("consumption_per_meter"),
    )


# --- anomalies --------------------------------------------------------------------


def _anomaly_counts(fact: DataFrame, *keys) -> DataFrame:
    grouped = fact.groupBy(*keys).agg(_rows().alias("total_readings"), _anomalies().alias("anomaly_count"))
    return grouped.withColumn("anomaly_percentage", percentage("anomaly_count", "total_readings"))


def anomalies_by_meter(fact: DataFrame, meters: DataFrame) -> DataFrame:
    return _with_meter(_anomaly_counts(fact, "meter_id", "zone_id"), meters)


def anomalies_by_day(fact: DataFrame) -> DataFrame:
    days = _anomaly_counts(fact, F.to_date("timestamp").alias("reading_date"))
    return days.orderBy(F.desc("reading_date"))


def top_anomalous_meters(fact: DataFrame, meters: DataFrame, n: int = 10) -> DataFrame:
    top = _anomaly_counts(fact, "meter_id", "zone_id")
    top = top.orderBy(F.desc("anomaly_count"), "meter_id", "zone_id").limit(n)
    return _with_meter(top, meters)


def data_quality_summary(fact: DataFrame) -> DataFrame:
    row = fact.agg(
        _rows().alias("total_readings"),
        F.count_if(F.col("voltage_v").isNull()).alias("null_voltage_count"),
        F.count_if(F.col("current_a").isNull()).alias("null_current_count"),
        _anomalies().alias("anomaly_count"),
    )
    return row.withColumn(
        "overall_anomaly_percentage", percentage("anomaly_count", "total_readings")
    )


# --- load categories --------------------------------------------------------------


def load_category_distribution(fact: DataFrame) -> DataFrame:
    """Categories with their share of all readings, those without category included."""
    grouped = fact.groupBy("load_category").agg(
        _rows().alias("reading_count"),
        exact_avg(P).alias("avg_power_kw"),
        F.max(P).alias("max_power_kw"),
        F.min(P).alias("min_power_kw"),
    )
    # One row per category reaches the window.
    whole = F.sum("reading_count").over(Window.partitionBy())
    return (
        grouped.withColumn("percentage_of_total", percentage("reading_count", whole))
        .filter(F.col("load_category").isNotNull())
        .orderBy(F.desc("reading_count"), "load_category")
    )


def load_category_by_meter(fact: DataFrame, meters: DataFrame) -> DataFrame:
    grouped = fact.groupBy("meter_id", "load_category").agg(_rows().alias("reading_count"))
    whole = F.sum("reading_count").over(Window.partitionBy("meter_id"))
    whole = F.when(F.col("meter_id").isNotNull(), whole)
    shares = grouped.withColumn("percentage", percentage("reading_count", whole))
    shares = shares.filter(F.col("load_category").isNotNull())
    return _with_meter(shares, meters).orderBy("meter_id", F.desc("reading_count"), "load_category")


# --- power quality ----------------------------------------------------------------


def power_factor_by_day(fact: DataFrame, low: float = 0.95) -> DataFrame:
    pf = F.col("power_factor")
    return (
        fact.groupBy(F.to_date("timestamp").alias("reading_date"), "zone_id")
        .agg(
            rounded(exact_avg(pf), 3).alias("avg_power_factor"),
            rounded(F.min(pf), 3).alias("min_power_factor"),
            rounded(F.max(pf), 3).alias("max_power_factor"),
            _rows().alias("reading_count"),
            F.count_if(pf < low).alias("low_power_factor_count"),
        )
        .orderBy(F.desc("reading_date"), "zone_id")
    )


def frequency_stability(fact: DataFrame, nominal: float = 50.0, tolerance: float = 0.5) -> DataFrame:
    f = F.col("frequency_hz")
    return fact.groupBy(F.to_date("timestamp").alias("reading_date"), "zone_id").agg(
        rounded(exact_avg(f), 3).alias("avg_frequency_hz"),
        rounded(F.stddev_samp(f), 3).alias("stddev_frequency"),
        rounded(F.min(f), 3).alias("min_frequency_hz"),
        rounded(F.max(f), 3).alias("max_frequency_hz"),
        F.count_if(F.abs(f - nominal) > tolerance).alias("out_of_spec_count"),
    )


def voltage_stability(fact: DataFrame, low: float = 190, high: float = 250) -> DataFrame:
    v = F.col("voltage_v")
    return fact.groupBy("zone_id").agg(
        rounded(exact_avg(v), 2).alias("avg_voltage_v"),
        rounded(F.stddev_samp(v), 2).alias("stddev_voltage"),
        rounded(F.min(v), 2).alias("min_voltage_v"),
        rounded(F.max(v), 2).alias("max_voltage_v"),
        F.count_if((v < low) | (v > high)).alias("out_of_spec_count"),
        _rows().alias("total_readings"),
    )


# --- rankings ---------------------------------------------------------------------


def _meter_totals(fact: DataFrame) -> DataFrame:
    return fact.groupBy("meter_id", "zone_id").agg(
        exact_sum(P).alias("total_consumption_kwh"),
        exact_avg(P).alias("avg_power_kw"),
        _rows().alias("reading_count"),
    )


def top_meters(fact: DataFrame, meters: DataFrame, zones: DataFrame, n: int = 10) -> DataFrame:
    top = _meter_totals(fact).orderBy(
        F.desc_nulls_last("total_consumption_kwh"), "meter_id", "zone_id"
    )
    return _with_zone(_with_meter(top.limit(n), meters), zones)


def bottom_meters(fact: DataFrame, meters: DataFrame, n: int = 10) -> DataFrame:
    low = _meter_totals(fact).orderBy(
        F.asc_nulls_first("total_consumption_kwh"), "meter_id", "zone_id"
    )
    return _with_meter(low.limit(n), meters)


def rank_in_zone(fact: DataFrame, meters: DataFrame) -> DataFrame:
    """Meters numbered by consumption in their zone; a zone of any size can be numbered."""
    totals = fact.groupBy("zone_id", "meter_id").agg(
        exact_sum(P).alias("zone_meter_consumption_kwh")
    )
    totals = stage(
        totals.withColumn("_key", -F.coalesce("zone_meter_consumption_kwh", F.lit(float("-inf")))),
        "zone-meters",
    )
    numbered = ordered.running(
        totals,
        ["zone_id"],
        ["_key", "meter_id"],
        {"rank_in_zone": F.lit(1)},
        measure(totals, ["zone_id"], "_key"),
    )
    return _with_meter(numbered.drop("_key"), meters).orderBy("zone_id", "rank_in_zone")


# --- seasons, weekdays, sub-meters, benchmarks --------------------------------------


def seasonal_totals(fact: DataFrame) -> DataFrame:
    """Season totals in calendar order: Winter, Summer, Monsoon, then the rest."""
    s = F.col("season")
    place = F.when(s == "Winter", 1).when(s == "Summer", 2).when(s == "Monsoon", 3).otherwise(4)
    return (
        fact.filter(s.isNotNull())
        .groupBy("season")
        .agg(
            _rows().alias("reading_count"),
            exact_sum(P).alias("seasonal_total_kwh"),
            exact_avg(P).alias("seasonal_avg_power_kw"),
            F.max(P).alias("seasonal_peak_power_kw"),
            rounded(exact_avg("outdoor_temp_c"), 2).alias("avg_outdoor_temp_c"),
        )
        .orderBy(place, "season")
    )


def weekday_totals(fact: DataFrame) -> DataFrame:
    names = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
    lookup = F.array(*[F.lit(n) for n in names])
    return (
        fact.filter(F.col("day_of_week").isNotNull())
        .groupBy("day_of_week")
        .agg(
            _rows().alias("reading_count"),
            exact_sum(P).alias("daily_total_kwh"),
            exact_avg(P).alias("daily_avg_power_kw"),
        )
        .withColumn("day_name", F.get(lookup, F.col("day_of_week")))
        .orderBy("day_of_week")
    )


def submeter_shares(fact: DataFrame, meters: DataFrame) -> DataFrame:
    grouped = fact.groupBy("meter_id", "zone_id").agg(
        exact_sum(P).alias("total_consumption_kwh"),
        exact_sum("sub_meter_kitchen").alias("kitchen_consumption_kwh"),
        exact_sum("sub_meter_hvac").alias("hvac_consumption_kwh"),
    )
    shares = grouped.withColumns(
        {
            f"{c}_percentage": percentage(f"{c}_consumption_kwh", "total_consumption_kwh")
            for c in ("kitchen", "hvac")
        }
    )
    return _with_meter(shares, meters).orderBy(
        F.desc_nulls_last("total_consumption_kwh"), "meter_id", "zone_id"
    )


def meter_vs_zone(fact: DataFrame, meters: DataFrame) -> DataFrame:
    """Meter mean against its zone's mean; the zone mean is folded from the meters."""
    grouped = fact.groupBy("meter_id", "zone_id").agg(
        exact_sum(P).alias("_s"), F.count(P).alias("_n")
    )
    zones = (
        grouped.filter(F.col("zone_id").isNotNull())
        .groupBy("zone_id")
        .agg(
            F.try_divide(exact_sum("_s"), F.sum("_n")).alias("zone_avg_power_kw")
        )
    )
    mean = F.try_divide(F.col("_s"), F.col("_n"))
    out = with_group(
        grouped.select("meter_id", "zone_id", mean.alias("meter_avg_power_kw")), zones, ["zone_id"]
    )
    gap = F.col("meter_avg_power_kw") - F.col("zone_avg_power_kw")
    out = out.withColumns(
        {
            "variance_kw": rounded(gap, 4),
            "performance_category": F.when(gap > 0, "Above Average").otherwise("Below Average"),
        }
    )
    return _with_meter(out, meters).orderBy(F.desc_nulls_last("variance_kw"), "meter_id", "zone_id")
