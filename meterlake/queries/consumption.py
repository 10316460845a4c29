"""Queries on the flat readings table: consumption, peaks, rankings, spikes.

Windows that follow an aggregate run over its (small) result.  Windows over raw
readings go through ``plans.ordered`` and stay bounded for very long series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions import calendar, electrical
from meterlake.functions.exact import (
    exact_avg,
    exact_over,
    exact_sum,
    growth_percent,
    joined,
    lanes,
    percentage,
    rounded,
)
from meterlake.operators.clean import METER, TIME, time_order
from meterlake.plans import ordered
from meterlake.plans.joins import attach_to_rows, with_group, with_scalars
from meterlake.plans.quantiles import group_quantiles, wide_quantiles
from meterlake.plans.splits import measure
from meterlake.plans.staging import stage

POWER, ZONE = "Active_Power_kW", "Zone_ID"


def _rows() -> Column:
    return F.count(F.lit(1))


def _all() -> "Window":
    """Window over an aggregated result of calendar or zone size."""
    return Window.partitionBy()


def _global_mean(df: DataFrame) -> DataFrame:
    return df.agg(exact_avg(POWER).alias("_gmean"))


def _rms(n, s, q, mean) -> Column:
    """Root mean square distance from ``mean``, from count, sum and sum of squares."""
    spread = q - 2 * mean * s + n * mean * mean
    return F.sqrt(F.greatest(F.try_divide(spread, n), F.when(n > 0, F.lit(0.0))))


# --- catalogue of plain aggregates ------------------------------------------------


def hourly_consumption(df: DataFrame) -> DataFrame:
    hour = F.date_format(calendar.trunc("hour", TIME), "yyyy-MM-dd HH:mm:ss")
    return (
        df.groupBy(hour.alias("hour_bucket"))
        .agg(
            rounded(exact_avg(POWER), 2).alias("hourly_avg_power"),
            F.max(POWER).alias("hourly_max_power"),
            F.min(POWER).alias("hourly_min_power"),
            _rows().alias("record_count"),
        )
        .orderBy(F.desc("hour_bucket"))
    )


def daily_consumption(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(
            F.to_date(TIME).alias("consumption_date"),
        )
        .agg(
            rounded(exact_sum(POWER), 2).alias("daily_total_power"),
            rounded(exact_avg(POWER), 2).alias("daily_avg_power"),
            F.max(POWER).alias("peak_power"),
            F.min(POWER).alias("min_power"),
        )
        .withColumn("day_name", calendar.day_name("consumption_date"))
        .orderBy(F.desc("consumption_date"))
    )


def zone_analysis(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col(ZONE).isNotNull())
        .groupBy(ZONE)
        .agg(
            rounded(exact_avg(POWER), 2).alias("Avg_Power_kW"),
            rounded(F.max(POWER), 2).alias("Max_Power_kW"),
            rounded(F.min(POWER), 2).alias("Min_Power_kW"),
            _rows().alias("Record_Count"),
        )
        .orderBy(F.desc_nulls_last("Avg_Power_kW"), ZONE)
    )


def top_consumers(df: DataFrame, n: int = 20) -> DataFrame:
    return (
        df.groupBy(METER, ZONE)
        .agg(
            _rows().alias("record_count"),
            rounded(exact_avg(POWER), 3).alias("avg_power_kw"),
            rounded(F.max(POWER), 3).alias("peak_power_kw"),
            rounded(exact_sum(POWER), 2).alias("total_power_kwh"),
        )
        .orderBy(F.desc_nulls_last("avg_power_kw"), METER, ZONE)
        .limit(n)
    )


def peak_hours(df: DataFrame, preset: str = "standard") -> DataFrame:
    return (
        df.groupBy(F.hour(TIME).alias("hour_of_day"))
        .agg(
            _rows().alias("record_count"),
            rounded(exact_avg(POWER), 2).alias("avg_power_during_hour"),
            rounded(F.max(POWER), 2).alias("max_power_during_hour"),
        )
        .withColumn(
            "period_classification",
            F.when(calendar.is_peak("hour_of_day", preset), "Peak").otherwise("Off-Peak"),
        )
        .orderBy("hour_of_day")
    )


def anomaly_counts(df: DataFrame, band_kw: float = 2 * 1.5) -> DataFrame:
    """Readings above and below a fixed band around the overall mean, per meter."""
    v, mean = F.col(POWER), F.col("_gmean")
    off = v - mean
    return (
        with_scalars(df, _global_mean(df))
        .filter(F.col(METER).isNotNull())
        .groupBy(METER, ZONE)
        .agg(
            _rows().alias("total_readings"),
            rounded(exact_avg(POWER), 2).alias("avg_power_kw"),
            rounded(F.sqrt(F.avg(off * off)), 2).alias("stddev_power_kw"),
            F.count_if(v > mean + band_kw).alias("high_anomalies"),
            F.count_if(v < mean - band_kw).alias("low_anomalies"),
        )
    )


def power_factor_by_meter(df: DataFrame) -> DataFrame:
    pf = F.col("power_factor")
    return (
        df.filter(pf.isNotNull())
        .groupBy(METER)
        .agg(
            rounded(exact_avg(pf), 3).alias("avg_power_factor"),
            rounded(F.max(pf), 3).alias("max_power_factor"),
            rounded(F.min(pf), 3).alias("min_power_factor"),
            _rows().alias("reading_count"),
        )
        .orderBy("avg_power_factor", METER)
    )


def quarterly_totals(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(
            F.date_format(TIME, "yyyy").alias("year"), calendar.quarter_label(TIME).alias("quarter")
        )
        .agg(
            rounded(exact_sum(POWER), 2).alias("quarterly_consumption"),
            rounded(exact_avg(POWER), 2).alias("avg_power_kw"),
            _rows().alias("reading_count"),
        )
        .orderBy("year", "quarter")
    )


def daily_average(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(F.date_format(TIME, "yyyy-MM-dd").alias("date"))
        .agg(
            rounded(exact_avg(POWER), 2).alias("daily_avg"),
            _rows().alias("readings_per_day"),
        )
        .orderBy(F.desc("date"))
    )


def daily_by_meter_latest(df: DataFrame, n: int = 1000) -> DataFrame:
    return (
        df.groupBy(F.to_date(TIME).alias("reading_date"), METER)
        .agg(
            rounded(exact_avg(POWER), 2).alias("hourly_avg"),
            F.max(POWER).alias("hourly_max"),
            F.min(POWER).alias("hourly_min"),
        )
        .orderBy(F.desc("reading_date"), METER)
        .limit(n)
    )


def cumulative_consumption(df: DataFrame) -> DataFrame:
    daily = df.groupBy(F.to_date(TIME).alias("reading_date")).agg(exact_sum(POWER).alias("_s"))
    # One row per date reaches the window.
    so_far = exact_over("_s", Window.orderBy("reading_date"))
    return daily.select(
        "reading_date",
        rounded("_s", 2).alias("daily_consumption"),
        rounded(so_far, 2).alias("cumulative_consumption"),
    ).orderBy("reading_date")


def _moments(df: DataFrame, *keys) -> DataFrame:
    """Counts, exact sum and sum of squares per group, with the overall mean.

    The overall mean is folded from the groups, so the readings are read once.
    The window covers one row per zone or date.
    """
    v = F.col(POWER)
    grouped = df.groupBy(*keys).agg(
        _rows().alias("_rows"),
        F.count(v).alias("_n"),
        exact_sum(v).alias("_s"),
        F.sum(v * v).alias("_q"),
        F.max(v).alias("_hi"),
        F.min(v).alias("_lo"),
    )
    overall = F.try_divide(
        exact_over("_s", _all()), F.sum("_n").over(_all())
    ).alias("_gmean")
    return grouped.select("*", overall)


def zone_statistics(df: DataFrame) -> DataFrame:
    """Zone totals with the spread around the overall mean, and distinct meters."""
    v = F.col(POWER)
    per_meter = df.groupBy(ZONE, METER).agg(
        _rows().alias("_rows"),
        F.count(v).alias("_n"),
        exact_sum(v).alias("_s"),
        F.sum(v * v).alias("_q"),
        F.max(v).alias("_hi"),
        F.min(v).alias("_lo"),
    )
    zones = per_meter.groupBy(ZONE).agg(
        F.count(METER).alias("meter_count"),
        F.sum("_rows").alias("total_readings"),
        F.sum("_n").alias("_n"),
        exact_sum("_s").alias("_s"),
        F.sum("_q").alias("_q"),
        F.max("_hi").alias("_hi"),
        F.min("_lo").alias("_lo"),
    )
    s = F.col("_s")
    mean = F.try_divide(exact_over("_s", _all()), F.sum("_n").over(_all()))
    return (
        zones.select("*", mean.alias("_gmean"))
        .filter(F.col(ZONE).isNotNull())
        .select(
            ZONE,
            "meter_count",
            "total_readings",
            rounded(F.try_divide(s, F.col("_n")), 2).alias("avg_power_kw"),
            rounded(_rms(F.col("_n"), s, F.col("_q"), F.col("_gmean")), 2).alias("stddev_power_kw"),
            rounded("_hi", 2).alias("peak_power_kw"),
            rounded("_lo", 2).alias("min_power_kw"),
        )
        .orderBy(F.desc_nulls_last("avg_power_kw"), ZONE)
    )


def efficiency_ratings(df: DataFrame) -> DataFrame:
    pf = F.col("power_factor")
    grouped = (
        df.filter(pf.isNotNull())
        .groupBy(METER, ZONE)
        .agg(
            _rows().alias("total_readings"),
            rounded(exact_avg(POWER), 2).alias("avg_power"),
            rounded(exact_avg("Reactive_Power_kW"), 2).alias("avg_reactive"),
            exact_avg(pf).alias("_pf"),
        )
    )
    return grouped.select(
        METER,
        ZONE,
        "total_readings",
        "avg_power",
        "avg_reactive",
        rounded("_pf", 3).alias("avg_power_factor"),
        electrical.rated("_pf", config.METER_PF_RATING).alias("efficiency_score"),
    )


def consumption_spikes(df: DataFrame, factor: float = 1.5, n: int = 500) -> DataFrame:
    """Meter-days whose peak exceeds ``factor`` times the overall mean, largest jump first."""
    days = (
        df.filter(F.col(METER).isNotNull())
        .groupBy(METER, F.to_date(TIME).alias("spike_date"))
        .agg(
            F.min(ZONE).alias(ZONE),
            F.max(POWER).alias("peak_power"),
            exact_avg(POWER).alias("_avg"),
        )
    )
    return (
        with_scalars(days, _global_mean(df))
        .filter(F.col("peak_power") > F.col("_gmean") * factor)
        .select(
            METER,
            ZONE,
            "spike_date",
            "peak_power",
            rounded("_avg", 2).alias("avg_power_that_day"),
            rounded(F.col("peak_power") - F.col("_avg"), 2).alias("spike_magnitude"),
        )
        .orderBy(F.desc_nulls_last("spike_magnitude"), METER, "spike_date")
        .limit(n)
    )


def load_volatility(df: DataFrame) -> DataFrame:
    s = F.col("_s")
    return (
        _moments(df, F.to_date(TIME).alias("reading_date"))
        .select(
            "reading_date",
            rounded(_rms(F.col("_n"), s, F.col("_q"), F.col("_gmean")), 2).alias(
                "daily_volatility"
            ),
            rounded(F.try_divide(s, F.col("_n")), 2).alias("daily_avg"),
            rounded("_hi", 2).alias("daily_peak"),
            F.col("_rows").alias("readings"),
        )
        .orderBy(F.desc_nulls_last("daily_volatility"), "reading_date")
    )


# --- trends, rankings and comparisons ----------------------------------------------


def hourly_trend(df: DataFrame) -> DataFrame:
    """Hourly figures with the mean of this and the 24 preceding hours that have readings."""
    hourly = df.groupBy(calendar.trunc("hour", TIME).alias("hour_bucket")).agg(
        exact_avg(POWER).alias("hourly_avg_power"),
        F.max(POWER).alias("hourly_max_power"),
        F.min(POWER).alias("hourly_min_power"),
        _rows().alias("record_count"),
    )
    # One row per hour of the calendar reaches the window.
    w = Window.orderBy("hour_bucket").rowsBetween(-24, 0)
    return hourly.withColumn(
        "moving_avg_24h", rounded(_window_avg("hourly_avg_power", w), 2)
    ).orderBy(F.desc("hour_bucket"))


def _window_avg(c: str, w) -> Column:
    total = exact_over(c, w)
    return F.try_divide(total, F.count(c).over(w))


def daily_by_weekday(df: DataFrame) -> DataFrame:
    """Daily figures with the weekday, Sunday = 0."""
    return (
        df.groupBy(F.to_date(TIME).alias("consumption_date"))
        .agg(
            exact_sum(POWER).alias("daily_total_power"),
            exact_avg(POWER).alias("daily_avg_power"),
            rounded(F.stddev_pop(POWER), 6).alias("daily_stddev"),
            F.max(POWER).alias("peak_power"),
            F.min(POWER).alias("min_power"),
        )
        .withColumns(
            {
                "day_of_week": calendar.weekday_sunday0("consumption_date"),
                "day_name": calendar.day_name("consumption_date"),
            }
        )
        .orderBy(F.desc("consumption_date"))
    )


def zone_ranking(df: DataFrame) -> DataFrame:
    v = F.col(POWER)
    zones = df.groupBy(ZONE).agg(
        _rows().alias("total_records"),
        F.count(v).alias("_n"),
        exact_sum(v).alias("_s"),
        rounded(F.max(v), 2).alias("peak_power_kw"),
        rounded(F.min(v), 2).alias("min_power_kw"),
        rounded(F.stddev_pop(v), 2).alias("stddev_power"),
    )
    mean = F.try_divide(F.col("_s"), F.col("_n"))
    overall = F.try_divide(exact_over("_s", _all()), F.sum("_n").over(_all()))
    # One row per zone reaches the windows.
    return (
        zones.select("*", mean.alias("_avg"), overall.alias("_gmean"))
        .select(
            ZONE,
            "total_records",
            rounded("_avg", 2).alias("avg_power_kw"),
            "peak_power_kw",
            "min_power_kw",
            "stddev_power",
            F.rank().over(Window.orderBy(F.desc_nulls_last("_avg"))).alias("consumption_rank"),
            rounded(F.try_divide("_avg", "_gmean") * 100.0, 2).alias("percentage_of_avg"),
        )
        .orderBy("consumption_rank", ZONE)
    )


def top_meters_ranked(df: DataFrame, n: int = 20) -> DataFrame:
    """Top meters with rank, share of the overall mean and a class by overall percentiles.

    The rank is taken over the top rows only: rounding keeps the order, so rows
    beyond the limit cannot come before them.
    """
    top = (
        df.groupBy(METER, ZONE)
        .agg(
            _rows().alias("record_count"),
            exact_avg(POWER).alias("_avg"),
            rounded(F.max(POWER), 3).alias("peak_power_kw"),
            rounded(exact_sum(POWER), 2).alias("total_power_kwh"),
        )
        .orderBy(F.desc_nulls_last("_avg"), METER, ZONE)
        .limit(n)
    )
    marks = wide_quantiles(df, [POWER], [0.5, 0.75, 0.95])
    out = with_scalars(with_scalars(top, marks), _global_mean(df))
    a = F.col("_avg")
    return out.select(
        METER,
        ZONE,
        "record_count",
        rounded("_avg", 3).alias("avg_power_kw"),
        "peak_power_kw",
        "total_power_kwh",
        F.rank().over(Window.orderBy(F.desc_nulls_last("_avg"))).alias("meter_rank"),
        rounded(F.try_divide("_avg", "_gmean") * 100.0, 2).alias("percentage_of_global_avg"),
        F.when(a > F.col(f"{POWER}_q95"), "VeryHigh")
        .when(a > F.col(f"{POWER}_q75"), "High")
        .when(a > F.col(f"{POWER}_q50"), "Medium")
        .otherwise("Low")
        .alias("consumption_category"),
    ).orderBy(F.desc_nulls_last("avg_power_kw"), METER, ZONE)


def peak_hours_ranked(df: DataFrame) -> DataFrame:
    """Hours ranked by demand: five peak hours, then mid-peak to twelve, then off-peak."""
    hours = df.withColumn("hour_of_day", F.hour(TIME))
    stats = hours.groupBy("hour_of_day").agg(
        _rows().alias("record_count"),
        exact_avg(POWER).alias("_avg"),
        rounded(F.max(POWER), 2).alias("max_power_during_hour"),
    )
    p95 = group_quantiles(hours, ["hour_of_day"], POWER, [0.95])
    rank = F.rank().over(Window.orderBy(F.desc_nulls_last("_avg")))  # 24 rows
    return (
        stats.join(p95, "hour_of_day", "left")
        .select(
            "hour_of_day",
            "record_count",
            rounded("_avg", 2).alias("avg_power_during_hour"),
            "max_power_during_hour",
            rounded("q95", 2).alias("p95_power"),
            rank.alias("peak_rank"),
        )
        .withColumn(
            "period_classification",
            F.when(F.col("peak_rank") <= 5, "Peak")
            .when(F.col("peak_rank") <= 12, "Mid-Peak")
            .otherwise("Off-Peak"),
        )
        .orderBy("hour_of_day")
    )


def daily_change_by_meter(df: DataFrame) -> DataFrame:
    """Daily consumption next to the meter's previous and next day with readings."""
    daily = df.groupBy(METER, calendar.trunc("day", TIME).alias("day_bucket")).agg(
        exact_sum(POWER).alias("_s")
    )
    w = Window.partitionBy(METER).orderBy("day_bucket")
    prev = F.lag("_s").over(w)
    return daily.select(
        METER,
        "day_bucket",
        rounded("_s", 2).alias("daily_consumption"),
        rounded(prev, 2).alias("prev_day_consumption"),
        rounded(growth_percent("_s", prev), 2).alias("percent_change"),
        F.lead("_s").over(w).alias("next_day_consumption"),
    ).orderBy(METER, F.desc("day_bucket"))


def meter_iqr_anomalies(df: DataFrame, n: int = 100, multiplier=config.IQR_MULTIPLIER) -> DataFrame:
    """Latest readings outside the fences of their own meter."""
    q = group_quantiles(df, [METER], POWER, [0.25, 0.75])
    span = F.col("q75") - F.col("q25")
    bounds = q.select(
        METER,
        F.col("q25").alias("Q1"),
        F.col("q75").alias("Q3"),
        span.alias("IQR"),
        (F.col("q25") - multiplier * span).alias("LOWER_BOUND"),
        (F.col("q75") + multiplier * span).alias("UPPER_BOUND"),
    )
    v = F.col(POWER)
    rows = df.select(METER, TIME, POWER, ZONE, *[c for c in time_order(df) if c != TIME])
    low, high = v < F.col("LOWER_BOUND"), v > F.col("UPPER_BOUND")
    return (
        attach_to_rows(rows, bounds, [METER], null_keys=True)
        .filter(low | high)
        .orderBy(F.desc(TIME), METER, *[c for c in time_order(df) if c != TIME])
        .limit(n)
        .select(
            METER,
            TIME,
            POWER,
            ZONE,
            "Q1",
            "Q3",
            "IQR",
            "LOWER_BOUND",
            "UPPER_BOUND",
            F.when(low, "Below-Normal").when(high, "Above-Normal").otherwise("Normal").alias("status"),
            F.abs(v - F.col("Q3")).alias("distance_from_q3"),
        )
    )


def poor_power_factor(df: DataFrame, poor: float = 0.85, having: float = 0.90) -> DataFrame:
    """Meters whose mean power factor is low, ranked from the lowest."""
    pf = F.col(POWER) / F.col("Apparent_Power_kVA")
    grouped = (
        df.filter(F.col("Apparent_Power_kVA") > 0)
        .groupBy(METER, ZONE)
        .agg(
            exact_avg(pf).alias("_avg"),
            F.count_if(pf < poor).alias("poor_pf_records"),
            _rows().alias("total_records"),
        )
        .filter(F.col("_avg") < having)
        .withColumn("_neg", -F.col("_avg"))
    )
    # One row per meter is ranked overall, so this rank may have to split.
    grouped = stage(grouped, "power-factor")
    ranked = ordered.rank_desc(grouped, [], "_neg", "low_pf_rank", measure(grouped, [], "_neg"))
    return ranked.select(
        METER,
        ZONE,
        rounded("_avg", 3).alias("avg_power_factor"),
        "poor_pf_records",
        "total_records",
        percentage("poor_pf_records", "total_records").alias("poor_pf_percentage"),
        F.col("low_pf_rank").cast("int").alias("low_pf_rank"),
    ).orderBy("avg_power_factor", METER, ZONE)


def quarterly_growth(df: DataFrame) -> DataFrame:
    """Quarter totals per zone and the change from the zone's previous quarter."""
    grouped = df.groupBy(F.quarter(TIME).alias("quarter"), F.year(TIME).alias("year"), ZONE).agg(
        _rows().alias("record_count"),
        rounded(exact_avg(POWER), 2).alias("quarterly_avg"),
        exact_sum(POWER).alias("_s"),
    )
    prev = F.lag("_s").over(Window.partitionBy(ZONE).orderBy("year", "quarter"))
    return grouped.select(
        "quarter",
        "year",
        ZONE,
        "record_count",
        "quarterly_avg",
        rounded("_s", 2).alias("quarterly_total"),
        rounded(growth_percent("_s", prev), 2).alias("yoq_growth_rate"),
    ).orderBy(F.desc("year"), F.desc("quarter"), ZONE)


def rolling_daily_averages(df: DataFrame) -> DataFrame:
    """Daily mean per meter with 7- and 30-row rolling means over days with readings."""
    daily = df.groupBy(METER, calendar.trunc("day", TIME).alias("day")).agg(
        exact_avg(POWER).alias("_avg")
    )
    w = Window.partitionBy(METER).orderBy("day")
    week, month = w.rowsBetween(-6, 0), w.rowsBetween(-29, 0)
    return daily.select(
        METER,
        "day",
        rounded("_avg", 2).alias("daily_avg"),
        rounded(_window_avg("_avg", week), 2).alias("avg_7day_rolling"),
        rounded(_window_avg("_avg", month), 2).alias("avg_30day_rolling"),
        rounded(F.stddev_samp("_avg").over(week), 2).alias("stddev_7day"),
    ).orderBy(METER, F.desc("day"))


def _leading_meters(df: DataFrame, n: int) -> DataFrame:
    """Readings of those meters that can appear in the first ``n`` rows by meter.

    Every meter has at least one reading, so the first n meters are enough; of
    those only the ones reached before row n are kept.  At most n rows.
    """
    first = df.groupBy(METER).agg(_rows().alias("_n")).orderBy(METER).limit(n)
    w = Window.orderBy(METER).rowsBetween(Window.unboundedPreceding, -1)
    needed = first.select(F.col(METER).alias("_m"), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_b"))
    needed = F.broadcast(needed.filter(F.col("_b") < n).select("_m"))
    return df.join(needed, df[METER].eqNullSafe(needed["_m"]), "left_semi")


def cumulative_by_meter(df: DataFrame, n: int | None = 1000) -> DataFrame:
    """Running total, reading number and power rank of every reading in its meter."""
    order = time_order(df)
    work = df.select(METER, POWER, *order)
    if n is not None:
        work = _leading_meters(work, n)
    ranked = ordered.rank_desc(
        work, [METER], POWER, "power_rank_in_meter", measure(work, [METER], POWER)
    )
    fixed, rest = lanes(POWER)
    out = ordered.running(
        ranked,
        [METER],
        order,
        {"_sum": fixed, "_rest": rest, "reading_number": F.lit(1)},
        measure(work, [METER], TIME),
    ).select(
        METER,
        TIME,
        POWER,
        joined(F.col("_sum"), F.col("_rest")).alias("cumulative_power"),
        "reading_number",
        F.col("power_rank_in_meter").cast("int").alias("power_rank_in_meter"),
        *[F.col(c).alias("_tie") for c in order if c != TIME],
    )
    tie = [F.desc("_tie")] if "_tie" in out.columns else []
    out = out.orderBy(METER, F.desc(TIME), *tie)
    return (out if n is None else out.limit(n)).drop("_tie")


def zone_distribution(df: DataFrame) -> DataFrame:
    """Mean, median, mode of tenths, deviation, quartiles, tails and range per zone."""
    v = F.col(POWER)
    basics = df.groupBy(ZONE).agg(
        _rows().alias("record_count"),
        rounded(exact_avg(v), 2).alias("mean"),
        rounded(F.stddev_samp(v), 2).alias("stddev"),
        F.min(v).alias("min_val"),
        F.max(v).alias("max_val"),
    )
    tenths = (
        df.filter(v.isNotNull())
        .groupBy(ZONE, rounded(v, 1).alias("_t"))
        .agg(_rows().alias("_n"))
        .groupBy(ZONE)
        .agg(F.min(F.struct(-F.col("_n"), F.col("_t").alias("t")))["t"].alias("mode"))
    )
    q = group_quantiles(df, [ZONE], POWER, [0.05, 0.25, 0.5, 0.75, 0.95])
    out = with_group(with_group(basics, tenths, [ZONE], True), q, [ZONE], True)
    return out.select(
        ZONE,
        "record_count",
        "mean",
        rounded("q50", 2).alias("median"),
        rounded("mode", 2).alias("mode"),
        "stddev",
        rounded("q25", 2).alias("q1"),
        rounded("q75", 2).alias("q3"),
        rounded("q05", 2).alias("p5"),
        rounded("q95", 2).alias("p95"),
        "min_val",
        "max_val",
        rounded(F.col("max_val") - F.col("min_val"), 2).alias("range"),
    ).orderBy(F.desc_nulls_last("mean"), ZONE)


def zone_hour_demand(df: DataFrame) -> DataFrame:
    grouped = df.groupBy(ZONE, F.hour(TIME).alias("hour")).agg(
        _rows().alias("occurrence_count"),
        exact_avg(POWER).alias("_avg"),
        rounded(F.max(POWER), 2).alias("peak_power"),
        rounded(F.min(POWER), 2).alias("min_power"),
    )
    by = F.desc_nulls_last("_avg")
    # 24 rows per zone reach the windows.
    return grouped.select(
        ZONE,
        "hour",
        "occurrence_count",
        rounded("_avg", 2).alias("avg_power"),
        "peak_power",
        "min_power",
        F.rank().over(Window.partitionBy(ZONE).orderBy(by)).alias("peak_rank_in_zone"),
        F.dense_rank().over(Window.orderBy(by)).alias("global_peak_rank"),
    ).orderBy(ZONE, "peak_rank_in_zone", "hour")


def hourly_volatility(df: DataFrame, above: float = 0.5) -> DataFrame:
    """Meter-hours whose coefficient of variation is above the limit."""
    v = F.col(POWER)
    grouped = df.groupBy(METER, ZONE, calendar.trunc("hour", TIME).alias("hour_bucket")).agg(
        _rows().alias("reading_count"),
        exact_avg(v).alias("_avg"),
        F.stddev_samp(v).alias("_std"),
        (F.max(v) - F.min(v)).alias("range"),
    )
    cv = F.try_divide("_std", "_avg")
    return (
        grouped.filter(cv > above)
        .select(
            METER,
            ZONE,
            "hour_bucket",
            "reading_count",
            rounded("_avg", 2).alias("hourly_avg"),
            rounded("_std", 2).alias("hourly_stddev"),
            rounded(cv, 2).alias("coefficient_of_variation"),
            "range",
        )
        .orderBy(F.desc("coefficient_of_variation"), METER, ZONE, "hour_bucket")
    )


def top_hours_by_zone(df: DataFrame, k: int = 5) -> DataFrame:
    """The k hours with most consumption per zone; the overall rank covers all hours."""
    grouped = df.groupBy(ZONE, F.hour(TIME).alias("hour")).agg(
        rounded(exact_sum(POWER), 2).alias("total_power_hour"), _rows().alias("meter_count")
    )
    by = F.desc_nulls_last("total_power_hour")
    ranked = grouped.withColumns(
        {
            "global_hour_rank": F.rank().over(Window.orderBy(by)),
            "hour_rank_in_zone": F.row_number().over(Window.partitionBy(ZONE).orderBy(by, "hour")),
        }
    )
    return (
        ranked.filter(F.col("hour_rank_in_zone") <= k)
        .select(ZONE, "hour", "total_power_hour", "meter_count", "hour_rank_in_zone", "global_hour_rank")
        .orderBy(ZONE, "hour_rank_in_zone")
    )


def month_over_month(df: DataFrame) -> DataFrame:
    grouped = df.groupBy(METER, calendar.trunc("month", TIME).alias("month")).agg(
        exact_sum(POWER).alias("_s"), rounded(exact_avg(POWER), 2).alias("monthly_avg")
    )
    w = Window.partitionBy(METER).orderBy("month")
    prev = F.lag("_s").over(w)
    return grouped.select(
        METER,
        "month",
        rounded("_s", 2).alias("monthly_consumption"),
        "monthly_avg",
        rounded(prev, 2).alias("prev_month_consumption"),
        rounded(growth_percent("_s", prev), 2).alias("mom_growth_percent"),
    ).orderBy(METER, F.desc("month"))


def efficiency_by_meter(df: DataFrame) -> DataFrame:
    """How far each meter's mean lies below the largest reading, as a score with a rating."""
    grouped = df.groupBy(METER, ZONE).agg(exact_avg(POWER).alias("_avg"))
    out = with_scalars(grouped, df.agg(F.max(POWER).alias("_max")))
    score = 100.0 * (1.0 - F.try_divide("_avg", "_max"))
    return out.select(
        METER,
        ZONE,
        rounded("_avg", 2).alias("avg_consumption"),
        rounded(score, 2).alias("efficiency_score"),
        electrical.rated(score, config.EFFICIENCY_RATING).alias("efficiency_rating"),
    ).orderBy(F.desc_nulls_last("efficiency_score"), METER, ZONE)


def context_spikes(df: DataFrame, around: int = 10, sigmas: float = 2.0, n: int | None = 500) -> DataFrame:
    """Each reading against the mean and deviation of the readings around it."""
    order = time_order(df)
    work = df.select(METER, POWER, ZONE, *order)
    if n is not None:
        work = _leading_meters(work, n)
    exprs = {
        "_avg": lambda w: F.avg(POWER).over(w.rowsBetween(-around, around)),
        "_std": lambda w: F.stddev_samp(POWER).over(w.rowsBetween(-around, around)),
    }
    out = ordered.frames(
        work, [METER], order, exprs, measure(work, [METER], TIME), around, around
    )
    v = F.col(POWER)
    out = out.select(
        METER,
        TIME,
        POWER,
        ZONE,
        F.col("_avg").alias("context_avg"),
        (v - F.col("_avg")).alias("deviation"),
        F.when(v > F.col("_avg") + sigmas * F.col("_std"), "Spike").otherwise("Normal").alias(
            "classification"
        ),
        *[F.col(c).alias("_tie") for c in order if c != TIME],
    )
    tie = [F.desc("_tie")] if "_tie" in out.columns else []
    out = out.orderBy(METER, F.desc(TIME), *tie)
    return (out if n is None else out.limit(n)).drop("_tie")
