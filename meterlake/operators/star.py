"""Star schema: dimensions, fact table, materialised aggregates and report views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions import calendar, electrical
from meterlake.functions.exact import exact_avg, exact_sum, joined, lanes, rounded
from meterlake.operators.clean import METER, SEQ, TIME, iqr_bounds, outside_bounds
from meterlake.operators.quality import quality_report, range_violations
from meterlake.plans.bands import join_bands
from meterlake.plans.joins import with_group, with_scalars
from meterlake.plans.sketches import distinct_sketch, merged_distinct

POWER, ZONE = "Active_Power_kW", "Zone_ID"

# Fact column -> column of the featured readings.
FACT_COLUMNS = {
    "reading_id": SEQ,
    "timestamp": TIME,
    "meter_id": METER,
    "zone_id": ZONE,
    "voltage_v": "Voltage_V",
    "current_a": "Current_A",
    "active_power_kw": "Active_Power_kW",
    "reactive_power_kw": "Reactive_Power_kW",
    "apparent_power_kva": "Apparent_Power_kVA",
    "frequency_hz": "Frequency_Hz",
    "power_factor": "power_factor",
    "sub_meter_kitchen": "Sub_Meter_Kitchen",
    "sub_meter_hvac": "Sub_Meter_HVAC",
    "outdoor_temp_c": "Outdoor_Temp_C",
    "consumption_bucket": "consumption_bucket",
    "is_anomaly": "is_anomaly",
    "is_anomaly_raw": "is_anomaly_raw",
    "active_power_rolling_mean_24h": "Active_Power_kW_rolling_mean_24h",
    "active_power_rolling_std_24h": "Active_Power_kW_rolling_std_24h",
    "power_delta_from_mean_24h": "Active_Power_kW_delta_from_mean_24h",
    "meter_daily_consumption_kwh": "meter_daily_consumption_kWh",
    "zone_hourly_consumption_kwh": "zone_hourly_consumption_kWh",
    "meter_avg_power_kw": "meter_avg_power_kW",
    "zone_avg_power_kw": "zone_avg_power_kW",
}


def time_id(ts):
    """Key of a timestamp: microseconds since 1970, so no numbering pass is needed."""
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts)


# --- dimensions -----------------------------------------------------------------


def dim_time(df: DataFrame, ts: str = TIME, season: str = "monsoon", peak: str = "standard") -> DataFrame:
    stamps = df.select(F.col(ts).alias("timestamp")).filter("timestamp IS NOT NULL").distinct()
    t = F.col("timestamp")
    return stamps.select(
        time_id("timestamp").alias("time_id"),
        "timestamp",
        F.hour(t).alias("hour"),
        calendar.weekday_monday0(t).alias("day_of_week"),
        F.dayofmonth(t).alias("day_of_month"),
        F.month(t).alias("month"),
        F.quarter(t).alias("quarter"),
        F.year(t).alias("year"),
        F.weekofyear(t).alias("week_of_year"),
        calendar.day_name(t).alias("day_name"),
        calendar.is_peak(F.hour(t), peak).cast("int").alias("is_peak_hour"),
        calendar.season(F.month(t), season).alias("season"),
    )


def dim_meter(df: DataFrame, meter: str = METER, meter_type: str = "Smart Meter") -> DataFrame:
    ids = df.select(F.col(meter).alias("meter_id")).filter("meter_id IS NOT NULL").distinct()
    return ids.select(
        "meter_id",
        F.concat(F.lit("Meter "), "meter_id").alias("meter_name"),
        F.lit(meter_type).alias("meter_type"),
        F.lit("Active").alias("status"),
    )


def dim_zone(df: DataFrame, zone: str = ZONE) -> DataFrame:
    ids = df.select(F.col(zone).alias("zone_id")).filter("zone_id IS NOT NULL").distinct()
    return ids.select(
        "zone_id",
        F.concat(F.lit("Zone "), "zone_id").alias("zone_name"),
        F.lit(None).cast("string").alias("district"),
    )


def dim_load_profile(spark: SparkSession, profiles=config.LOAD_PROFILES) -> DataFrame:
    rows = [(i, *p) for i, p in enumerate(profiles, start=1)]
    return spark.createDataFrame(
        rows,
        "load_profile_id int, load_category string, min_power_kw double, max_power_kw double, "
        "description string",
    )


def insert_absent(existing: DataFrame, new: DataFrame, keys) -> DataFrame:
    """Rows of ``new`` whose key is not there yet, appended to ``existing``."""
    fresh = new.dropDuplicates(list(keys)).join(existing, list(keys), "left_anti")
    return existing.unionByName(fresh.select(existing.columns))


#: Up to so many profiles each value is compared with every one; beyond, bins are joined.
MOST_PROFILES = 1_000


def band_lookup(df: DataFrame, profiles: DataFrame, value: str = "active_power_kw") -> DataFrame:
    """Load profile whose [min, max) holds the value; an end that is NULL is open."""
    if profiles.limit(MOST_PROFILES + 1).count() > MOST_PROFILES:
        bands = profiles.select(
            "load_profile_id", F.col("min_power_kw").alias("_lo"), F.col("max_power_kw").alias("_hi")
        )
        return join_bands(df, bands, value)
    p = F.broadcast(
        profiles.select(
            "load_profile_id", F.col("min_power_kw").alias("_lo"), F.col("max_power_kw").alias("_hi")
        )
    )
    above, below = df[value] >= p["_lo"], df[value] < p["_hi"]
    hit = df[value].isNotNull() & (p["_lo"].isNull() | above) & (p["_hi"].isNull() | below)
    return df.join(p, hit, "left").drop("_lo", "_hi")


# --- fact -------------------------------------------------------------------------


def fact_table(
    df: DataFrame, profiles: DataFrame | None = None, season: str = "monsoon", peak: str = "standard"
) -> DataFrame:
    """Fact rows from (featured) readings: present columns renamed, calendar columns derived."""
    if "power_factor" not in df.columns and "Apparent_Power_kVA" in df.columns:
        df = df.withColumn("power_factor", electrical.power_factor())
    kept = [F.col(src).alias(dst) for dst, src in FACT_COLUMNS.items() if src in df.columns]
    t, h = F.col(TIME), F.hour(TIME)
    fact = df.select(
        *kept,
        time_id(TIME).alias("time_id"),
        h.alias("hour_of_day"),
        calendar.is_peak(h, peak).cast("int").alias("peak_hour_flag"),
        electrical.banded(POWER).alias("load_category"),
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        calendar.weekday_monday0(t).alias("day_of_week"),
        calendar.season(F.month(t), season).alias("season"),
    )
    for flag in ("is_anomaly", "is_anomaly_raw"):
        if flag in fact.columns:
            fact = fact.withColumn(flag, F.col(flag).cast("int"))
    return fact if profiles is None else band_lookup(fact, profiles)


# --- flat aggregates ----------------------------------------------------------------


def daily_by_meter(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col(METER).isNotNull() & F.col(TIME).isNotNull())
        .groupBy(F.to_date(TIME).alias("Date"), METER)
        .agg(
            F.coalesce(exact_sum(POWER), F.lit(0.0)).alias("Total_kWh"),
            exact_avg(POWER).alias("Avg_kW"),
            F.min(POWER).alias("Min_kW"),
            F.max(POWER).alias("Max_kW"),
            F.count(POWER).alias("Count"),
        )
    )


def hourly_by_zone(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col(ZONE).isNotNull() & F.col(TIME).isNotNull())
        .groupBy(calendar.trunc("hour", TIME).alias("Hour"), ZONE)
        .agg(
            F.coalesce(exact_sum(POWER), F.lit(0.0)).alias("Total_kWh"),
            exact_avg(POWER).alias("Avg_kW"),
            F.count(POWER).alias("Count"),
        )
    )


def by_peak_flag(df: DataFrame) -> DataFrame:
    return df.groupBy(F.col("peak_hour_flag").alias("Is_Peak_Hour")).agg(
        F.coalesce(exact_sum(POWER), F.lit(0.0)).alias("Total_kWh"),
        exact_avg(POWER).alias("Avg_kW"),
        rounded(F.stddev_samp(POWER), 6).alias("Std_kW"),
        F.count(POWER).alias("Count"),
    )


def load_category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("load_category").agg(F.count(F.lit(1)).alias("Count"))


def meter_summary(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(METER)
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            rounded(exact_avg(POWER), 3).alias("avg_power_kW"),
            F.max(POWER).alias("max_power_kW"),
            F.min(POWER).alias("min_power_kW"),
        )
        .orderBy(F.desc_nulls_last("avg_power_kW"), METER)
    )


def zone_summary(df: DataFrame) -> DataFrame:
    return (
        df.groupBy(ZONE)
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            rounded(exact_avg(POWER), 3).alias("avg_power_kW"),
            F.max("Voltage_V").alias("max_voltage_V"),
        )
        .orderBy(F.desc_nulls_last("avg_power_kW"), ZONE)
    )


# --- aggregates of the fact table -----------------------------------------------------


def agg_daily_consumption(fact: DataFrame) -> DataFrame:
    peak = F.col("peak_hour_flag") == 1
    power = F.col("active_power_kw")
    return fact.groupBy(F.to_date("timestamp").alias("reading_date"), "meter_id", "zone_id").agg(
        exact_sum(power).alias("total_consumption_kwh"),
        exact_avg(power).alias("avg_power_kw"),
        F.max(power).alias("max_power_kw"),
        F.min(power).alias("min_power_kw"),
        F.coalesce(exact_sum(F.when(peak, power)), F.lit(0.0)).alias("peak_consumption_kwh"),
        F.coalesce(exact_sum(F.when(~peak, power)), F.lit(0.0)).alias("off_peak_consumption_kwh"),
        rounded(exact_avg("power_factor"), 6).alias("avg_power_factor"),
        exact_avg("frequency_hz").alias("avg_frequency_hz"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        F.count(F.lit(1)).alias("reading_count"),
    )


def agg_hourly_zone_consumption(fact: DataFrame) -> DataFrame:
    """Distinct meters per zone and hour come from a (zone, hour, meter) pre-aggregate."""
    power = F.col("active_power_kw")
    hour = calendar.trunc("hour", "timestamp")
    fixed, rest = lanes(power)
    grain = fact.groupBy(hour.alias("reading_hour"), "zone_id", "meter_id").agg(
        F.sum(fixed).alias("_fixed"),
        F.sum(rest).alias("_rest"),
        F.count(power).alias("_n"),
        F.max(power).alias("_hi"),
        F.min(power).alias("_lo"),
    )
    total = joined(F.sum("_fixed"), F.sum("_rest"))
    return grain.groupBy("reading_hour", "zone_id").agg(
        total.alias("total_consumption_kwh"),
        F.try_divide(total, F.sum("_n")).alias("avg_power_kw"),
        F.max("_hi").alias("max_power_kw"),
        F.min("_lo").alias("min_power_kw"),
        F.count("meter_id").alias("meter_count"),
    )


def zone_day_meter_sketches(fact: DataFrame) -> DataFrame:
    """Opt-in beside the exact count: a mergeable sketch of a zone's meters per day."""
    grain = fact.filter("meter_id IS NOT NULL").groupBy(F.to_date("timestamp").alias("reading_date"), "zone_id")
    return grain.agg(distinct_sketch("meter_id").alias("meter_sketch"))


def zone_month_meters(sketches: DataFrame) -> DataFrame:
    """Estimated meters per zone and month from the stored days; no reading is read again."""
    dated = sketches.withColumns({"year": F.year("reading_date"), "month": F.month("reading_date")})
    return merged_distinct(dated, ["zone_id", "year", "month"], "meter_sketch", "meter_estimate")


def agg_monthly_consumption(fact: DataFrame | None = None, daily: DataFrame | None = None) -> DataFrame:
    """Monthly totals and the mean, largest and smallest day, from daily totals.

    These are taken from the facts, or given as ``daily``, the stored result of ``agg_daily_consumption``.
    """
    if daily is None:
        daily = fact.groupBy(F.to_date("timestamp").alias("reading_date"), "meter_id", "zone_id").agg(
            exact_sum("active_power_kw").alias("total_consumption_kwh"),
            F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
            F.count(F.lit(1)).alias("reading_count"),
        )
    day = F.col("reading_date").cast("date")
    total = exact_sum("total_consumption_kwh")
    return daily.groupBy(F.year(day).alias("year"), F.month(day).alias("month"), "meter_id", "zone_id").agg(
        total.alias("total_consumption_kwh"),
        F.try_divide(total, F.count("total_consumption_kwh")).alias("avg_daily_consumption_kwh"),
        F.max("total_consumption_kwh").alias("max_daily_consumption_kwh"),
        F.min("total_consumption_kwh").alias("min_daily_consumption_kwh"),
        F.sum("anomaly_count").alias("total_anomalies"),
        F.sum("reading_count").alias("reading_count"),
    )


# --- quality tables -----------------------------------------------------------------


def quality_log(df: DataFrame, thresholds=config.QUALITY) -> DataFrame:
    """One log row: counts, percentages, score and status of a readings table."""
    report = quality_report(df)
    ranges = range_violations(df).agg(F.sum("out_of_range_count").alias("out_of_range_count"))
    flagged = (
        F.count_if(F.col("is_anomaly").cast("int") == 1)
        if "is_anomaly" in df.columns
        else F.lit(0).cast("bigint")
    )
    row = with_scalars(with_scalars(report, ranges), df.agg(flagged.alias("anomaly_count")))

    def share(c, whole="total_rows"):
        part = F.coalesce(F.try_divide(F.col(c) * 100.0, F.col(whole)), F.lit(0.0))
        return rounded(part, 6)

    return row.select(
        "total_rows",
        F.col("null_cells").alias("null_count"),
        F.col("duplicate_rows").alias("duplicate_count"),
        "anomaly_count",
        "out_of_range_count",
        rounded(100.0 - F.col("data_quality_score"), 6).alias("null_percentage"),
        "duplicate_percentage",
        share("anomaly_count").alias("anomaly_percentage"),
        share("out_of_range_count").alias("out_of_range_percentage"),
        F.col("data_quality_score").alias("quality_score"),
        F.when(
            (100.0 - F.col("data_quality_score") <= thresholds.nulls)
            & (F.col("duplicate_percentage") <= thresholds.duplicates)
            & (share("anomaly_count") <= thresholds.anomalies),
            "PASSED",
        )
        .otherwise("FAILED")
        .alias("status"),
    )


def anomaly_records(df: DataFrame, columns=("Active_Power_kW", "Current_A", "Voltage_V")) -> DataFrame:
    """One row per value outside its fences: the nearest fence, the value, the deviation in %."""
    columns = list(columns)
    bounds = iqr_bounds(df, columns)
    joined = with_scalars(df, bounds)
    cells = [
        F.when(
            outside_bounds(c),
            F.struct(
                F.lit(c).alias("anomaly_column"),
                F.when(F.col(c) < F.col(f"{c}_lower"), F.col(f"{c}_lower"))
                .otherwise(F.col(f"{c}_upper"))
                .alias("expected_value"),
                F.col(c).alias("actual_value"),
            ),
        )
        for c in columns
    ]
    found = F.explode(F.array_compact(F.array(*cells))).alias("a")
    out = joined.select(
        F.col(SEQ).alias("reading_id"),
        F.col(TIME).alias("timestamp"),
        F.col(METER).alias("meter_id"),
        F.col(ZONE).alias("zone_id"),
        found,
    ).select("reading_id", "timestamp", "meter_id", "zone_id", "a.*")
    off = F.col("actual_value") - F.col("expected_value")
    return out.select(
        "reading_id",
        "timestamp",
        "meter_id",
        "zone_id",
        F.lit("outlier").alias("anomaly_type"),
        "anomaly_column",
        "expected_value",
        "actual_value",
        rounded(F.try_divide(off * 100.0, F.abs("expected_value")), 6).alias("deviation_percentage"),
    )


# --- report views -----------------------------------------------------------------


def current_meter_status(fact: DataFrame, meters: DataFrame, zones: DataFrame) -> DataFrame:
    """Every meter with each zone it has readings in: last reading and totals there.

    A meter without readings keeps one row without a zone.  Nothing is paired that has no reading.
    """
    totals = fact.groupBy("meter_id", "zone_id").agg(
        F.max("timestamp").alias("last_reading_timestamp"),
        F.count("reading_id").alias("total_readings"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
    )
    per_meter = meters.select("meter_id", "meter_name", "status").join(totals, "meter_id", "left")
    paired = with_group(per_meter, zones.select("zone_id", "zone_name"), ["zone_id"])
    return paired.select(
        "meter_id",
        "meter_name",
        "zone_id",
        "zone_name",
        "status",
        "last_reading_timestamp",
        F.coalesce("total_readings", F.lit(0)).alias("total_readings"),
        F.coalesce("anomaly_count", F.lit(0)).alias("anomaly_count"),
    )


def daily_consumption_comparison(daily: DataFrame, zones: DataFrame) -> DataFrame:
    """Per day and zone: total, mean of the meter means, distinct meters."""
    grouped = daily.groupBy("reading_date", "zone_id").agg(
        exact_sum("total_consumption_kwh").alias("zone_total_kwh"),
        rounded(
            F.avg("avg_power_kw"),
            9,
        ).alias("zone_avg_power_kw"),
        F.count_distinct("meter_id").alias("meter_count"),
    )
    return with_group(grouped, zones.select("zone_id", "zone_name"), ["zone_id"])


def peak_hour_performance(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("peak_hour_flag") == 1)
        .groupBy("hour_of_day", "zone_id")
        .agg(
            F.count(F.lit(1)).alias("reading_count"),
            exact_avg("active_power_kw").alias("avg_load_kw"),
            F.max("active_power_kw").alias("peak_load_kw"),
            F.min("active_power_kw").alias("min_load_kw"),
            rounded(exact_avg("power_factor"), 6).alias("avg_power_factor"),
            F.count_if(F.col("is_anomaly") == 1).alias("anomaly_count"),
        )
    )
