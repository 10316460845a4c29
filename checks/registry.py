"""Every operator and named query, bound to the shared test tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fixtures as fx
from meterlake import config
from meterlake.functions import calendar
from meterlake.functions.exact import exact_avg, exact_sum, rounded
from meterlake.operators import analytics, clean, features, increments, quality, star
from meterlake.queries import audit, consumption, reports
from meterlake.plans import ordered, quantiles, sketches
from meterlake.plans.bands import join_bands
from meterlake.plans.splits import measure
from meterlake.plans.staging import staging_root
from meterlake.schema import ANALYTICS_COLUMNS, MEASURES
from meterlake.sources.files import sample
from meterlake.streaming import gaps, ingest, windows

POWER = "Active_Power_kW"
AS_OF = dt.datetime(2024, 1, 15)


# --- inputs -------------------------------------------------------------------


def readings(spark, d):
    return fx.readings(spark, d)


def dup(spark, d):
    return fx.readings_dup(spark, d)


def light(spark, d):
    """Readings with calendar, season, peak, power factor and load category."""
    out = features.peak_flag(features.season(features.temporal(readings(spark, d))))
    return features.load_category(features.power_factor(out))


def bulk(spark, d):
    return fx.bulk(spark, d)


def fact(spark, d):
    return star.fact_table(readings(spark, d))


def flagged_fact(spark, d):
    return star.fact_table(clean.flag_outliers(readings(spark, d), [POWER]))


def dup_fact(spark, d):
    return star.fact_table(dup(spark, d))


def meters(spark, d):
    return star.dim_meter(readings(spark, d))


def zones(spark, d):
    return star.dim_zone(readings(spark, d))


def star_readings(spark, d):
    return fx.star(spark, d).select(
        F.col("reading_id").alias("_seq"),
        F.col("ts").alias("Timestamp"),
        F.col("meter_id").alias("Meter_ID"),
        F.col("zone_id").alias("Zone_ID"),
        F.col("active_power_kw").alias(POWER),
        (F.col("reading_id") % 64 - 12).cast("double").alias("Outdoor_Temp_C"),
        "is_anomaly",
    )


def star_fact(spark, d):
    return star.fact_table(star_readings(spark, d))


def star_meters(spark, d):
    c = fx.load(spark, d, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("meter_id"),
        F.col("c_name").alias("meter_name"),
        F.lit("Active").alias("status"),
    )


def star_zones(spark, d):
    n, r = fx.load(spark, d, "nation"), fx.load(spark, d, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        F.col("n_nationkey").cast("string").alias("zone_id"),
        F.col("n_name").alias("zone_name"),
        F.col("r_name").alias("district"),
    )


def star_times(spark, d):
    return star.dim_time(star_readings(spark, d))


def filled(spark, d):
    return clean.fill_missing(clean.keep_first(dup(spark, d)))


# --- small adapters -------------------------------------------------------------


def _round(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: rounded(c, digits) for c in columns})


def _on(fn, *inputs, **kw):
    """A query that applies ``fn`` to the given inputs."""
    return lambda spark, d: fn(*[i(spark, d) for i in inputs], **kw)


def _temporal(spark, d):
    out = features.season(features.temporal(readings(spark, d)))
    waves = [f"{p}_{w}" for p in ("hour", "month", "dow") for w in ("sin", "cos")]
    return _round(out, 9, *waves).select(
        "_seq", "hour", "day_of_week", "day_of_month", "month", "quarter", "year",
        "week_of_year", "day_name", *waves, "season",
    )


def _star_temporal(spark, d):
    out = features.season(features.temporal(star_readings(spark, d)), "temperate")
    return out.select("_seq", "week_of_year", "day_name", "quarter", "season")


def _electrical(spark, d):
    out = features.load_category(
        features.power_factor(features.peak_flag(features.temporal(readings(spark, d))))
    )
    return out.select("_seq", "peak_hour_flag", "power_factor", "load_category")


ROLL = [
    f"{c}_{k}_24h" for c in features.ROLLING_COLUMNS for k in ("rolling_mean", "rolling_std", "delta_from_mean")
]


def _rolling(spark, d):
    out = features.rolling(readings(spark, d))
    out = _round(out, 9, *[c for c in ROLL if "std" not in c])
    return _round(out, 6, *[c for c in ROLL if "std" in c]).select("_seq", *ROLL)


def _rolling_hours(spark, d):
    out = features.rolling(readings(spark, d), columns=[POWER], unit="hours")
    c = f"{POWER}_rolling_mean_24h"
    return _round(out, 9, c).select("_seq", c)


def _groups(spark, d):
    names = ("meter_daily_consumption_kWh", "zone_hourly_consumption_kWh", "meter_avg_power_kW", "zone_avg_power_kW")
    return features.group_features(readings(spark, d)).select("_seq", *names)


def _groups_null_time(spark, d):
    """Some readings without a time and some without a meter."""
    names = ("meter_daily_consumption_kWh", "zone_hourly_consumption_kWh", "meter_avg_power_kW", "zone_avg_power_kW")
    holes = {
        "Timestamp": F.when(F.col("_seq") % 20 != 0, F.col("Timestamp")),
        "Meter_ID": F.when(F.col("_seq") % 70 != 0, F.col("Meter_ID")),
    }
    return features.group_features(readings(spark, d).withColumns(holes)).select("_seq", *names)


def _extremes(spark, d):
    """Sums and means over very large, very small and infinite readings."""
    v = (
        F.when(F.col("_seq") % 50 == 1, 1e12)
        .when(F.col("_seq") % 50 == 2, 4e-8)
        .when(F.col("_seq") % 5000 == 3, float("inf"))
        .otherwise(F.col(POWER))
    )
    grouped = readings(spark, d).filter("Meter_ID IS NOT NULL").groupBy("Meter_ID")
    return grouped.agg(
        rounded(exact_sum(v), 0).alias("total"), rounded(exact_avg(v), 1).alias("mean"), F.count(v).alias("n")
    )


def _features(spark, d):
    """The whole feature table, reduced to its distinctive columns."""
    out = features.feature_table(clean.clean_readings(dup(spark, d)))
    c = f"{POWER}_rolling_mean_24h"
    return _round(out, 9, c).select(
        "_seq", "hour", "season", "peak_hour_flag", "power_factor", "load_category", c,
        "consumption_bucket", "meter_daily_consumption_kWh", "zone_avg_power_kW",
        F.col("is_anomaly").cast("int").alias("is_anomaly"),
    )


def _extras(spark, d):
    out = features.exploratory_features(readings(spark, d))
    nine = ["power_rolling_24h", "consumption_change"]
    out = _round(_round(out, 9, *nine), 6, "consumption_change_pct")
    out = _round(out, 11, "power_rolling_7d")
    return out.select(
        "_seq", "day", "day_of_year", "is_weekend", "season", "peak_hour_flag",
        "power_factor_category", "load_category", "is_anomaly", *nine, "power_rolling_7d", "consumption_change_pct",
    )


def _spikes(spark, d):
    return _round(consumption.context_spikes(readings(spark, d)), 9, "context_avg", "deviation")


def _spikes_all(spark, d):
    return _round(consumption.context_spikes(readings(spark, d), n=None), 9, "context_avg", "deviation")


def _describe(spark, d):
    return _round(quality.describe(readings(spark, d), list(MEASURES)), 6, "mean", "std")


def _histogram_edges(fn):
    return lambda spark, d: _round(fn(spark, d), 9, "bin_low", "bin_high")


def _raw_pf_fact(spark, d):
    return star.fact_table(features.power_factor(readings(spark, d), clipped=False))


def _analytics_projection(spark, d):
    out = clean.flag_outliers(light(spark, d), [POWER], "is_anomaly_raw")
    out = features.consumption_bucket(out)
    out = out.withColumn("is_anomaly_raw", F.col("is_anomaly_raw").cast("int"))
    return out.select("_seq", *[c for c in ANALYTICS_COLUMNS if c in out.columns])


def _clean_report(spark, d):
    raw = dup(spark, d)
    return clean.clean_report(raw, clean.clean_readings(raw), clean.keep_first(raw))


def _simple_report(spark, d):
    raw = dup(spark, d)
    return clean.simple_clean_report(raw, clean.simple_clean(raw))


def _missing_report(spark, d):
    first = clean.keep_first(dup(spark, d))
    return clean.missing_report(first, clean.fill_missing(first), list(MEASURES))


def _band_lookup(spark, d):
    out = star.band_lookup(fact(spark, d), star.dim_load_profile(spark))
    return out.select("reading_id", "load_profile_id")


def _insert_absent(spark, d):
    existing = star_meters(spark, d).filter(F.col("meter_id").cast("long") % 3 == 0)
    fresh = star.dim_meter(star_readings(spark, d)).select("meter_id", "meter_name", "status")
    return star.insert_absent(existing, fresh, ["meter_id"])


def _zone_quantiles_bulk(spark, d):
    return quantiles.group_quantiles(bulk(spark, d), ["Zone_ID"], POWER, [0.05, 0.25, 0.5, 0.75, 0.95])


def _distinct_bulk(spark, d):
    """Distinct meters, days and (meter, day) pairs per zone."""
    pairs = bulk(spark, d).groupBy("Zone_ID", "Meter_ID", F.to_date("Timestamp").alias("_day")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    return pairs.groupBy("Zone_ID").agg(
        F.sum("_n").alias("readings"),
        F.count_distinct("Meter_ID").alias("meters"),
        F.count_distinct("_day").alias("days"),
        F.count(F.lit(1)).alias("meter_days"),
    )


LOW_SPLIT = config.SplitPolicy(min_rows=1_000, max_groups=64, max_slices=64, map_rows=0)


def _bracketed(spark, d):
    """Quantiles by rank brackets, as groups beyond the value map take them."""
    return quantiles.group_quantiles(bulk(spark, d), ["Zone_ID"], POWER, [0.05, 0.25, 0.5, 0.75, 0.95], policy=LOW_SPLIT)


def _daily_sketches(spark, d):
    """Monthly quantiles from daily sketches, told as being within one percent of their ranks."""
    month, probs = F.trunc("day", "month").alias("month"), [0.05, 0.25, 0.5, 0.75, 0.95]
    df = bulk(spark, d).filter("Zone_ID IS NOT NULL")
    days = sketches.daily_sketches(df, ["Zone_ID"], "Timestamp", POWER)
    months = sketches.sketch_quantiles(sketches.merged(days, ["Zone_ID", month]), probs)
    dated = df.withColumn("month", F.trunc(F.to_date("Timestamp"), "month"))
    return sketches.rank_within(dated, ["Zone_ID", "month"], POWER, months, probs)


def _merged_distinct(spark, d):
    """Meters per zone and month from merged daily sketches: within three percent of the exact count."""
    f = star_fact(spark, d).filter("zone_id IS NOT NULL")
    months = star.zone_month_meters(star.zone_day_meter_sketches(f))
    exact = f.groupBy("zone_id", F.year("timestamp").alias("year"), F.month("timestamp").alias("month")).agg(
        F.count_distinct("meter_id").alias("meters")
    )
    near = F.abs(F.col("meter_estimate") - F.col("meters")) <= 0.03 * F.col("meters")
    return exact.join(months, ["zone_id", "year", "month"]).select("zone_id", "year", "month", "meters", near.alias("within"))


def _rank_counted(spark, d):
    """Ranks in zones taken as hot, of values that very many readings share."""
    b = bulk(spark, d)
    return ordered.rank_desc(b, ["Zone_ID"], POWER, "power_rank", measure(b, ["Zone_ID"], POWER, LOW_SPLIT))


def _running_without_time(spark, d):
    """Numbers and running counts in zones taken as hot, where most times are missing or equal."""
    t = F.when(F.col("_seq") % 3 == 1, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).when(F.col("_seq") % 3 == 2, F.col("Timestamp"))
    r = readings(spark, d).select("_seq", "Zone_ID", t.alias("Timestamp"), POWER)
    s = measure(r, ["Zone_ID"], "Timestamp", LOW_SPLIT)
    sums = {"reading_number": F.lit(1), "with_power": F.when(F.col(POWER).isNotNull(), 1).otherwise(0)}
    return ordered.running(r, ["Zone_ID"], ["Timestamp", "_seq"], sums, s).select("_seq", "reading_number", "with_power")


def _many_bands(spark, d):
    """Readings of the fact table with the number and the first of many overlapping bands made from the parts' prices."""
    p = fx.load(spark, d, "part")
    low = (F.col("p_retailprice") - 900) / 50
    bands = p.select(
        F.col("p_partkey").alias("band"), F.when(F.col("p_partkey") % 400 != 0, low).alias("_lo"),
        F.when(F.col("p_partkey") % 400 != 1, low + (F.col("p_partkey") % 9) / 40).alias("_hi"),
    )
    rows = fact(spark, d).select("reading_id", "active_power_kw")
    found = join_bands(rows, bands, "active_power_kw", totals={"bands": (F.count("band"), F.sum), "first_band": (F.min("band"), F.min)})
    return found.groupBy("reading_id").agg(F.sum(F.coalesce("bands", F.lit(0))).alias("bands"), F.min("first_band").alias("first_band"))


def _second_delivery(spark, d):
    """Daily totals of a star schema that got its readings in two deliveries, some of them in both."""
    r = clean.flag_outliers(light(spark, d), [POWER])
    half = r.agg(F.expr("CAST(min(Timestamp) AS TIMESTAMP) + (CAST(max(Timestamp) AS TIMESTAMP) - CAST(min(Timestamp) AS TIMESTAMP)) / 2")).first()[0]
    path = f"{staging_root(spark)}/increments/star_{uuid.uuid4().hex}"
    cut = F.col("Timestamp").cast("timestamp")
    increments.merge_delivery(spark, r.filter(cut < half), path)
    increments.merge_delivery(spark, r.filter((cut >= half) | (F.col("_seq") % 10 == 0)), path)
    daily = spark.read.parquet(f"{path}/agg_daily_consumption")
    return daily.select("reading_date", "meter_id", "zone_id", rounded("total_consumption_kwh", 6).alias("total_kwh"), "reading_count")


def _json_round_trip(spark, d):
    return ingest.decode(ingest.encode(readings(spark, d))).select(
        "Timestamp", "Meter_ID", "Zone_ID", *MEASURES
    )


def _fact_sample(spark, d):
    f = star.fact_table(clean.flag_outliers(light(spark, d), [POWER]), star.dim_load_profile(spark))
    return f.select(
        "reading_id", "timestamp", "meter_id", "zone_id", "time_id", "load_profile_id",
        "power_factor", "hour_of_day", "peak_hour_flag", "load_category", "year", "month",
        "day_of_week", "season", "is_anomaly",
    )


def _timestamps(spark, d):
    """Event times written in six text formats and one that is none, then parsed."""
    e = fx.load(spark, d, "events")
    kind = F.col("event_id") % 7
    text = F.when(kind == 6, F.lit("not a time"))
    for i, f in enumerate(config.TIMESTAMP_FORMATS):
        text = text.when(kind == i, F.date_format("ts", f))
    return e.select("event_id", calendar.parse_timestamp(text).alias("parsed"))


def _zscore(spark, d):
    out = clean.flag_zscore(readings(spark, d), POWER)
    return out.groupBy("Zone_ID").agg(
        F.count_if("is_zscore_outlier").alias("outliers"), F.count(F.lit(1)).alias("readings")
    )


def _iqr_flags(spark, d):
    return clean.flag_outliers(readings(spark, d)).select(
        "_seq", F.col("is_anomaly").cast("int").alias("is_anomaly")
    )


def _clean(mode):
    def run(spark, d):
        out = clean.clean_readings(dup(spark, d), mode)
        return out.withColumn("is_anomaly", F.col("is_anomaly").cast("int"))

    return run


def _simple(spark, d):
    out = clean.simple_clean(dup(spark, d))
    return out.withColumn("is_outlier", F.col("is_outlier").cast("int"))


def _change(spark, d):
    out = features.consumption_change(readings(spark, d))
    return _round(_round(out, 9, "consumption_change"), 6, "consumption_change_pct").select(
        "_seq", "consumption_change", "consumption_change_pct"
    )


def _row_number(spark, d):
    """Reading number per meter."""
    r = readings(spark, d).select("_seq", "Meter_ID", "Timestamp")
    s = measure(r, ["Meter_ID"], "Timestamp")
    return ordered.running(r, ["Meter_ID"], ["Timestamp", "_seq"], {"row_number": F.lit(1)}, s).select(
        "_seq", "row_number"
    )


def _check_rows(fn, *names):
    return lambda spark, d: fn(spark, d).select(*names)


def _by_peak(spark, d):
    return star.by_peak_flag(light(spark, d))


def _pairs(spark, d):
    return analytics.reactive_pairs(readings(spark, d), 1.0)


def _sampled(spark, d):
    return sample(readings(spark, d), 0.1).select("_seq")


# --- streams over the same tables ------------------------------------------------


def event_stream(spark, d):
    """Readings as a stream: the events file is the source."""
    schema = fx.load(spark, d, "events").schema
    source = ingest.file_source(
        spark, d, "parquet", schema, glob="events.parquet"
    )
    return spark.sql(fx.READINGS, events=source)


def message_stream(spark, d):
    """Messages of the readings, every 50th cut short."""
    coded = event_stream(spark, d).select("_seq", *_payload())
    value = F.when(F.col("_seq") % 50 == 0, F.expr("left(value, length(value) div 2)")).otherwise(
        F.col("value")
    )
    return coded.select(value.alias("value"))


def _payload():
    fields = [F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp")]
    fields += [F.col(c) for c in ("Meter_ID", "Zone_ID", *MEASURES)]
    return [F.to_json(F.struct(*fields)).alias("value")]


def _drained(stream, spark, name, mode="append"):
    """Run a stream over all that is there and return its result from storage."""
    root = f"{staging_root(spark)}/streams/{name}_{uuid.uuid4().hex}"

    def write(batch, number):
        # Complete results replace each other; appended ones add a folder per batch.
        part = "all" if mode == "complete" else str(number)
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={part}")

    q = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out/batch=*")


def _delivered(spark, d, batches: int = 3):
    """Readings as a stream of several batches in order of time.

    Files come one a batch.  From the third on they also bring late rows, from the day of the first
    readings, which the watermark has left behind; a last file brings a row far in the future, which
    closes every window before it.
    """
    root = f"{staging_root(spark)}/streams/source_{uuid.uuid4().hex}"
    r = readings(spark, d)
    low, high = r.agg(F.min("Timestamp"), F.max("Timestamp")).first()
    step = (high - low) / batches
    first = r.filter(F.to_date("Timestamp") == low.date()).withColumns({"Meter_ID": F.lit("MTR-LATE"), "Zone_ID": F.lit("ZLATE")})
    for i in range(batches):
        part = r.filter(F.col("Timestamp") >= low + i * step)
        if i < batches - 1:
            part = part.filter(F.col("Timestamp") < low + (i + 1) * step)
        if i > 1:  # lateness is judged by the watermark of the batch before
            part = part.unionByName(first)
        part.coalesce(1).write.mode("append").parquet(root)
    end = r.limit(1).withColumns(
        {"Meter_ID": F.lit("MTR-END"), "Zone_ID": F.lit("ZEND"), "Timestamp": F.lit("2099-01-01 00:00:00").cast("timestamp_ntz")}
    )
    end.coalesce(1).write.mode("append").parquet(root)
    return ingest.file_source(spark, root, "parquet", r.schema, max_files=1)


def _stream(fn, name, closed="true", **kw):
    """A windowed query over several batches in append mode, without the row that closes it."""
    return lambda spark, d: _drained(fn(_delivered(spark, d), **kw), spark, name).filter(closed)


def _gaps(spark, d):
    """Alerts of all readings, which come in three batches with late rows between them."""
    alerts = gaps.gap_alerts(_delivered(spark, d), delay="1 hour")
    return _drained(alerts, spark, "gaps").filter("Meter_ID NOT IN ('MTR-END', 'MTR-LATE')")


def _dedup(spark, d):
    """Every reading twice in its batch; late rows are dropped, as are the copies."""
    s = _delivered(spark, d).drop("_seq")
    out = _drained(windows.deduplicate(s.union(s), "1 hour"), spark, "dedup").filter("Meter_ID <> 'MTR-END'")
    return out.select(F.col("Timestamp").cast("timestamp_ntz").alias("Timestamp"), "Meter_ID", "Zone_ID", *MEASURES)


def _decoded(spark, d):
    out = _drained(ingest.decode(message_stream(spark, d)), spark, "decoded")
    return out.drop("ingestion_timestamp")


def _dead_letters(spark, d):
    parsed = ingest.parse(message_stream(spark, d)).select(ingest.BAD)
    out = _drained(parsed, spark, "letters")
    return out.groupBy(F.col(ingest.BAD).cast("int").alias("malformed")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def _batch_quality(spark, d):
    flags = _drained(windows.range_flags(event_stream(spark, d)), spark, "quality")
    return flags.select("_seq", "out_of_range", "missing")


QUERIES = {
    # flat catalogue
    "G1_hourly_consumption": _on(consumption.hourly_consumption, readings),
    "G2_daily_consumption": _on(consumption.daily_consumption, readings),
    "G3_zone_analysis": _on(consumption.zone_analysis, readings),
    "G4_top_consumers": _on(consumption.top_consumers, readings),
    "G5_peak_hours": _on(consumption.peak_hours, readings),
    "G6_anomaly_counts": _on(consumption.anomaly_counts, readings),
    "G7_power_factor_by_meter": _on(consumption.power_factor_by_meter, light),
    "G8_quarterly_totals": _on(consumption.quarterly_totals, star_readings),
    "G9_daily_average": _on(consumption.daily_average, readings),
    "G10_daily_by_meter_latest": _on(consumption.daily_by_meter_latest, readings),
    "G11_cumulative_consumption": _on(consumption.cumulative_consumption, readings),
    "G12_zone_statistics": _on(consumption.zone_statistics, readings),
    "G13_efficiency_ratings": _on(consumption.efficiency_ratings, light),
    "G14_consumption_spikes": _on(consumption.consumption_spikes, readings),
    "G15_load_volatility": _on(consumption.load_volatility, readings),
    # trends and rankings
    "B1_hourly_trend": _on(consumption.hourly_trend, readings),
    "B2_daily_by_weekday": _on(consumption.daily_by_weekday, readings),
    "B3_zone_ranking": _on(consumption.zone_ranking, readings),
    "B4_top_meters_ranked": _on(consumption.top_meters_ranked, readings),
    "B5_peak_hours_ranked": _on(consumption.peak_hours_ranked, readings),
    "B6_daily_change_by_meter": _on(consumption.daily_change_by_meter, readings),
    "B7_meter_iqr_anomalies": _on(consumption.meter_iqr_anomalies, readings),
    "B8_poor_power_factor": _on(consumption.poor_power_factor, readings),
    "B9_quarterly_growth": _on(consumption.quarterly_growth, star_readings),
    "B10_rolling_daily_averages": _on(consumption.rolling_daily_averages, readings),
    "B11_cumulative_by_meter": _on(consumption.cumulative_by_meter, readings),
    "B11_cumulative_by_meter_all": _on(consumption.cumulative_by_meter, readings, n=None),
    "B12_zone_distribution": _on(consumption.zone_distribution, readings),
    "B13_zone_hour_demand": _on(consumption.zone_hour_demand, readings),
    "B14_hourly_volatility": _on(consumption.hourly_volatility, readings),
    "B15_top_hours_by_zone": _on(consumption.top_hours_by_zone, readings),
    "B16_month_over_month": _on(consumption.month_over_month, star_readings),
    "B17_efficiency_by_meter": _on(consumption.efficiency_by_meter, readings),
    "B18_context_spikes": _spikes,
    "B18_context_spikes_all": _spikes_all,
    # star-schema reports
    "D1_1_daily_by_meter": _on(reports.daily_by_meter, star_fact, star_meters, star_zones),
    "D1_2_monthly_trend": _on(reports.monthly_trend, star_fact, star_meters, star_zones),
    "D1_3_year_over_year": _on(reports.year_over_year, star_fact, star_zones),
    "D2_1_peak_by_season": _on(reports.peak_by_season, star_fact, star_times),
    "D2_2_peak_share_by_meter": _on(reports.peak_share_by_meter, fact, meters),
    "D2_3_load_profile": _on(reports.load_profile, fact),
    "D3_1_zone_summary": _on(reports.zone_summary, fact, zones),
    "D3_2_zone_by_hour": _on(reports.zone_by_hour, fact, zones),
    "D3_3_zone_comparison": lambda s, d: reports.zone_comparison(
        reports.zone_summary(fact(s, d), zones(s, d))
    ),
    "D4_1_anomalies_by_meter": _on(reports.anomalies_by_meter, star_fact, star_meters),
    "D4_2_anomalies_by_day": _on(reports.anomalies_by_day, star_fact),
    "D4_3_top_anomalous_meters": _on(reports.top_anomalous_meters, star_fact, star_meters),
    "D4_4_data_quality_summary": _on(reports.data_quality_summary, flagged_fact),
    "D5_1_load_category_distribution": _on(reports.load_category_distribution, star_fact),
    "D5_2_load_category_by_meter": _on(reports.load_category_by_meter, star_fact, star_meters),
    "D6_1_power_factor_by_day": _on(reports.power_factor_by_day, fact),
    "D6_2_frequency_stability": _on(reports.frequency_stability, fact),
    "D6_3_voltage_stability": _on(reports.voltage_stability, fact),
    "D7_1_top_meters": _on(reports.top_meters, fact, meters, zones),
    "D7_2_bottom_meters": _on(reports.bottom_meters, fact, meters),
    "D7_3_rank_in_zone": _on(reports.rank_in_zone, fact, meters),
    "D8_1_seasonal_totals": _on(reports.seasonal_totals, star_fact),
    "D8_2_weekday_totals": _on(reports.weekday_totals, fact),
    "D9_1_submeter_shares": _on(reports.submeter_shares, fact, meters),
    "D10_1_meter_vs_zone": _on(reports.meter_vs_zone, fact, meters),
    # audits
    "Q1_1_null_counts": _on(audit.null_counts, fact),
    "Q1_2_meters_with_missing": _on(audit.meters_with_missing, fact, meters),
    "Q2_1_duplicate_readings": _on(audit.duplicate_readings, dup_fact),
    "Q2_2_duplicate_summary": _on(audit.duplicate_summary, dup_fact),
    "Q2_3_most_duplicated_meters": _on(audit.most_duplicated_meters, dup_fact, meters),
    "Q3_1_out_of_range_summary": _on(audit.out_of_range_summary, fact),
    "Q3_2_out_of_range_readings": _on(audit.out_of_range_readings, fact),
    "Q3_3_dead_voltage": _on(audit.dead_voltage, fact),
    "Q4_1_apparent_power_mismatch": _on(audit.apparent_power_mismatch, fact),
    "Q4_2_invalid_power_factor": _on(audit.invalid_power_factor, _raw_pf_fact),
    "Q4_3_reading_gaps": _on(audit.reading_gaps, fact, meters),
    "Q4_3_reading_gaps_dup": _on(audit.reading_gaps, dup_fact, meters),
    "Q5_1_anomaly_summary_by_meter": _on(audit.anomaly_summary_by_meter, star_fact, star_meters),
    "Q5_2_anomalies_by_date": _on(audit.anomalies_by_date, star_fact),
    "Q5_3_high_anomaly_meters": _on(audit.high_anomaly_meters, star_fact, star_meters),
    "Q6_1_quality_overview": _on(audit.quality_overview, flagged_fact, meters, zones),
    "Q6_2_daily_quality": _on(audit.daily_quality, flagged_fact),
    # cleaning
    "C1_keep_first": lambda s, d: clean.keep_first(dup(s, d)),
    "C2_fill_missing": filled,
    "C2_missing_report": _missing_report,
    "C3_repair_compat": lambda s, d: clean.repair_ranges(readings(s, d), mode="compat"),
    "C3_repair_clip_always": lambda s, d: clean.repair_ranges(readings(s, d)),
    "C3_repair_report": _on(clean.repair_report, readings),
    "C4_logical_inconsistencies": _on(clean.logical_inconsistencies, readings),
    "C5_flag_outliers": _iqr_flags,
    "C5_outlier_counts": _on(clean.outlier_counts, readings),
    "C6_clean_readings": _clean("compat"),
    "C6_clean_readings_clip_always": _clean("clip_always"),
    "C6_clean_report": _clean_report,
    "C7_simple_clean": _simple,
    "C7_simple_clean_report": _simple_report,
    "C7_loose_range_report": _on(clean.loose_range_report, readings),
    "C8_zscore_outliers": _zscore,
    "C8_zscore_flags": lambda s, d: clean.flag_zscore(readings(s, d), POWER).select("_seq", "is_zscore_outlier"),
    # features
    "F1_temporal_and_season": _temporal,
    "F1_temporal_all_months": _star_temporal,
    "F3_peak_power_factor_load": _electrical,
    "F6_rolling_rows": _rolling,
    "F6_rolling_hours": _rolling_hours,
    "F7_consumption_bucket": lambda s, d: features.consumption_bucket(readings(s, d)).select(
        "_seq", "consumption_bucket"
    ),
    "F8_group_features": _groups,
    "F8_group_features_null_time": _groups_null_time,
    "AG1_extreme_values": _extremes,
    "F9_feature_table": _features,
    "F10_exploratory_features": _extras,
    "W17_consumption_change": _change,
    "W1_row_number": _row_number,
    # validation
    "V1_completeness": _on(quality.check_completeness, dup),
    "V2_uniqueness": _on(quality.check_uniqueness, dup),
    "V3_validity": _on(quality.check_validity, dup),
    "V4_consistency": _on(quality.check_consistency, dup, as_of=AS_OF),
    "V4_modal_gap": _on(quality.modal_gap, dup),
    "V5_anomaly_share": lambda s, d: quality.check_anomalies(clean.flag_outliers(readings(s, d))),
    "V6_lineage": _on(quality.lineage, dup),
    "V7_validate": _on(quality.validate, dup, as_of=AS_OF),
    "V8_quality_report": _on(quality.quality_report, dup),
    "V8_describe": _describe,
    "V9_ingestion_report": _on(quality.ingestion_report, dup),
    "V9_categorical_summary": _on(quality.categorical_summary, dup),
    "V9_value_counts": lambda s, d: quality.value_counts(dup(s, d), "Meter_ID"),
    "V10_completeness_score": _on(quality.completeness_score, dup),
    # materialised aggregates
    "M1_daily_by_meter": _on(star.daily_by_meter, readings),
    "M2_hourly_by_zone": _on(star.hourly_by_zone, readings),
    "M3_by_peak_flag": _by_peak,
    "M4_load_category_counts": _on(star.load_category_counts, light),
    "M5_agg_daily": _on(star.agg_daily_consumption, flagged_fact),
    "M6_agg_hourly_zone": _on(star.agg_hourly_zone_consumption, fact),
    "M7_agg_monthly": _on(star.agg_monthly_consumption, star_fact),
    "M8_dim_time": star_times,
    "M8_dim_meter": meters,
    "M8_dim_zone": zones,
    "M8_fact": _fact_sample,
    "M8_insert_absent": _insert_absent,
    "J10_band_lookup": _band_lookup,
    "J10_many_bands": _many_bands,
    "J11_second_delivery": _second_delivery,
    "M9_quality_log": lambda s, d: star.quality_log(clean.flag_outliers(readings(s, d), [POWER])),
    "M9_anomaly_records": _on(star.anomaly_records, readings),
    "M10_current_meter_status": _on(star.current_meter_status, star_fact, star_meters, star_zones),
    "M11_daily_comparison": lambda s, d: star.daily_consumption_comparison(
        star.agg_daily_consumption(
            star_fact(s, d).withColumns(
                {"power_factor": F.lit(None).cast("double"), "frequency_hz": F.lit(None).cast("double")}
            )
        ),
        star_zones(s, d),
    ),
    "M12_peak_hour_performance": _on(star.peak_hour_performance, flagged_fact),
    "M13_meter_summary": _on(star.meter_summary, readings),
    "M13_zone_summary": _on(star.zone_summary, readings),
    # analyses
    "A1_hourly_stats": _on(analytics.hourly_stats, readings),
    "A1_peak_hours": _on(analytics.peak_hours, readings),
    "A1_top_hours": _on(analytics.top_hours, readings),
    "A2_zone_stats": _on(analytics.zone_stats, readings),
    "A2_zone_ends": _on(analytics.zone_ends, readings),
    "A3_top_consumers": _on(analytics.top_consumers, readings),
    "A4_anomaly_summary": _on(analytics.anomaly_summary, readings),
    "A4_anomalies_by_zone": _on(analytics.anomalies_by_zone, readings),
    "A5_monthly_stats": _on(analytics.monthly_stats, star_readings),
    "A5_quarterly_stats": _on(analytics.quarterly_stats, star_readings),
    "A5_month_ends": _on(analytics.month_ends, star_readings),
    "A6_power_factor_stats": _on(analytics.power_factor_stats, light),
    "A7_load_profile": _on(analytics.load_profile, readings),
    "A7_weekday_weekend": _on(analytics.weekday_weekend, readings),
    # chart data
    "E1_hourly_band": _on(analytics.hourly_band, readings),
    "E2_by_day_of_month": _on(analytics.by_day_of_month, readings),
    "E2_by_date": _on(analytics.by_date, readings, order="last"),
    "E3_monthly_mean": _on(analytics.monthly_mean, star_readings),
    "E4_zone_mean_std": _on(analytics.zone_mean_std, readings),
    "E5_peak_comparison": _on(analytics.peak_comparison, readings),
    "E6_power_histogram": _histogram_edges(_on(analytics.histogram, readings)),
    "E7_anomaly_overview": _on(analytics.anomaly_overview, readings),
    "E8_top_meters": _on(analytics.top_meters, readings),
    "E9_hourly_reactive": _on(analytics.hourly_mean, readings, column="Reactive_Power_kW"),
    "E9_reactive_pairs": _pairs,
    "E10_voltage_statistics": _on(analytics.five_statistics, readings, column="Voltage_V"),
    "E10_voltage_histogram": _histogram_edges(_on(analytics.histogram, readings, column="Voltage_V")),
    "E11_hourly_max": _on(analytics.hourly_mean, readings, column=POWER, name="peak", how="max"),
    "E11_daily_mean": _on(analytics.by_date, readings, n=None),
    "E12_overview": _on(analytics.overview, readings),
    # generic operators and larger input
    "AG5_zone_quantiles_bulk": _zone_quantiles_bulk,
    "AG5_bracketed_quantiles": _bracketed,
    "AG5_daily_sketches": _daily_sketches,
    "AG9_merged_distinct": _merged_distinct,
    "W3_rank_counted": _rank_counted,
    "W10_running_without_time": _running_without_time,
    "AG10_distinct_bulk": _distinct_bulk,
    "M1_daily_by_meter_bulk": _on(star.daily_by_meter, bulk),
    "E8_top_meters_bulk": _on(analytics.top_meters, bulk),
    "SF1_parse_timestamps": _timestamps,
    "SF18_json_round_trip": _json_round_trip,
    "IO17_analytics_projection": _analytics_projection,
    "IO18_sample": _sampled,
    # streams
    "ST3_decode": _decoded,
    "ST3_dead_letters": _dead_letters,
    "ST8_deduplicate": _dedup,
    "ST9_hourly_by_zone": _stream(windows.hourly_by_zone, "hourly", "Zone_ID <> 'ZEND'"),
    "ST9_daily_by_meter": _stream(windows.daily_by_meter, "daily", "Meter_ID <> 'MTR-END'"),
    "ST10_sliding_average": _stream(windows.sliding_average, "sliding", "window_start < TIMESTAMP_NTZ '2090-01-01 00:00:00'"),
    "ST11_range_flags": _batch_quality,
    "ST12_gap_alerts": _gaps,
}
