"""Named queries on readings, run as a set with per-query metrics."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from meterlake.operators import star
from meterlake.queries import audit as q
from meterlake.queries import consumption as c
from meterlake.queries import reports as r


@dataclass(frozen=True)
class Star:
    """The stored star schema that reports and audit queries read."""

    fact: DataFrame
    meters: DataFrame
    zones: DataFrame
    times: DataFrame
    daily: DataFrame


Query = Callable[[DataFrame | Star], DataFrame]

# The standard set: every query needs the flat readings with a power_factor column.
STANDARD: dict[str, Query] = {
    "hourly_consumption": c.hourly_consumption,
    "daily_consumption": c.daily_consumption,
    "zone_analysis": c.zone_analysis,
    "top_consumers": c.top_consumers,
    "peak_hours": c.peak_hours,
    "anomaly_detection": c.anomaly_counts,
    "power_factor_analysis": c.power_factor_by_meter,
    "quarterly_growth": c.quarterly_totals,
    "moving_avg_24h": c.daily_average,
    "rolling_avg": c.daily_by_meter_latest,
    "cumulative_consumption": c.cumulative_consumption,
    "zone_statistics": c.zone_statistics,
    "efficiency_scores": c.efficiency_ratings,
    "consumption_spikes": c.consumption_spikes,
    "load_volatility": c.load_volatility,
}

# Ranked and windowed queries on the same readings.
DETAILED: dict[str, Query] = {
    "hourly_trend": c.hourly_trend,
    "daily_by_weekday": c.daily_by_weekday,
    "zone_ranking": c.zone_ranking,
    "top_meters_ranked": c.top_meters_ranked,
    "peak_hours_ranked": c.peak_hours_ranked,
    "daily_change_by_meter": c.daily_change_by_meter,
    "meter_iqr_anomalies": c.meter_iqr_anomalies,
    "poor_power_factor": c.poor_power_factor,
    "quarterly_change": c.quarterly_growth,
    "rolling_daily_averages": c.rolling_daily_averages,
    "cumulative_by_meter": c.cumulative_by_meter,
    "zone_distribution": c.zone_distribution,
    "zone_hour_demand": c.zone_hour_demand,
    "hourly_volatility": c.hourly_volatility,
    "top_hours_by_zone": c.top_hours_by_zone,
    "month_over_month": c.month_over_month,
    "efficiency_by_meter": c.efficiency_by_meter,
    "context_spikes": c.context_spikes,
}

# Reports and audits on the star schema.
STAR: dict[str, Query] = {
    "daily_by_meter": lambda s: r.daily_by_meter(s.fact, s.meters, s.zones),
    "monthly_trend": lambda s: r.monthly_trend(s.fact, s.meters, s.zones),
    "year_over_year": lambda s: r.year_over_year(s.fact, s.zones),
    "peak_by_season": lambda s: r.peak_by_season(s.fact, s.times),
    "peak_share_by_meter": lambda s: r.peak_share_by_meter(s.fact, s.meters),
    "load_profile": lambda s: r.load_profile(s.fact),
    "zone_summary": lambda s: r.zone_summary(s.fact, s.zones),
    "zone_by_hour": lambda s: r.zone_by_hour(s.fact, s.zones),
    "zone_comparison": lambda s: r.zone_comparison(r.zone_summary(s.fact, s.zones)),
    "anomalies_by_meter": lambda s: r.anomalies_by_meter(s.fact, s.meters),
    "anomalies_by_day": lambda s: r.anomalies_by_day(s.fact),
    "top_anomalous_meters": lambda s: r.top_anomalous_meters(s.fact, s.meters),
    "data_quality_summary": lambda s: r.data_quality_summary(s.fact),
    "load_category_distribution": lambda s: r.load_category_distribution(s.fact),
    "load_category_by_meter": lambda s: r.load_category_by_meter(s.fact, s.meters),
    "power_factor_by_day": lambda s: r.power_factor_by_day(s.fact),
    "frequency_stability": lambda s: r.frequency_stability(s.fact),
    "voltage_stability": lambda s: r.voltage_stability(s.fact),
    "top_meters": lambda s: r.top_meters(s.fact, s.meters, s.zones),
    "bottom_meters": lambda s: r.bottom_meters(s.fact, s.meters),
    "rank_in_zone": lambda s: r.rank_in_zone(s.fact, s.meters),
    "seasonal_totals": lambda s: r.seasonal_totals(s.fact),
    "weekday_totals": lambda s: r.weekday_totals(s.fact),
    "submeter_shares": lambda s: r.submeter_shares(s.fact, s.meters),
    "meter_vs_zone": lambda s: r.meter_vs_zone(s.fact, s.meters),
    "null_counts": lambda s: q.null_counts(s.fact),
    "meters_with_missing": lambda s: q.meters_with_missing(s.fact, s.meters),
    "duplicate_readings": lambda s: q.duplicate_readings(s.fact),
    "duplicate_summary": lambda s: q.duplicate_summary(s.fact),
    "most_duplicated_meters": lambda s: q.most_duplicated_meters(s.fact, s.meters),
    "out_of_range_summary": lambda s: q.out_of_range_summary(s.fact),
    "out_of_range_readings": lambda s: q.out_of_range_readings(s.fact),
    "dead_voltage": lambda s: q.dead_voltage(s.fact),
    "apparent_power_mismatch": lambda s: q.apparent_power_mismatch(s.fact),
    "invalid_power_factor": lambda s: q.invalid_power_factor(s.fact),
    "reading_gaps": lambda s: q.reading_gaps(s.fact, s.meters),
    "high_anomaly_meters": lambda s: q.high_anomaly_meters(s.fact, s.meters),
    "quality_overview": lambda s: q.quality_overview(s.fact, s.meters, s.zones),
    "daily_quality": lambda s: q.daily_quality(s.fact),
}

# Reports by the names of the views they stand for.
VIEWS: dict[str, Query] = {
    "vw_current_meter_status": lambda s: star.current_meter_status(s.fact, s.meters, s.zones),
    "vw_daily_consumption_comparison": lambda s: star.daily_consumption_comparison(s.daily, s.zones),
    "vw_peak_hour_performance": lambda s: star.peak_hour_performance(s.fact),
    "vw_anomaly_summary_by_meter": lambda s: q.anomaly_summary_by_meter(s.fact, s.meters),
    **{
        f"vw_{n}": STAR[n]
        for n in (
            "daily_by_meter", "monthly_trend", "peak_by_season", "zone_summary", "anomalies_by_meter",
            "load_category_distribution", "out_of_range_summary", "rank_in_zone", "reading_gaps", "quality_overview",
        )
    },
}


def create_views(tables: Star) -> list[str]:
    """Register every view of ``VIEWS`` in the session; returns their names."""
    for name, query in VIEWS.items():
        query(tables).createOrReplaceTempView(name)
    return list(VIEWS)


METRICS = (
    "name string, status string, row_count long, column_count int, columns string, "
    "started_at timestamp, seconds double, notes string"
)


class CatalogError(ValueError):
    """A query name is unknown or used twice."""


def select(names: Iterable[str] | None = None, queries: dict[str, Query] | None = None):
    queries = queries or STANDARD
    if names is None:
        return dict(queries)
    names = list(names)
    unknown = [n for n in names if n not in queries]
    if unknown or len(set(names)) != len(names):
        raise CatalogError(f"unknown or repeated queries: {unknown or names}")
    return {n: queries[n] for n in names}


def write_counted(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write and return the row count, observed on the way instead of by a second scan."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)
    return int(seen.get["rows"])


def run(
    readings: DataFrame | Star,
    out_dir: str,
    names: Iterable[str] | None = None,
    queries: dict[str, Query] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Run queries, write each result under its name, return one metrics row per query.

    A failing query is recorded and does not stop the others.
    """
    rows = []
    for name, query in select(names, queries).items():
        started, clock = dt.datetime.now(dt.timezone.utc), time.monotonic()
        columns, count, status, notes = [], None, "ERROR", None
        try:
            result = query(readings)
            columns = result.columns
            count = write_counted(result, f"{out_dir}/{name}", fmt)
            status = "SUCCESS" if count else "EMPTY"
        except Exception as e:  # noqa: BLE001 - recorded as the query's outcome
            notes = f"{type(e).__name__}: {e}"
        seconds = time.monotonic() - clock
        rows.append((name, status, count, len(columns), ",".join(columns), started, seconds, notes))
    return SparkSession.active().createDataFrame(rows, METRICS)


def missing_outputs(metrics: DataFrame, asked: int | None = None) -> list[str]:
    """Problems with a finished run: failed or empty queries, and fewer results than were asked for."""
    rows = metrics.select("name", "status").collect()  # one row per query
    good = [r.name for r in rows if r.status == "SUCCESS"]
    problems = [f"{r.name}: {r.status}" for r in rows if r.status != "SUCCESS"]
    if asked is not None and len(good) < asked:
        problems.append(f"{len(good)} of {asked} results")
    return problems


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)


def load_result(spark: SparkSession, out_dir: str, name: str, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    return (reader.option("header", True) if fmt == "csv" else reader).load(f"{out_dir}/{name}")
