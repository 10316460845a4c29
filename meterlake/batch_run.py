"""The batch run: ingest, clean, derive, check, store, analyse, with stage metrics."""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, SparkSession

from meterlake.operators import analytics, clean, features, quality, star
from meterlake.plans.staging import release, stage
from meterlake.queries import catalog
from meterlake.sources import files, tables

STAGES = (
    "stage string, status string, rows_input long, rows_output long, execution_start timestamp, "
    "duration_seconds double, notes string"
)


class _Log:
    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.last: int | None = None

    def step(self, name: str, work):
        started, clock = dt.datetime.now(dt.timezone.utc), time.monotonic()
        result, rows, status, notes = work()
        seconds = time.monotonic() - clock
        self.rows.append((name, status, self.last, rows, started, seconds, notes))
        self.last = rows
        return result


def run(
    spark: SparkSession,
    csv_path: str,
    out_dir: str,
    mode: str = "compat",
    strict: bool = True,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Process one delivery of readings; returns one metrics row per stage.

    Results go to ``out_dir``: cleaned and featured readings, the analytics table,
    aggregates, analyses and named queries.  With ``strict`` a failed check raises
    before anything is stored.
    """
    log = _Log()

    def ingest():
        df, failures = files.ingest(spark, csv_path)
        df = stage(df, "ingested")
        # Cells that had text but no usable value, per column.
        tables.save_parquet(failures, f"{out_dir}/reports/conversion", by_date=False)
        tables.save_parquet(quality.quality_report(df), f"{out_dir}/reports/ingestion", by_date=False)
        return df, df.count(), "success", None

    def cleaning():
        df = stage(clean.clean_readings(log_input["raw"], mode), "cleaned", by=[clean.METER], rows=log.last)
        report = clean.clean_report(log_input["raw"], df, df)  # cleaning removes copies and nothing else
        tables.save_parquet(report, f"{out_dir}/reports/cleaning", by_date=False)
        tables.save_csv(df, f"{out_dir}/csv/cleaned")
        return df, df.count(), "success", None

    def derive():
        df = features.feature_table(log_input["clean"])
        tables.save_parquet(df, f"{out_dir}/features")
        report = features.feature_report(log_input["clean"], df)
        tables.save_parquet(report, f"{out_dir}/reports/features", by_date=False)
        out = spark.read.parquet(f"{out_dir}/features").drop("reading_date")
        tables.save_csv(out, f"{out_dir}/csv/features")
        return out, out.count(), "success", None

    def check():
        report = quality.validate(log_input["clean"].drop("_seq"), as_of)
        tables.save_parquet(report, f"{out_dir}/validation", by_date=False)
        failed = [r.check_name for r in report.collect() if not r.passed]
        if failed and strict:
            raise quality.ValidationFailed(f"failed checks: {sorted(failed)}")
        return None, log.last, "warning" if failed else "success", ",".join(sorted(failed)) or None

    def store():
        df = log_input["features"]
        tables.save_parquet(files.analytics_projection(df), f"{out_dir}/analytics")
        views = {
            "daily_consumption": star.daily_by_meter(df),
            "hourly_zone_consumption": star.hourly_by_zone(df),
            "peak_hour_analysis": star.by_peak_flag(df),
            "load_category_distribution": star.load_category_counts(df),
        }
        for name, view in views.items():
            tables.save_parquet(view, f"{out_dir}/aggregates/{name}", by_date=False)
        log_input["star"] = store_star(spark, df, f"{out_dir}/star")
        return None, log.last, "success", None

    def analyse():
        df = log_input["features"]
        for name, result in analytics.run_all_analyses(df).items():
            tables.save_json(result, f"{out_dir}/analyses/{name}")
        on_readings = catalog.STANDARD | catalog.DETAILED
        metrics = catalog.run(df, f"{out_dir}/queries", queries=on_readings)
        catalog.create_views(log_input["star"])
        metrics = metrics.union(catalog.run(log_input["star"], f"{out_dir}/queries", queries=catalog.STAR))
        catalog.append_metrics(metrics, f"{out_dir}/query_metrics")
        # An audit that finds nothing is a good result.
        failed = metrics.filter("status = 'ERROR'")
        problems = catalog.missing_outputs(failed)
        return None, log.last, "warning" if problems else "success", "; ".join(problems) or None

    log_input: dict = {}
    try:
        log_input["raw"] = log.step("ingestion", ingest)
        log_input["clean"] = log.step("cleaning", cleaning)
        log.step("validation", check)
        log_input["features"] = log.step("feature_engineering", derive)
        log.step("storage", store)
        log.step("analysis", analyse)
        metrics = spark.createDataFrame(log.rows, STAGES)
        metrics.write.mode("append").parquet(f"{out_dir}/stage_metrics")
    finally:
        release(spark)  # nothing staged outlives the run, however it ends
    return metrics


def store_star(spark: SparkSession, df: DataFrame, path: str) -> catalog.Star:
    """Write dimensions, facts, aggregates and quality tables; returns them as stored."""

    def kept(name: str, table: DataFrame) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{path}/{name}")
        return spark.read.schema(table.schema).parquet(f"{path}/{name}")

    profiles = kept("dim_load_profile", star.dim_load_profile(spark))
    fact = kept("fact_energy_reading", star.fact_table(df, profiles))
    kept("agg_hourly_zone_consumption", star.agg_hourly_zone_consumption(fact))
    kept("agg_monthly_consumption", star.agg_monthly_consumption(fact))
    kept("dq_quality_log", star.quality_log(df))
    kept("dq_anomalies", star.anomaly_records(df))
    return catalog.Star(
        fact,
        kept("dim_meter", star.dim_meter(df)),
        kept("dim_zone", star.dim_zone(df)),
        kept("dim_time", star.dim_time(df)),
        kept("agg_daily_consumption", star.agg_daily_consumption(fact)),
    )
