"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and once on the clock, into a sink that reads
every row.  ``stages_1m`` times the stages of the batch run on one million
readings (the events repeated under other meter ids), to compare with the
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import registry  # noqa: E402
from meterlake.operators import clean, features, quality  # noqa: E402
from meterlake.plans.staging import release, stage  # noqa: E402
from meterlake.session import local_session  # noqa: E402

HEADLINE = (
    "G1_hourly_consumption",
    "G2_daily_consumption",
    "G4_top_consumers",
    "G6_anomaly_counts",
    "G12_zone_statistics",
    "G14_consumption_spikes",
    "B1_hourly_trend",
    "B4_top_meters_ranked",
    "B6_daily_change_by_meter",
    "B7_meter_iqr_anomalies",
    "B10_rolling_daily_averages",
    "B11_cumulative_by_meter",
    "B11_cumulative_by_meter_all",
    "B12_zone_distribution",
    "B18_context_spikes_all",
    "D1_1_daily_by_meter",
    "D1_2_monthly_trend",
    "D3_1_zone_summary",
    "D5_2_load_category_by_meter",
    "D7_3_rank_in_zone",
    "D10_1_meter_vs_zone",
    "Q1_1_null_counts",
    "Q2_1_duplicate_readings",
    "Q4_3_reading_gaps",
    "Q6_1_quality_overview",
    "C1_keep_first",
    "C5_flag_outliers",
    "C6_clean_readings",
    "F6_rolling_rows",
    "F8_group_features",
    "F9_feature_table",
    "F10_exploratory_features",
    "V7_validate",
    "M5_agg_daily",
    "M6_agg_hourly_zone",
    "M7_agg_monthly",
    "M1_daily_by_meter_bulk",
    "AG5_zone_quantiles_bulk",
    "AG10_distinct_bulk",
    "A3_top_consumers",
    "E5_peak_comparison",
    "E6_power_histogram",
    "ST9_hourly_by_zone",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def clocked(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def million(spark, sf_dir):
    """The readings with copies, ten times, each time under other meters."""
    base = registry.dup(spark, sf_dir)
    ten = spark.range(10).withColumnRenamed("id", "_copy")
    out = base.crossJoin(F.broadcast(ten))
    return out.withColumns(
        {
            "Meter_ID": F.concat_ws("-", "Meter_ID", "_copy"),
            "_seq": F.col("_seq") + F.col("_copy") * 10_000_000_000,
        }
    ).drop("_copy")


def stages(spark, sf_dir) -> dict[str, float]:
    out, held = {}, {}

    def ingest():
        held["raw"] = stage(million(spark, sf_dir), "raw")

    def cleaning():
        held["clean"] = stage(clean.clean_readings(held["raw"]), "clean", by=["Meter_ID"])

    def derive():
        held["features"] = stage(features.feature_table(held["clean"]), "features")

    def validate():
        quality.validate(held["clean"]).collect()

    for name, work in (
        ("ingest", ingest),
        ("cleaning", cleaning),
        ("validation", validate),
        ("features_and_store", derive),
    ):
        out[name] = clocked(work)
    out["total"] = round(sum(out.values()), 3)
    out["rows"] = held["raw"].count()
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus)
    queries, times = registry.QUERIES, {}
    for name in HEADLINE:
        drain(queries[name](spark, sf_dir))
        times[name] = clocked(lambda n=name: drain(queries[n](spark, sf_dir)))
        print(f"{name}: {times[name]}", file=sys.stderr)
    release(spark)
    stage_times = stages(spark, sf_dir)
    release(spark)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
                "stages_1m": stage_times,
            }
        )
    )


if __name__ == "__main__":
    main()
