"""Data-quality queries on the fact table: gaps, duplicates, ranges, consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions import electrical
from meterlake.functions.exact import out_of_range, percentage, rounded
from meterlake.operators.quality import null_profile
from meterlake.plans import ordered
from meterlake.plans.joins import with_group, with_scalars
from meterlake.plans.splits import measure
from meterlake.queries import reports

# Reported column -> fact column.
NULL_COLUMNS = {
    "Timestamp": "timestamp",
    "Meter_ID": "meter_id",
    "Zone_ID": "zone_id",
    "Voltage_V": "voltage_v",
    "Current_A": "current_a",
    "Active_Power_kW": "active_power_kw",
    "Reactive_Power_kW": "reactive_power_kw",
    "Power_Factor": "power_factor",
}

# Measurement: fact column, low, high, digits of the reported ends, label of the range.
RANGES = {
    "Voltage": ("voltage_v", 190, 250, 2, "190-250V"),
    "Current": ("current_a", 0, 100, 2, "0-100A"),
    "Active_Power": ("active_power_kw", 0, 25, 2, "0-25kW"),
    "Frequency": ("frequency_hz", 49.5, 50.5, 3, "49.5-50.5Hz"),
    "Temperature": ("outdoor_temp_c", -10, 50, 2, "-10 to 50°C"),
}

# Checked in this order; the first violated one names the reading.
VIOLATIONS = (
    ("voltage_v", 190, 250, "Voltage out of range"),
    ("current_a", 0, 100, "Current out of range"),
    ("active_power_kw", 0, 25, "Power out of range"),
    ("frequency_hz", 49.5, 50.5, "Frequency out of range"),
)


def _rows() -> Column:
    return F.count(F.lit(1))


def _incomplete() -> Column:
    out = F.lit(False)
    for c in ("voltage_v", "current_a", "active_power_kw"):
        out = out | F.col(c).isNull()
    return out


def _with_meter(df: DataFrame, meters: DataFrame) -> DataFrame:
    return with_group(df, meters.select("meter_id", "meter_name"), ["meter_id"])


def null_counts(fact: DataFrame) -> DataFrame:
    """Eight columns in one scan."""
    named = fact.select(*[F.col(c).alias(n) for n, c in NULL_COLUMNS.items()])
    profile = null_profile(named, list(NULL_COLUMNS))
    return profile.withColumn("null_percentage", percentage("null_count", "total_count"))


def meters_with_missing(fact: DataFrame, meters: DataFrame) -> DataFrame:
    grouped = fact.groupBy("meter_id").agg(
        _rows().alias("total_readings"),
        F.count_if(F.col("voltage_v").isNull()).alias("voltage_nulls"),
        F.count_if(F.col("current_a").isNull()).alias("current_nulls"),
        F.count_if(F.col("active_power_kw").isNull()).alias("power_nulls"),
        F.count_if(_incomplete()).alias("_bad"),
    )
    out = grouped.filter(F.col("_bad") > 0).withColumn(
        "overall_null_percentage", percentage("_bad", "total_readings")
    )
    return _with_meter(out.drop("_bad"), meters).orderBy(
        F.desc("overall_null_percentage"), "meter_id"
    )


def duplicate_readings(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("timestamp", "meter_id", "zone_id")
        .agg(_rows().alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
        .orderBy(F.desc("duplicate_count"), "timestamp", "meter_id", "zone_id")
    )


def duplicate_summary(fact: DataFrame) -> DataFrame:
    """Rows against distinct reading ids, counted by a pre-aggregate on the id."""
    ids = fact.groupBy("reading_id").agg(_rows().alias("_n"))
    row = ids.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_readings"),
        F.count("reading_id").alias("unique_reading_ids"),
    )
    extra = F.col("total_readings") - F.col("unique_reading_ids")
    return row.select(
        "*",
        extra.alias("duplicate_records"),
        percentage(extra, "total_readings").alias("duplicate_percentage"),
    )


def most_duplicated_meters(fact: DataFrame, meters: DataFrame, n: int = 10) -> DataFrame:
    """Readings beyond one per date and hour.  Hours, then days, then meters are folded."""
    hours = fact.groupBy("meter_id", F.to_date("timestamp").alias("_day"), "hour_of_day").agg(
        _rows().alias("_n")
    )
    days = hours.groupBy("meter_id", "_day").agg(F.sum("_n").alias("_n"), _rows().alias("_h"))
    grouped = days.groupBy("meter_id").agg(
        F.sum("_n").alias("total_records"),
        F.count("_day").alias("unique_dates"),
        (F.sum("_n") - F.sum("_h")).alias("duplicate_records"),
    )
    top = grouped.orderBy(F.desc("duplicate_records"), "meter_id").limit(n)
    return _with_meter(top, meters)


def out_of_range_summary(fact: DataFrame) -> DataFrame:
    """Five measurements in one scan."""
    aggs = [_rows().alias("_rows")]
    for name, (c, lo, hi, _, _) in RANGES.items():
        aggs += [
            F.count_if(out_of_range(c, lo, hi)).alias(f"{name}_n"),
            F.min(c).alias(f"{name}_lo"),
            F.max(c).alias(f"{name}_hi"),
        ]
    cells = [
        F.struct(
            F.lit(name).alias("measurement"),
            F.col(f"{name}_n").alias("out_of_range_count"),
            F.col("_rows").alias("total_count"),
            percentage(f"{name}_n", "_rows").alias("out_of_range_percentage"),
            rounded(f"{name}_lo", digits).alias("actual_min"),
            rounded(f"{name}_hi", digits).alias("actual_max"),
            F.lit(label).alias("expected_range"),
        )
        for name, (_, _, _, digits, label) in RANGES.items()
    ]
    return fact.agg(*aggs).select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def out_of_range_readings(fact: DataFrame, n: int = 100) -> DataFrame:
    """Latest violations, each named after the first range it breaks."""
    kind = None
    for c, lo, hi, label in VIOLATIONS:
        bad = out_of_range(c, lo, hi)
        kind = F.when(bad, label) if kind is None else kind.when(bad, label)
    return (
        fact.select(
            "reading_id", "timestamp", "meter_id", "zone_id", "voltage_v", "current_a",
            "active_power_kw", "frequency_hz", kind.alias("violation_type"),
        )
        .filter(F.col("violation_type").isNotNull())
        .orderBy(F.desc("timestamp"), F.desc("reading_id"))
        .limit(n)
    )


def dead_voltage(fact: DataFrame) -> DataFrame:
    row = fact.agg(
        F.count_if(electrical.dead_voltage("voltage_v", "current_a")).alias(
            "zero_voltage_nonzero_current_records"
        ),
        _rows().alias("_rows"),
    )
    return row.select(
        "zero_voltage_nonzero_current_records",
        percentage("zero_voltage_nonzero_current_records", "_rows").alias("percentage_of_total"),
    )


def apparent_power_mismatch(
    fact: DataFrame, tolerance: float = config.APPARENT_POWER_TOLERANCE, n: int = 100
) -> DataFrame:
    calc = electrical.apparent_power("active_power_kw", "reactive_power_kw")
    off = F.abs(F.col("apparent_power_kva") - calc)
    return (
        fact.filter(off > tolerance)
        .select(
            "reading_id",
            "timestamp",
            "meter_id",
            "active_power_kw",
            "reactive_power_kw",
            "apparent_power_kva",
            rounded(calc, 3).alias("calculated_apparent_power"),
            rounded(off, 3).alias("variance"),
        )
        .orderBy(F.desc("variance"), "reading_id")
        .limit(n)
    )


def invalid_power_factor(fact: DataFrame) -> DataFrame:
    pf = F.col("power_factor")
    row = fact.agg(
        F.count_if((pf < 0) | (pf > 1)).alias("power_factor_invalid_count"), _rows().alias("_rows")
    )
    return row.select(
        "power_factor_invalid_count",
        percentage("power_factor_invalid_count", "_rows").alias("percentage_of_total"),
    )


def reading_gaps(
    fact: DataFrame, meters: DataFrame, minutes: int = config.EXPECTED_GAP_MINUTES
) -> DataFrame:
    """Steps to the meter's next strictly later reading that differ from the expected minutes.

    The next reading comes from ``lead`` over the meter's different times, not from a self
    join, and each copy of a time gives its row.  Minutes are counted by minute boundaries
    crossed.
    """
    work = fact.groupBy("meter_id", "timestamp").agg(F.count(F.lit(1)).alias("_copies"))
    stepped = ordered.frames(
        work,
        ["meter_id"],
        ["timestamp"],
        {"actual_time": lambda w: F.lead("timestamp").over(w)},
        measure(work, ["meter_id"], "timestamp"),
        after=1,
    )

    def minute(c):
        return F.date_trunc("minute", F.col(c)).cast("timestamp_ntz")

    gap = F.timestamp_diff("MINUTE", minute("timestamp"), minute("actual_time"))
    gaps = stepped.select(
        "meter_id",
        F.col("timestamp").alias("expected_time"),
        "actual_time",
        gap.alias("time_gap_minutes"),
        "_copies",
    ).filter(F.col("time_gap_minutes") != minutes)
    gaps = gaps.withColumn("_copies", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).drop("_copies")
    kind = F.when(F.col("time_gap_minutes") > minutes, "Missing readings").otherwise(
        "Duplicate period"
    )
    return _with_meter(gaps.withColumn("gap_type", kind), meters)


anomaly_summary_by_meter = reports.anomalies_by_meter
anomalies_by_date = reports.anomalies_by_day


def high_anomaly_meters(fact: DataFrame, meters: DataFrame, n: int = 20) -> DataFrame:
    return reports.top_anomalous_meters(fact, meters, n)


def quality_overview(fact: DataFrame, meters: DataFrame, zones: DataFrame) -> DataFrame:
    """One row over everything; the fact table is read for one aggregate and one id count."""
    flagged = F.col("is_anomaly") == 1
    bad = F.coalesce(flagged, F.lit(False)) | F.col("voltage_v").isNull() | F.col("current_a").isNull()
    days = fact.groupBy(F.to_date("timestamp").alias("_day")).agg(
        _rows().alias("_rows"),
        F.count_if(_incomplete()).alias("_nulls"),
        F.count_if(flagged).alias("_anomalies"),
        F.count_if(bad).alias("_bad"),
    )
    row = days.agg(
        F.sum("_rows").alias("total_records"),
        F.count("_day").alias("days_covered"),
        F.sum("_nulls").alias("_nulls"),
        F.sum("_anomalies").alias("_anomalies"),
        F.sum("_bad").alias("_bad"),
    )
    row = with_scalars(row, duplicate_summary(fact).select("duplicate_percentage"))
    row = with_scalars(row, meters.agg(_rows().alias("total_meters")))
    row = with_scalars(row, zones.agg(_rows().alias("total_zones")))
    return row.select(
        "total_records",
        "total_meters",
        "total_zones",
        "days_covered",
        "duplicate_percentage",
        percentage("_nulls", "total_records").alias("null_percentage"),
        percentage("_anomalies", "total_records").alias("anomaly_percentage"),
        percentage(F.col("total_records") - F.col("_bad"), "total_records").alias(
            "overall_quality_score_percentage"
        ),
    )


def daily_quality(fact: DataFrame) -> DataFrame:
    """Daily score; a reading that is both incomplete and anomalous counts twice, as defined."""
    wrong = F.lit(False)
    for c, lo, hi, _ in VIOLATIONS[:3]:
        wrong = wrong | out_of_range(c, lo, hi)
    days = fact.groupBy(F.to_date("timestamp").alias("reading_date")).agg(
        _rows().alias("total_readings"),
        F.count_if(_incomplete()).alias("null_records"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomaly_records"),
        F.count_if(wrong).alias("out_of_range_records"),
    )
    good = F.col("total_readings") - F.col("null_records") - F.col("anomaly_records")
    return days.withColumn("daily_quality_score", percentage(good, "total_readings")).orderBy(
        F.desc("reading_date")
    )
