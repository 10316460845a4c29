"""Validation checks and profiles.  Each is one aggregate over the table where possible."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import config
from meterlake.functions.exact import out_of_range, rounded
from meterlake.operators.clean import METER, SEQ, TIME
from meterlake.plans import ordered
from meterlake.plans.joins import with_scalars
from meterlake.plans.quantiles import COLUMN, long_quantiles
from meterlake.plans.splits import measure
from meterlake.schema import numeric_columns

ZONE = "Zone_ID"


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != SEQ]


def _rows(one_row: DataFrame, cells: list[Column]) -> DataFrame:
    """One aggregate row turned into one row per struct."""
    return one_row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def _share(part, whole) -> Column:
    return F.coalesce(F.try_divide(F.col(part) * 100.0, F.col(whole)), F.lit(0.0))


# --- profiles -----------------------------------------------------------------


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """column_name, null_count, total_count, null_percentage: one scan for all columns."""
    columns = list(columns or _data_columns(df))
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n_{c}").alias("null_count"),
            F.col("_rows").alias("total_count"),
            rounded(_share(f"n_{c}", "_rows"), 6).alias("null_percentage"),
        )
        for c in columns
    ]
    return _rows(row, cells)


def full_duplicates(df: DataFrame) -> DataFrame:
    """total_rows, duplicate_rows, duplicate_percentage over whole rows."""
    groups = df.groupBy(*_data_columns(df)).agg(F.count(F.lit(1)).alias("_n"))
    row = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
    share = rounded(_share("duplicate_rows", "total_rows"), 6).alias("duplicate_percentage")
    return row.select("total_rows", "duplicate_rows", share)


def key_duplicates(df: DataFrame, keys=(METER, TIME)) -> DataFrame:
    """Keys that occur more than once, and the surplus rows."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("surplus_rows"),
    )


def range_violations(df: DataFrame, ranges=None) -> DataFrame:
    """column_name, out_of_range_count, valid_min, valid_max, for every range."""
    ranges = {c: r for c, r in (ranges or config.VALID_RANGES).items() if c in df.columns}
    row = df.agg(*[F.count_if(out_of_range(c, lo, hi)).alias(c) for c, (lo, hi) in ranges.items()])
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).alias("out_of_range_count"),
            F.lit(float(lo)).alias("valid_min"),
            F.lit(float(hi)).alias("valid_max"),
        )
        for c, (lo, hi) in ranges.items()
    ]
    return _rows(row, cells)


def describe(df: DataFrame, columns=None) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per numeric column."""
    columns = list(columns or numeric_columns(df))
    aggs = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"{c}_count"),
            F.avg(c).alias(f"{c}_mean"),
            F.stddev_samp(c).alias(f"{c}_std"),
            F.min(c).cast("double").alias(f"{c}_min"),
            F.max(c).cast("double").alias(f"{c}_max"),
        ]
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            *[F.col(f"{c}_{m}").alias(m) for m in ("count", "mean", "std", "min", "max")],
        )
        for c in columns
    ]
    basics = _rows(df.agg(*aggs), cells)
    quartiles = long_quantiles(df, [], columns, [0.25, 0.5, 0.75])
    return basics.join(quartiles, COLUMN, "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))


def categorical_summary(df: DataFrame, columns=None, show_up_to: int = 10) -> DataFrame:
    """Distinct values per text column, and the counts where there are few values.

    Values and counts come out as rows.  A column with more values gives one row
    with no value, so an identifier column never fans out.
    """
    texts = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    long = (
        df.select(*texts).unpivot([], list(texts), COLUMN, "value").filter(F.col("value").isNotNull())
    )
    counts = long.groupBy(COLUMN, "value").agg(F.count(F.lit(1)).alias("row_count"))
    unique = counts.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("unique_values"))
    few = unique.filter(F.col("unique_values") <= show_up_to)
    many = unique.filter(F.col("unique_values") > show_up_to)
    shown = counts.join(F.broadcast(few), COLUMN).select(
        COLUMN, "unique_values", "value", "row_count"
    )
    hidden = many.select(
        COLUMN,
        "unique_values",
        F.lit(None).cast("string").alias("value"),
        F.lit(None).cast("bigint").alias("row_count"),
    )
    return shown.unionByName(hidden)


def date_range(df: DataFrame) -> DataFrame:
    """First and last reading, whole days between, rows per day."""
    row = df.agg(
        F.min(TIME).alias("first_reading"),
        F.max(TIME).alias("last_reading"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("first_reading"), F.col("last_reading"))
    days = F.floor(seconds / 86400)
    return row.select(
        "*",
        days.alias("duration_days"),
        rounded(
            F.col("total_rows") / F.when(days == 0, F.lit(1)).otherwise(days), 6
        ).alias("rows_per_day"),
    )


def completeness_score(df: DataFrame) -> DataFrame:
    """100 minus the percentage of empty cells."""
    columns = _data_columns(df)
    empty = F.lit(0)
    for c in columns:
        empty = empty + F.count_if(F.col(c).isNull())
    row = df.agg(F.count(F.lit(1)).alias("total_rows"), empty.alias("null_cells"))
    cells = F.col("total_rows") * len(columns)
    score = 100.0 - F.coalesce(F.try_divide(F.col("null_cells") * 100.0, cells), F.lit(0.0))
    return row.select("total_rows", "null_cells", rounded(score, 6).alias("data_quality_score"))


def modal_gap(df: DataFrame) -> DataFrame:
    """Most frequent step between readings in time order; the smallest on ties.

    Equal timestamps are counted first and stand for steps of zero, so the
    ordered pass runs over distinct timestamps only.
    """
    stamps = df.filter(F.col(TIME).isNotNull()).groupBy(TIME).agg(F.count(F.lit(1)).alias("_n"))
    splits = measure(stamps, [], TIME)
    stepped = ordered.frames(
        stamps, [], [TIME], {"_prev": lambda w: F.lag(TIME).over(w)}, splits, before=1
    )
    step = F.timestamp_diff("MICROSECOND", F.col("_prev"), F.col(TIME))
    steps = stepped.select(
        F.explode(
            F.array(
                F.struct(step.alias("gap_us"), F.lit(1).cast("bigint").alias("n")),
                F.struct(F.lit(0).cast("bigint").alias("gap_us"), (F.col("_n") - 1).alias("n")),
            )
        ).alias("s")
    ).select("s.*")
    counted = (
        steps.filter("gap_us IS NOT NULL AND n > 0").groupBy("gap_us").agg(F.sum("n").alias("n"))
    )
    best = F.min(F.struct(-F.col("n"), F.col("gap_us").alias("gap_us"), F.col("n").alias("n")))
    return counted.agg(best.alias("b")).select(
        (F.col("b.gap_us") / 1_000_000).alias("modal_gap_seconds"), F.col("b.n").alias("occurrences")
    )


# --- checks -------------------------------------------------------------------


def check_completeness(df: DataFrame, threshold: float = config.QUALITY.nulls) -> DataFrame:
    """Per column: null percentage and whether it stays within the threshold."""
    return null_profile(df).withColumn("passed", F.col("null_percentage") <= threshold)


def check_uniqueness(df: DataFrame, threshold: float = config.QUALITY.duplicates) -> DataFrame:
    return full_duplicates(df).withColumn("passed", F.col("duplicate_percentage") <= threshold)


def check_validity(df: DataFrame, ranges=None) -> DataFrame:
    return range_violations(df, ranges).withColumn("passed", F.col("out_of_range_count") == 0)


def check_consistency(df: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Missing columns, repeated (meter, time) keys and readings later than ``as_of``.

    ``as_of`` is a parameter so that a result can be repeated; it defaults to now.
    """
    needed = ("Timestamp", "Meter_ID", "Zone_ID", "Active_Power_kW")
    missing = [c for c in needed if c not in df.columns]
    issues = [F.struct(F.lit("missing_columns").alias("issue"), F.lit(len(missing)).cast("bigint").alias("issue_count"))]
    row = df.agg(F.count(F.lit(1)).alias("_rows"))
    if METER in df.columns and TIME in df.columns:
        pairs = df.filter(F.col(METER).isNotNull() & F.col(TIME).isNotNull())
        row = with_scalars(row, key_duplicates(pairs))
        issues.append(F.struct(F.lit("duplicate_keys").alias("issue"), F.col("duplicate_keys").alias("issue_count")))
    if TIME in df.columns:
        now = F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp()
        row = with_scalars(row, df.agg(F.count_if(F.col(TIME) > now).alias("_future")))
        issues.append(F.struct(F.lit("future_readings").alias("issue"), F.col("_future").alias("issue_count")))
    return _rows(row, issues).withColumn("passed", F.col("issue_count") == 0)


def check_anomalies(df: DataFrame, threshold: float = config.QUALITY.anomalies) -> DataFrame:
    """Share of flagged readings; passes as skipped where there is no flag column."""
    flag = next((c for c in ("is_anomaly_raw", "is_anomaly") if c in df.columns), None)
    if flag is None:
        return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
            "total_rows",
            F.lit(None).cast("bigint").alias("anomaly_count"),
            F.lit(None).cast("double").alias("anomaly_percentage"),
            F.lit(True).alias("passed"),
        )
    row = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(flag).cast("int") == 1).alias("anomaly_count"),
    )
    share = rounded(_share("anomaly_count", "total_rows"), 6).alias("anomaly_percentage")
    return row.select("total_rows", "anomaly_count", share).withColumn(
        "passed", F.col("anomaly_percentage") <= threshold
    )


def lineage(df: DataFrame) -> DataFrame:
    """One row: size, date range, distinct meters and zones."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.lit(len(_data_columns(df))).cast("bigint").alias("total_columns"),
        F.min(TIME).alias("start"),
        F.max(TIME).alias("end"),
        F.count_distinct(METER).alias("meter_ids"),
        F.count_distinct(ZONE).alias("zone_ids"),
    )


def validate(df: DataFrame, as_of=None, thresholds=config.QUALITY, ranges=None) -> DataFrame:
    """One row per check: check_name, passed, failures; the last row is the overall status.

    Two passes: one aggregate for everything that is counted per row, and one
    grouping of whole rows, from which repeated keys are folded.
    """
    columns = _data_columns(df)
    ranges = {c: r for c, r in (ranges or config.VALID_RANGES).items() if c in df.columns}
    flag = next((c for c in ("is_anomaly_raw", "is_anomaly") if c in df.columns), None)
    now = F.lit(as_of).cast("timestamp_ntz") if as_of else F.localtimestamp()
    missing = [c for c in (TIME, METER, ZONE, "Active_Power_kW") if c not in df.columns]

    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
        *[F.count_if(out_of_range(c, lo, hi)).alias(f"r_{c}") for c, (lo, hi) in ranges.items()],
        (F.count_if(F.col(flag).cast("int") == 1) if flag else F.lit(0)).alias("_flagged"),
        (F.count_if(F.col(TIME) > now) if TIME in columns else F.lit(0)).alias("_future"),
    )
    distinct = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    keyed = METER in columns and TIME in columns
    if keyed:
        distinct = distinct.groupBy(METER, TIME).agg(
            F.sum("_n").alias("_n"), F.sum(F.col("_n") - 1).alias("_extra")
        )
        is_key = F.col(METER).isNotNull() & F.col(TIME).isNotNull()
        copies = F.count_if(is_key & (F.col("_n") > 1))
    else:
        distinct, copies = distinct.withColumn("_extra", F.col("_n") - 1), F.lit(0)
    row = with_scalars(
        row,
        distinct.agg(F.coalesce(F.sum("_extra"), F.lit(0)).alias("_extra"), copies.alias("_keys")),
    )

    def above(part, limit):
        return rounded(_share(part, "_rows"), 6) > limit

    def how_many(conds):
        total = F.lit(0).cast("bigint")
        for cond in conds:
            total = total + cond.cast("bigint")
        return total

    failures = {
        "completeness": how_many([above(f"n_{c}", thresholds.nulls) for c in columns]),
        "uniqueness": how_many([above("_extra", thresholds.duplicates)]),
        "validity": how_many([F.col(f"r_{c}") > 0 for c in ranges]),
        "consistency": how_many([F.lit(bool(missing)), F.col("_keys") > 0, F.col("_future") > 0]),
        "anomalies": how_many([above("_flagged", thresholds.anomalies)]),
    }
    lines = [
        F.struct(
            F.lit(n).alias("check_name"), (f == 0).alias("passed"), f.alias("failures")
        )
        for n, f in failures.items()
    ]
    checks = _rows(row, lines)
    # Five rows reach the windows that give the overall line.
    everything = Window.partitionBy()
    totals = checks.select(
        "*",
        F.bool_and("passed").over(everything).alias("_passed"),
        F.sum("failures").over(everything).alias("_failures"),
    )
    overall = F.struct(
        F.lit("overall").alias("check_name"),
        F.col("_passed").alias("passed"),
        F.col("_failures").alias("failures"),
    )
    lines = F.array(F.struct("check_name", "passed", "failures"), overall)
    return totals.select(F.explode(lines).alias("r")).select("r.*").dropDuplicates()


class ValidationFailed(RuntimeError):
    """Raised by ``require_valid`` when a check fails."""


def require_valid(df: DataFrame, **kw) -> DataFrame:
    """Run the checks and raise on failure: a gate before results are stored."""
    failed = [r.check_name for r in validate(df, **kw).collect() if not r.passed]
    if failed:
        raise ValidationFailed(f"failed checks: {sorted(failed)}")
    return df


def quality_report(df: DataFrame) -> DataFrame:
    """One row: rows, columns, empty cells, full duplicates and their shares."""
    columns = _data_columns(df)
    row = with_scalars(completeness_score(df).drop("total_rows"), full_duplicates(df))
    return row.select(
        "total_rows",
        F.lit(len(columns)).cast("bigint").alias("total_columns"),
        "null_cells",
        "duplicate_rows",
        "duplicate_percentage",
        "data_quality_score",
    )


def ingestion_report(df: DataFrame) -> DataFrame:
    """One row: size, full and key duplicates, date range, meters and zones."""
    row = with_scalars(quality_report(df), key_duplicates(df))
    row = with_scalars(row, date_range(df).drop("total_rows"))
    return with_scalars(row, lineage(df).select("meter_ids", "zone_ids"))
