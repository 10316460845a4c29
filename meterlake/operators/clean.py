"""Cleaning: de-duplication, gap filling, range repair, consistency and outlier flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import config
from meterlake.functions import electrical
from meterlake.functions.exact import clip, out_of_range, rounded
from meterlake.plans import ordered
from meterlake.plans.joins import scalar_row, with_scalars
from meterlake.plans.quantiles import wide_quantiles
from meterlake.plans.splits import Splits, measure
from meterlake.plans.staging import bucket_count, stage, stage_observed
from meterlake.schema import float_columns, numeric_columns, require

METER, TIME, SEQ = "Meter_ID", "Timestamp", "_seq"


def time_order(df: DataFrame) -> list[str]:
    """Ordering columns within a meter; the ingest ordinal settles equal timestamps."""
    return [TIME, SEQ] if SEQ in df.columns else [TIME]


def keep_first(df: DataFrame, keys=(METER, TIME), order=None, few_copies=False) -> DataFrame:
    """One row per key: the first in ``order`` (the ingest ordinal by default).

    An aggregate, not a row number: copies collapse before the shuffle, so a key
    with very many copies does not gather in one task.  ``few_copies`` says that
    this cannot happen; then each row is compared with the one before it, under a
    window of the first key, whose shuffle and sort later windows share.  Without
    an ordinal the smallest row is kept, which is repeatable too.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    by = list(order) if order else ([SEQ] if SEQ in df.columns else rest)
    if few_copies:
        w = Window.partitionBy(keys[0]).orderBy(*keys[1:], *by)
        repeats = F.lag(F.lit(True), 1, False).over(w)
        for k in keys[1:]:
            repeats = repeats & F.lag(k).over(w).eqNullSafe(F.col(k))
        return df.withColumn("_copy", repeats).filter("NOT _copy").drop("_copy")
    packed = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*by)).alias("_row"))
    return packed.select(*keys, "_row.*").select(*df.columns)


def drop_full_duplicates(df: DataFrame) -> DataFrame:
    """Distinct rows, leaving the ingest ordinal out of the comparison."""
    return df.drop(SEQ).dropDuplicates()


def fill_missing(df: DataFrame, columns=None, splits: Splits | None = None) -> DataFrame:
    """Forward then backward fill per meter, then the table-wide median.

    The filled table is staged, since the medians are taken over it.  A column
    whose gaps are all closed needs no median, and usually none does.
    """
    columns = list(columns or numeric_columns(df))
    splits = splits or measure(df, [METER], TIME)
    filled = ordered.fill(df, [METER], time_order(df), columns, splits)
    gaps = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    filled, left = stage_observed(filled, "filled", gaps, by=None if splits.any else [METER], rows=splits.total)
    open_columns = [c for c in columns if left[c]]
    if not open_columns:
        return filled
    medians = scalar_row(wide_quantiles(filled, open_columns, [0.5]))
    known = {c: medians[f"{c}_q50"] for c in open_columns if medians[f"{c}_q50"] is not None}
    return filled.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in known.items()})


def missing_report(before: DataFrame, after: DataFrame, columns=None) -> DataFrame:
    """Columns that had gaps: how many before and after, and their share."""
    columns = list(columns or numeric_columns(before))

    def counts(df, name):
        row = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
        )
        cells = [
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias(name), "_rows") for c in columns
        ]
        return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")

    first = counts(before, "initial_missing")
    last = counts(after, "final_missing").drop("_rows")
    return (
        first.join(last, "column_name")
        .filter(F.col("initial_missing") > 0)
        .select(
            "column_name",
            "initial_missing",
            "final_missing",
            rounded(F.col("initial_missing") * 100.0 / F.col("_rows"), 6).alias(
                "missing_percentage"
            ),
        )
    )


# --- range repair -------------------------------------------------------------


def _plan_repairs(df: DataFrame, ranges) -> list[tuple[str, float, float, Column, bool]]:
    """(column, low, high, rows that reach this step, whether it drops rows)."""
    alive, steps = F.lit(True), []
    for c, (low, high) in ranges.items():
        if c not in df.columns:
            continue
        drops = low >= 0 and c in config.NON_NEGATIVE
        steps.append((c, low, high, alive, drops))
        if drops:
            alive = alive & F.coalesce(F.col(c) >= low, F.lit(False))
    return steps


def repair_counts(df: DataFrame, ranges=None) -> DataFrame:
    """One row: per column the rows dropped and the values clipped at either end.

    Columns are treated in order, so a row dropped for one column is not counted
    for a later one.  All counts come from a single aggregate.
    """
    cells = []
    for c, low, high, alive, drops in _plan_repairs(df, ranges or config.VALID_RANGES):
        x = F.col(c)
        gone = F.lit(False)
        if drops:
            gone = ~F.coalesce(x >= low, F.lit(False))
        cells += [
            F.count_if(alive & gone).alias(f"{c}_dropped"),
            F.count_if(alive & ~gone & (x < low)).alias(f"{c}_low"),
            F.count_if(alive & ~gone & (x > high)).alias(f"{c}_high"),
        ]
    return df.agg(*cells)


def repair_ranges(df: DataFrame, ranges=None, mode: str = "clip_always") -> DataFrame:
    """Drop readings with negative or missing loads and clip values to their range.

    ``clip_always`` clips every column.  ``compat`` leaves a column that lost
    rows unclipped, as the published results were made.
    """
    if mode not in ("clip_always", "compat"):
        raise ValueError(f"unknown mode {mode!r}")
    ranges = ranges or config.VALID_RANGES
    steps = _plan_repairs(df, ranges)
    keep = F.lit(True)
    for c, low, _, _, drops in steps:
        if drops:
            keep = keep & (F.col(c) >= low)
    if mode == "clip_always":
        return df.filter(keep).withColumns({c: clip(c, lo, hi) for c, lo, hi, _, _ in steps})
    counts = scalar_row(repair_counts(df, ranges))
    return df.filter(keep).withColumns(
        {c: clip(c, lo, hi) for c, lo, hi, _, _ in steps if not counts[f"{c}_dropped"]}
    )


def repair_report(df: DataFrame, ranges=None) -> DataFrame:
    """One row per column that needed repair, with the action taken in ``compat``."""
    ranges = ranges or config.VALID_RANGES
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.when(F.col(f"{c}_dropped") > 0, "removed_negative").otherwise("clipped").alias(
                "action"
            ),
            F.col(f"{c}_dropped").alias("rows_removed"),
            F.when(F.col(f"{c}_dropped") > 0, 0).otherwise(F.col(f"{c}_low")).alias("clipped_low"),
            F.when(F.col(f"{c}_dropped") > 0, 0)
            .otherwise(F.col(f"{c}_high"))
            .alias("clipped_high"),
        )
        for c, *_ in _plan_repairs(df, ranges)
    ]
    rows = repair_counts(df, ranges).select(F.explode(F.array(*cells)).alias("r")).select("r.*")
    return rows.filter("rows_removed > 0 OR clipped_low > 0 OR clipped_high > 0")


# --- consistency and outliers -------------------------------------------------


def logical_inconsistencies(df: DataFrame) -> DataFrame:
    """Counts of rule violations; a rule appears only where it is violated."""
    rules = {
        "apparent_power_mismatch": electrical.apparent_mismatch(),
        "zero_voltage_with_current": electrical.dead_voltage(),
    }
    row = df.agg(*[F.count_if(cond).alias(n) for n, cond in rules.items()])
    cells = [F.struct(F.lit(n).alias("rule"), F.col(n).alias("row_count")) for n in rules]
    return (
        row.select(F.explode(F.array(*cells)).alias("r")).select("r.*").filter("row_count > 0")
    )


def iqr_bounds(df: DataFrame, columns, multiplier: float = config.IQR_MULTIPLIER) -> DataFrame:
    """One row: {column}_q25, _q75, _lower, _upper for every column."""
    q = wide_quantiles(df, columns, [0.25, 0.75])
    return q.select(
        "*",
        *[
            (F.col(f"{c}_q25") - multiplier * (F.col(f"{c}_q75") - F.col(f"{c}_q25"))).alias(
                f"{c}_lower"
            )
            for c in columns
        ],
        *[
            (F.col(f"{c}_q75") + multiplier * (F.col(f"{c}_q75") - F.col(f"{c}_q25"))).alias(
                f"{c}_upper"
            )
            for c in columns
        ],
    )


def outside_bounds(c: str, bounds: dict | None = None) -> Column:
    """Outside the fences, given as values or as joined columns; NULL is inside."""
    if bounds is None:
        low, high = F.col(f"{c}_lower"), F.col(f"{c}_upper")
    else:
        low, high = F.lit(bounds[f"{c}_lower"]), F.lit(bounds[f"{c}_upper"])
    return F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False))


def flag_outliers(
    df: DataFrame, columns=None, name: str = "is_anomaly", multiplier=config.IQR_MULTIPLIER
) -> DataFrame:
    """True where any column lies outside its table-wide quartile fences."""
    columns = list(columns or float_columns(df))
    q = scalar_row(wide_quantiles(df, columns, [0.25, 0.75]))
    bounds = {}
    for c in columns:
        low, high = q[f"{c}_q25"], q[f"{c}_q75"]
        reach = None if low is None else multiplier * (high - low)
        bounds[f"{c}_lower"] = None if low is None else low - reach
        bounds[f"{c}_upper"] = None if low is None else high + reach
    flag = F.lit(False)
    for c in columns:
        flag = flag | outside_bounds(c, bounds)
    return df.select(*[c for c in df.columns if c != name], flag.alias(name))


def outlier_counts(df: DataFrame, columns=None, multiplier=config.IQR_MULTIPLIER) -> DataFrame:
    columns = list(columns or float_columns(df))
    joined = with_scalars(df, iqr_bounds(df, columns, multiplier))
    row = joined.agg(*[F.count_if(outside_bounds(c)).alias(c) for c in columns])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("outliers")) for c in columns]
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def flag_zscore(
    df: DataFrame, column: str, threshold=config.Z_THRESHOLD, name: str = "is_zscore_outlier"
) -> DataFrame:
    """|x - mean| / sample std above the threshold; no spread means no outlier."""
    stats = df.agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std"))
    z = F.try_divide(F.abs(F.col(column) - F.col("_mean")), F.col("_std"))
    flag = F.coalesce(z > threshold, F.lit(False)).alias(name)
    return with_scalars(df, stats).select(*df.columns, flag)


# --- the whole chain ----------------------------------------------------------


def clean_readings(df: DataFrame, mode: str = "compat", columns=None) -> DataFrame:
    """Keep-first, fill, repair, flag.

    Without a hot meter the readings are hashed by meter once; de-duplication and
    filling share that shuffle and one sort, and the staged result stays bucketed
    by meter for the feature windows.  With one, copies are folded by an
    aggregate and the fill runs on slices.
    """
    require(df, [METER, TIME])
    splits = measure(df, [METER], TIME)
    if splits.any:
        unique = keep_first(df)
    else:
        unique = keep_first(df.repartition(bucket_count(df.sparkSession, splits.total), METER), few_copies=True)
    filled = fill_missing(unique, columns, splits)
    return flag_outliers(repair_ranges(filled, mode=mode), columns)


def clean_report(raw: DataFrame, cleaned: DataFrame, deduplicated: DataFrame) -> DataFrame:
    """One row: rows before and after, true duplicates, anomalies."""
    counts = [
        raw.agg(F.count(F.lit(1)).alias("initial_rows")),
        deduplicated.agg(F.count(F.lit(1)).alias("_unique")),
        cleaned.agg(
            F.count(F.lit(1)).alias("final_rows"),
            F.count_if("is_anomaly").alias("anomaly_flags_count"),
        ),
    ]
    row = with_scalars(with_scalars(counts[0], counts[1]), counts[2])
    return row.select(
        "initial_rows",
        "final_rows",
        (F.col("initial_rows") - F.col("final_rows")).alias("rows_removed"),
        (F.col("initial_rows") - F.col("_unique")).alias("duplicate_rows_removed"),
        "anomaly_flags_count",
        rounded(
            F.try_divide(F.col("anomaly_flags_count") * 100.0, F.col("final_rows")), 6
        ).alias("anomaly_flags_percentage"),
    )


# --- simple variant: impute, drop full duplicates, flag -----------------------


def column_modes(df: DataFrame, columns) -> DataFrame:
    """One row with the most frequent value of each column; smallest on ties."""
    columns = list(columns)
    counted = (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], columns, "column_name", "_v")
        .filter(F.col("_v").isNotNull())
        .groupBy("column_name", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    best = [
        F.min(
            F.when(F.col("column_name") == c, F.struct(-F.col("_n"), F.col("_v").alias("v")))
        )["v"].alias(f"{c}_mode")
        for c in columns
    ]
    return counted.agg(*best)


def impute(df: DataFrame) -> DataFrame:
    """Median for numbers, most frequent value for text."""
    numbers = numeric_columns(df)
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    out = with_scalars(df, wide_quantiles(df, numbers, [0.5]))
    fixes = {c: F.coalesce(F.col(c), F.col(f"{c}_q50")) for c in numbers}
    if texts:
        out = with_scalars(out, column_modes(df, texts))
        fixes |= {c: F.coalesce(F.col(c), F.col(f"{c}_mode"), F.lit("Unknown")) for c in texts}
    return out.withColumns(fixes).select(*df.columns)


def simple_clean(df: DataFrame) -> DataFrame:
    """Impute, keep distinct rows, flag quartile outliers as ``is_outlier``."""
    unique = stage(drop_full_duplicates(impute(df)), "unique")
    return flag_outliers(unique, numeric_columns(unique), "is_outlier")


def simple_clean_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    def nulls(df):
        total = F.lit(0)
        for c in df.columns:
            if c not in (SEQ, "is_outlier"):
                total = total + F.count_if(F.col(c).isNull())
        return total

    a = raw.agg(F.count(F.lit(1)).alias("original_records"), nulls(raw).alias("original_nulls"))
    b = cleaned.agg(
        F.count(F.lit(1)).alias("cleaned_records"),
        nulls(cleaned).alias("final_nulls"),
        F.count_if("is_outlier").alias("outliers_flagged"),
    )
    removed = F.col("original_records") - F.col("cleaned_records")
    return with_scalars(a, b).select(
        "original_records",
        "cleaned_records",
        removed.alias("records_removed"),
        rounded(removed * 100.0 / F.col("original_records"), 2).alias("removal_percentage"),
        "original_nulls",
        "final_nulls",
        removed.alias("duplicates_removed"),
        "outliers_flagged",
        rounded(F.col("cleaned_records") * 100.0 / F.col("original_records"), 2).alias(
            "data_quality_score"
        ),
    )


def loose_range_report(df: DataFrame, ranges=None) -> DataFrame:
    """Readings outside the wide plausibility ranges, per column."""
    ranges = ranges or config.LOOSE_RANGES
    row = df.agg(*[F.count_if(out_of_range(c, lo, hi)).alias(c) for c, (lo, hi) in ranges.items()])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("row_count")) for c in ranges]
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")
