"""Derived columns: calendar, electrical, rolling, bucket and group features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions import calendar, electrical
from meterlake.functions.exact import exact_over, exact_sum
from meterlake.operators.clean import METER, TIME, flag_outliers, time_order
from meterlake.plans import ordered
from meterlake.plans.joins import attach_to_rows, scalar_row, with_group
from meterlake.plans.quantiles import wide_quantiles
from meterlake.plans.splits import Splits, measure
from meterlake.plans.staging import stage

POWER, ZONE = "Active_Power_kW", "Zone_ID"
ROLLING_COLUMNS = ("Active_Power_kW", "Current_A", "Reactive_Power_kW")


def temporal(df: DataFrame) -> DataFrame:
    ts = F.col(TIME)
    parts = {
        "hour": F.hour(ts),
        "day_of_week": calendar.weekday_monday0(ts),
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
        "quarter": F.quarter(ts),
        "year": F.year(ts),
        "week_of_year": F.weekofyear(ts),
        "day_name": calendar.day_name(ts),
    }
    waves = {}
    for prefix, source, period in (("hour", "hour", 24), ("month", "month", 12), ("dow", "day_of_week", 7)):
        waves[f"{prefix}_sin"], waves[f"{prefix}_cos"] = calendar.cyclic(parts[source], period)
    return df.withColumns(parts | waves)


def season(df: DataFrame, preset: str = "monsoon") -> DataFrame:
    return df.withColumn("season", calendar.season("month", preset))


def peak_flag(df: DataFrame, preset: str = "standard") -> DataFrame:
    return df.withColumn("peak_hour_flag", calendar.is_peak("hour", preset).cast("int"))


def power_factor(df: DataFrame, clipped: bool = True) -> DataFrame:
    return df.withColumn("power_factor", electrical.power_factor(clipped=clipped))


def load_category(df: DataFrame, bands=config.LOAD_BANDS) -> DataFrame:
    return df.withColumn("load_category", electrical.banded(POWER, bands))


def rolling(
    df: DataFrame,
    rows: int = config.ROLLING_ROWS,
    columns=ROLLING_COLUMNS,
    splits: Splits | None = None,
    unit: str = "rows",
) -> DataFrame:
    """Rolling mean, sample deviation and distance from the mean, per meter.

    The usual window is a number of readings, although its name says hours;
    ``unit='hours'`` takes it as a span of time.
    """
    columns = [c for c in columns if c in df.columns]
    splits = splits or measure(df, [METER], TIME)
    if unit == "hours":
        names = {c: (f"{c}_rolling_mean_{rows}h", f"{c}_rolling_std_{rows}h") for c in columns}
        out = ordered.sliding(df, [METER], TIME, names, rows - 1, splits)
    else:
        exprs = {}
        for c in columns:
            exprs[f"{c}_rolling_mean_{rows}h"] = (
                lambda w, c=c: F.avg(c).over(w.rowsBetween(1 - rows, 0))
            )
            exprs[f"{c}_rolling_std_{rows}h"] = (
                lambda w, c=c: F.stddev_samp(c).over(w.rowsBetween(1 - rows, 0))
            )
        out = ordered.frames(df, [METER], time_order(df), exprs, splits, before=rows - 1)
    return out.withColumns(
        {
            f"{c}_delta_from_mean_{rows}h": F.col(c) - F.col(f"{c}_rolling_mean_{rows}h")
            for c in columns
        }
    )


def consumption_bucket(df: DataFrame, labels=config.QUARTILE_BUCKETS) -> DataFrame:
    return consumption_bucket_of(df, df, labels)


def consumption_bucket_of(
    df: DataFrame, source: DataFrame, labels=config.QUARTILE_BUCKETS
) -> DataFrame:
    """Quartile of the power value, right-closed, the lowest value included.

    Quartiles are those of ``source``, which holds the same readings as ``df`` but
    may be cheaper to read.

    Four labels need five different edges; otherwise this raises rather than
    giving labels that mean nothing.
    """
    marks = scalar_row(wide_quantiles(source, [POWER], [0.0, 0.25, 0.5, 0.75, 1.0]))
    edges = [marks[f"{POWER}_q{p:02d}"] for p in (0, 25, 50, 75, 100)]
    if edges[0] is not None and len(set(edges)) < 5:
        raise ValueError(f"quartile edges repeat, four buckets cannot be formed: {edges}")
    label = electrical.right_closed(POWER, [F.lit(e) for e in edges[:4]] + [None], labels, True)
    return df.withColumn("consumption_bucket", label)


def _fold(df: DataFrame, key: str, part: str, total: str, mean: str) -> tuple[DataFrame, DataFrame]:
    """Totals per (key, part), and the mean per key folded from them.

    They stay two tables: a row without a time has no total but still its key's mean.
    """
    grain = df.groupBy(key, part).agg(
        F.coalesce(exact_sum(POWER), F.lit(0.0)).alias("_sum"), F.count(POWER).alias("_n")
    )
    grain = stage(grain, "grain")
    whole = grain.groupBy(key).agg(F.try_divide(exact_sum("_sum"), F.sum("_n")).alias(mean))
    return grain.select(key, part, F.col("_sum").alias(total)), whole


def group_features(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Meter-day and zone-hour totals, meter and zone means, on every reading.

    Meter figures are windows over the meter, as for the rolling features, unless
    a meter is too large for that.  Zones always are: rows join their totals by
    (zone, hour) and their means by zone, and those of large meters by (meter, day) and
    meter.  Such groups are small even if one zone or meter holds much.  A reading
    without a time has no total of its day or hour, and the mean of its meter and zone.
    """
    splits = splits or measure(df, [METER], TIME)
    work = df.withColumn("_day", F.to_date(TIME)).withColumn("_hour", calendar.trunc("hour", TIME))
    hourly, zone_means = _fold(work, ZONE, "_hour", "zone_hourly_consumption_kWh", "zone_avg_power_kW")
    if splits.any:
        daily, means = _fold(work, METER, "_day", "meter_daily_consumption_kWh", "meter_avg_power_kW")
        out = attach_to_rows(with_group(work, daily, [METER, "_day"]), means, [METER])
    else:
        day, meter = Window.partitionBy(METER, "_day"), Window.partitionBy(METER)
        daily = F.coalesce(exact_over(POWER, day), F.lit(0.0))
        mean = F.try_divide(exact_over(POWER, meter), F.count(POWER).over(meter))
        known = F.col(METER).isNotNull()
        out = work.withColumns(
            {
                "meter_daily_consumption_kWh": F.when(known & F.col("_day").isNotNull(), daily),
                "meter_avg_power_kW": F.when(known, mean),
            }
        )
    out = attach_to_rows(with_group(out, hourly, [ZONE, "_hour"]), zone_means, [ZONE])
    return out.select(
        *df.columns,
        "meter_daily_consumption_kWh",
        "zone_hourly_consumption_kWh",
        "meter_avg_power_kW",
        "zone_avg_power_kW",
    )


def feature_table(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    """All features of a cleaned readings table.

    Windows come first, over the narrow readings; the columns that only need the
    row itself are added after them and never sorted or buffered.
    """
    splits = splits or measure(df, [METER], TIME)
    out = group_features(rolling(df, splits=splits), splits)
    out = load_category(power_factor(peak_flag(season(temporal(out)))))
    return consumption_bucket_of(out, df)


def feature_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row per created column with its type."""
    rows = [(n, t) for n, t in after.dtypes if n not in before.columns]
    return after.sparkSession.createDataFrame(rows, "feature string, data_type string")


# --- extra features of the exploratory set ------------------------------------


def exploratory_features(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Weekend flag, rating and quartile load, v-only anomaly, 24/168-row means, changes."""
    out = temporal(df).withColumns(
        {
            "day": F.dayofmonth(TIME),
            "day_of_year": F.dayofyear(TIME),
            "is_weekend": (calendar.weekday_monday0(TIME) >= 5).cast("int"),
        }
    )
    out = power_factor(peak_flag(season(out, "temperate"), "morning_evening"), clipped=False)
    out = out.withColumn(
        "power_factor_category", electrical.rated("power_factor", config.READING_PF_RATING)
    )
    out = quartile_load(out)
    out = flag_outliers(out, [POWER]).withColumn("is_anomaly", F.col("is_anomaly").cast("int"))
    return consumption_change(rolling_means(out, splits=splits), splits=splits)


def quartile_load(df: DataFrame, labels=config.QUARTILE_LOADS) -> DataFrame:
    """Right-closed bins at 0 and the quartiles; zero and below get no label."""
    q = scalar_row(wide_quantiles(df, [POWER], [0.25, 0.5, 0.75]))
    edges = [F.lit(0.0), *[F.lit(q[f"{POWER}_q{p}"]) for p in (25, 50, 75)], None]
    return df.withColumn("load_category", electrical.right_closed(POWER, edges, labels))


def rolling_means(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    splits = splits or measure(df, [METER], TIME)
    exprs = {
        "power_rolling_24h": lambda w: F.avg(POWER).over(w.rowsBetween(-23, 0)),
        "power_rolling_7d": lambda w: F.avg(POWER).over(w.rowsBetween(-167, 0)),
    }
    return ordered.frames(df, [METER], time_order(df), exprs, splits, before=167)


def consumption_change(df: DataFrame, splits: Splits | None = None) -> DataFrame:
    """Difference to the previous reading, and its percentage after forward fill."""
    splits = splits or measure(df, [METER], TIME)
    order = time_order(df)
    filled = ordered.fill(
        df.withColumn("_p", F.col(POWER)), [METER], order, ["_p"], splits, backward=False
    )
    exprs = {
        "_prev": lambda w: F.lag(POWER).over(w),
        "_prev_p": lambda w: F.lag("_p").over(w),
    }
    out = ordered.frames(filled, [METER], order, exprs, splits, before=1)
    return out.withColumns(
        {
            "consumption_change": F.col(POWER) - F.col("_prev"),
            "consumption_change_pct": (F.try_divide(F.col("_p"), F.col("_prev_p")) - 1) * 100,
        }
    ).drop("_p", "_prev", "_prev_p")

