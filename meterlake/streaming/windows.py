"""Event-time de-duplication, windowed consumption and quality counts on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions.exact import exact_avg, exact_sum, joined, lanes, out_of_range
from meterlake.operators.clean import METER, TIME

POWER, ZONE = "Active_Power_kW", "Zone_ID"


def event_time(df: DataFrame, delay: str) -> DataFrame:
    """Watermarked readings.  Watermarks need a zoned timestamp; the session is UTC."""
    return df.withColumn(TIME, F.col(TIME).cast("timestamp")).withWatermark(TIME, delay)


def deduplicate(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """First reading per meter and time; copies within the delay are dropped."""
    return event_time(df, delay).dropDuplicatesWithinWatermark([METER, TIME])


def _windowed(df: DataFrame, keys, size: str, slide: str | None, aggs) -> DataFrame:
    span = F.window(TIME, size, slide) if slide else F.window(TIME, size)
    return df.groupBy(span.alias("_w"), *keys).agg(*aggs)


def hourly_by_zone(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Tumbling hours per zone, with the columns of the batch aggregate."""
    timed = event_time(df.filter(F.col(ZONE).isNotNull()), delay)
    aggs = [
        F.coalesce(exact_sum(POWER), F.lit(0.0)).alias("Total_kWh"),
        exact_avg(POWER).alias("Avg_kW"),
        F.count(POWER).alias("Count"),
    ]
    out = _windowed(timed, [ZONE], "1 hour", None, aggs)
    return out.select(
        F.col("_w.start").cast("timestamp_ntz").alias("Hour"), ZONE, "Total_kWh", "Avg_kW", "Count"
    )


def daily_by_meter(df: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Tumbling days per meter, with the columns of the batch aggregate."""
    timed = event_time(df.filter(F.col(METER).isNotNull()), delay)
    aggs = [
        F.coalesce(exact_sum(POWER), F.lit(0.0)).alias("Total_kWh"),
        exact_avg(POWER).alias("Avg_kW"),
        F.min(POWER).alias("Min_kW"),
        F.max(POWER).alias("Max_kW"),
        F.count(POWER).alias("Count"),
    ]
    out = _windowed(timed, [METER], "1 day", None, aggs)
    return out.select(
        F.col("_w.start").cast("date").alias("Date"), METER, "Total_kWh", "Avg_kW", "Min_kW",
        "Max_kW", "Count",
    )


def panes(df: DataFrame, delay: str = "1 hour", size: str = "1 hour") -> DataFrame:
    """Sums and counts of tumbling windows, from which longer windows are put together."""
    fixed, rest = lanes(POWER)
    aggs = [F.sum(fixed).alias("_fixed"), F.sum(rest).alias("_rest"), F.count(POWER).alias("_n")]
    return event_time(df, delay).groupBy(F.window(TIME, size).alias("_pane")).agg(*aggs)


def sliding_average(
    df: DataFrame, delay: str = "1 hour", size: str = "24 hours", slide: str = "1 hour"
) -> DataFrame:
    """Mean power over a span of time, moved on by ``slide``.

    Two aggregates in a row, in append mode: each reading enters one pane of length
    ``slide``, and the closed panes, not the readings, enter the windows they lie in.
    ``size`` is a multiple of ``slide``.  A span of time, not a number of rows, so it
    differs from the row-based mean.
    """
    span = F.window(F.window_time("_pane"), size, slide).alias("_w")
    out = panes(df, delay, slide).groupBy(span).agg(
        F.sum("_fixed").alias("_fixed"), F.sum("_rest").alias("_rest"), F.sum("_n").alias("_n")
    )
    mean = F.try_divide(joined(F.col("_fixed"), F.col("_rest")), F.col("_n"))
    return out.select(
        F.col("_w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("_w.end").cast("timestamp_ntz").alias("window_end"),
        mean.alias("avg_power_kw"),
    )


def range_flags(df: DataFrame, ranges=None) -> DataFrame:
    """How many measures of each reading are out of range or missing: stateless columns."""
    ranges = {c: r for c, r in (ranges or config.VALID_RANGES).items() if c in df.columns}
    bad, gone = F.lit(0), F.lit(0)
    for c, (lo, hi) in ranges.items():
        bad = bad + out_of_range(c, lo, hi).cast("int")
        gone = gone + F.col(c).isNull().cast("int")
    return df.withColumns({"out_of_range": bad, "missing": gone})


def quality_sink(df: DataFrame, path: str, checkpoint: str, every: str | None = None):
    """One row of quality counts per micro-batch; a repeated batch replaces its row."""

    def write(batch: DataFrame, number: int) -> None:
        counts = range_flags(batch).agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("out_of_range") > 0).alias("out_of_range_rows"),
            F.count_if(F.col("missing") > 0).alias("incomplete_rows"),
        )
        counts.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
