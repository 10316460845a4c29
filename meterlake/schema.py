"""Canonical readings schema and column names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MEASURES = (
    "Voltage_V",
    "Current_A",
    "Active_Power_kW",
    "Reactive_Power_kW",
    "Apparent_Power_kVA",
    "Frequency_Hz",
    "Sub_Meter_Kitchen",
    "Sub_Meter_HVAC",
    "Outdoor_Temp_C",
)
EXPECTED_COLUMNS = ("Timestamp", "Meter_ID", "Zone_ID", *MEASURES)

# Other spellings that inputs use for the same column.
RENAMES = {"Zone": "Zone_ID", "Reactive_Power_kVAR": "Reactive_Power_kW"}

READINGS = T.StructType(
    [
        T.StructField("Timestamp", T.TimestampNTZType()),
        T.StructField("Meter_ID", T.StringType()),
        T.StructField("Zone_ID", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in MEASURES],
    ]
)

# A stream message carries the timestamp as text and the time it was sent.
MESSAGE = T.StructType(
    [
        T.StructField("Timestamp", T.StringType()),
        T.StructField("Meter_ID", T.StringType()),
        T.StructField("Zone_ID", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in MEASURES],
        T.StructField("ingestion_timestamp", T.StringType()),
    ]
)

# The analytics projection keeps these, where present.
ANALYTICS_COLUMNS = (
    "Timestamp",
    "Meter_ID",
    "Zone_ID",
    "Active_Power_kW",
    "Reactive_Power_kW",
    "Apparent_Power_kVA",
    "Voltage_V",
    "Current_A",
    "Frequency_Hz",
    "Outdoor_Temp_C",
    "hour",
    "day_of_week",
    "month",
    "season",
    "peak_hour_flag",
    "power_factor",
    "load_category",
    "consumption_bucket",
    "is_anomaly_raw",
)


class MissingColumns(ValueError):
    """Input lacks columns that the operator needs."""


def require(df: DataFrame, columns) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {missing}")
    return df


def numeric_columns(df: DataFrame, skip=("_seq",)) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
