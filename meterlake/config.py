"""Named presets: ranges, thresholds and the several definitions of each concept.

Everything here is a value that results depend on.  Operators take these as
parameters with the preset as default, so a caller can pass their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------

# Valid ranges, in the order in which repairs are applied.
VALID_RANGES: dict[str, tuple[float, float]] = {
    "Voltage_V": (190, 250),
    "Current_A": (0, 100),
    "Active_Power_kW": (0, 25),
    "Reactive_Power_kW": (0, 25),
    "Apparent_Power_kVA": (0, 40),
    "Frequency_Hz": (49.5, 50.5),
    "Outdoor_Temp_C": (-10, 50),
    "Sub_Meter_Kitchen": (0, 5),
    "Sub_Meter_HVAC": (0, 10),
}

# Looser ranges used when only reporting; None is an open end.
LOOSE_RANGES: dict[str, tuple[float | None, float | None]] = {
    "Voltage_V": (180, 270),
    "Frequency_Hz": (48, 52),
    "Active_Power_kW": (0, None),
}

# Columns where a negative or missing value drops the reading.
NON_NEGATIVE = (
    "Current_A",
    "Active_Power_kW",
    "Reactive_Power_kW",
    "Apparent_Power_kVA",
    "Sub_Meter_Kitchen",
    "Sub_Meter_HVAC",
)

PEAK_HOURS: dict[str, tuple[int, ...]] = {
    "standard": tuple(range(10, 22)),
    "extended": tuple(range(10, 23)),
    "morning_evening": (6, 7, 8, 9, 18, 19, 20, 21),
}

SEASONS: dict[str, dict[str, tuple[int, ...]]] = {
    "monsoon": {
        "Winter": (12, 1, 2),
        "Summer": (3, 4, 5),
        "Monsoon": (6, 7, 8, 9),
        "Post-Monsoon": (10, 11),
    },
    "temperate": {
        "Winter": (12, 1, 2),
        "Spring": (3, 4, 5),
        "Summer": (6, 7, 8),
        "Autumn": (9, 10, 11),
    },
}

# Half-open load bands in kW; the last one is open above.
LOAD_BANDS: tuple[tuple[str, float, float | None], ...] = (
    ("Low", 0.0, 1.0),
    ("Medium", 1.0, 3.0),
    ("High", 3.0, 10.0),
    ("VeryHigh", 10.0, None),
)

# Load profile dimension: category, lower and upper kW, description.
LOAD_PROFILES: tuple[tuple[str, float, float, str], ...] = (
    ("Low", 0.0, 1.0, "standby and a few small loads"),
    ("Medium", 1.0, 3.0, "everyday use of a household"),
    ("High", 3.0, 10.0, "large loads such as heating or cooking"),
    ("VeryHigh", 10.0, 25.0, "several large loads at once"),
)

QUARTILE_BUCKETS = ("Q1_Low", "Q2_Medium", "Q3_High", "Q4_VeryHigh")
QUARTILE_LOADS = ("Low", "Medium", "High", "Critical")

# Power-factor ratings: (lowest value, label), first match wins.
READING_PF_RATING = ((0.95, "Excellent"), (0.85, "Good"), (0.70, "Fair"), (None, "Poor"))
METER_PF_RATING = ((0.95, "Excellent"), (0.85, "Good"), (0.75, "Average"), (None, "Poor"))
EFFICIENCY_RATING = (
    (80.0, "Excellent"),
    (60.0, "Good"),
    (40.0, "Fair"),
    (None, "Needs Improvement"),
)

# Timestamp patterns in the order in which they are tried.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "dd-MM-yyyy HH:mm:ss",
    "dd/MM/yyyy HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
)

IQR_MULTIPLIER = 1.5
Z_THRESHOLD = 3.0
APPARENT_POWER_TOLERANCE = 0.1
ROLLING_ROWS = 24
EXPECTED_GAP_MINUTES = 15
SAMPLE_SEED = 42


@dataclass(frozen=True)
class QualityThresholds:
    """Largest accepted percentages."""

    nulls: float = 5.0
    duplicates: float = 1.0
    anomalies: float = 10.0


@dataclass(frozen=True)
class SplitPolicy:
    """When a group is too large for one task, and into how many slices it goes.

    A group is *hot* above ``max(min_rows, total / max_groups)`` rows, so there
    are at most ``max_groups`` hot groups and about twice as many slices at any
    data size.  That is the bound behind every broadcast of split tables.
    """

    min_rows: int = 4_000_000
    max_groups: int = 32_768
    # No more than ``max_groups`` slices can be needed, so this bounds nothing by itself.
    max_slices: int = 32_768
    # Up to this many rows per group, a value map in one buffer is fine.
    map_rows: int = 1_000_000


QUALITY = QualityThresholds()
SPLIT = SplitPolicy()
