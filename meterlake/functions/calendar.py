"""Calendar expressions on zone-less timestamps."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions.exact import _col


def trunc(unit: str, ts) -> Column:
    """date_trunc that stays zone-less."""
    return F.date_trunc(unit, _col(ts)).cast("timestamp_ntz")


def hour(ts) -> Column:
    return F.hour(_col(ts))


def day(ts) -> Column:
    return F.to_date(_col(ts))


def weekday_monday0(ts) -> Column:
    return F.weekday(_col(ts))


def weekday_sunday0(ts) -> Column:
    return F.dayofweek(_col(ts)) - 1


def day_name(ts) -> Column:
    return F.date_format(_col(ts), "EEEE")


def month_name(month) -> Column:
    return F.date_format(F.make_date(F.lit(2000), _col(month), F.lit(1)), "MMM")


def quarter_label(ts) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_col(ts)))


def cyclic(c, period: int) -> tuple[Column, Column]:
    angle = 2 * math.pi * _col(c) / period
    return F.sin(angle), F.cos(angle)


def season(month, preset: str | dict = "monsoon") -> Column:
    table = config.SEASONS[preset] if isinstance(preset, str) else preset
    out = None
    for name, months in table.items():
        hit = _col(month).isin(*months)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("Unknown")


def is_peak(hour_col, preset: str | tuple = "standard") -> Column:
    hours = config.PEAK_HOURS[preset] if isinstance(preset, str) else preset
    return _col(hour_col).isin(*hours)


def parse_timestamp(text, formats=config.TIMESTAMP_FORMATS) -> Column:
    """First pattern that fits, then Spark's own parser, else NULL."""
    s = F.trim(_col(text))
    tries = [F.try_to_timestamp(s, F.lit(f)) for f in formats]
    return F.coalesce(*tries, F.try_to_timestamp(s)).cast("timestamp_ntz")
