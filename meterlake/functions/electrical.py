"""Electrical and load expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions.exact import _col, clip, safe_divide


def power_factor(active="Active_Power_kW", apparent="Apparent_Power_kVA", clipped=True) -> Column:
    pf = safe_divide(active, apparent)
    return clip(pf, 0, 1) if clipped else pf


def apparent_power(active="Active_Power_kW", reactive="Reactive_Power_kW") -> Column:
    p, q = _col(active), _col(reactive)
    return F.sqrt(p * p + q * q)


def apparent_mismatch(
    active="Active_Power_kW",
    reactive="Reactive_Power_kW",
    apparent="Apparent_Power_kVA",
    tolerance: float = config.APPARENT_POWER_TOLERANCE,
) -> Column:
    return F.abs(_col(apparent) - apparent_power(active, reactive)) > tolerance


def dead_voltage(voltage="Voltage_V", current="Current_A") -> Column:
    return (_col(voltage) == 0) & (_col(current) > 0)


def banded(value, bands=config.LOAD_BANDS, fallback: str = "VeryHigh") -> Column:
    """Half-open bands; first match wins; anything else gets the fallback."""
    v, out = _col(value), None
    for label, low, high in bands:
        hit = v >= low if high is None else (v >= low) & (v < high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(fallback)


def rated(value, rating) -> Column:
    """Label of the first threshold reached; the last label takes the rest."""
    v, out = _col(value), None
    for floor_value, label in rating[:-1]:
        hit = v >= floor_value
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(rating[-1][1])


def right_closed(value, edges, labels, include_lowest: bool = False) -> Column:
    """Right-closed bins: (e0,e1], (e1,e2] ...; an edge of None is open above."""
    v, out = _col(value), None
    for i, label in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        hit = (v >= low) if include_lowest and i == 0 else (v > low)
        if high is not None:
            hit = hit & (v <= high)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out
