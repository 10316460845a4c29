"""Joins of rows with small statistics and with per-group aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.plans.splits import null_safe
from meterlake.plans.staging import stage


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach an ungrouped aggregate.  It is one row by construction."""
    return df.crossJoin(F.broadcast(one_row))


def scalar_row(one_row: DataFrame) -> dict:
    """An ungrouped aggregate as plain values, for statistics that later steps reuse.

    One row reaches the driver.  As literals the values cost later plans nothing,
    while a joined aggregate would be computed again by every step that reads on.
    """
    return one_row.first().asDict()


def with_group(df: DataFrame, grouped: DataFrame, keys, null_keys: bool = False) -> DataFrame:
    """Attach an aggregate to the rows it came from.

    No broadcast hint: the aggregate grows with the number of groups, so its
    measured size decides.  When it is shuffled, a hot key sits on the row side
    only and has one match, which is the case adaptive skew-join splitting
    handles.
    """
    keys = list(keys)
    if not null_keys:
        return df.join(grouped, keys, "left")
    names = [f"_g{i}" for i in range(len(keys))]
    right = grouped
    for k, n in zip(keys, names):
        right = right.withColumnRenamed(k, n)
    return df.join(right, null_safe(df, right, zip(keys, names)), "left").drop(*names)


def attach_to_rows(df: DataFrame, grouped: DataFrame, keys, null_keys: bool = False) -> DataFrame:
    """Attach an aggregate to raw rows, staged first so that its size is known.

    From the size of the staged files the planner broadcasts a small aggregate and
    leaves the rows where they are.  Unstaged, its size is only known after both
    sides have been shuffled.  A large one is joined by shuffle as in ``with_group``.
    """
    return with_group(df, stage(grouped, "grouped"), keys, null_keys)
