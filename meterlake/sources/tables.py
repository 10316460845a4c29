"""Sinks: Parquet, CSV, JSON, tables and external databases."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.operators.clean import TIME

# How a table that exists is treated -> Spark write mode.
IF_EXISTS = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def save_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", by_date: bool = True, compression="snappy"
) -> None:
    """Parquet, in folders by reading date so that date filters read only theirs.

    Rows are brought together by date first, or every task would write a file
    into every date.  The rebalance hint lets adaptive execution split a date
    that is much larger than the others and merge small ones.
    """
    if not (by_date and TIME in df.columns):
        df.write.mode(mode).option("compression", compression).parquet(path)
        return
    dated = df.withColumn("reading_date", F.to_date(TIME)).hint("rebalance", "reading_date")
    dated.write.mode(mode).option("compression", compression).partitionBy("reading_date").parquet(path)


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for sinks that hold plain values only."""
    nested = [c for c, t in df.dtypes if t.startswith(("struct", "array", "map"))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


def save_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    flat(df).write.mode(mode).option("header", True).csv(path)


def save_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def save_table(df: DataFrame, table: str, if_exists: str = "replace") -> None:
    if if_exists not in IF_EXISTS:
        raise ValueError(f"if_exists must be one of {sorted(IF_EXISTS)}")
    df.write.mode(IF_EXISTS[if_exists]).saveAsTable(table)


def save_jdbc(df: DataFrame, url: str, table: str, if_exists: str = "append", **options) -> None:
    """Write to an external database; its driver must be on the class path."""
    writer = df.write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.mode(IF_EXISTS[if_exists]).save()


def save_csv_and_parquet(df: DataFrame, csv_path: str, parquet_path: str) -> None:
    """Both formats from one computation."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        save_csv(kept, csv_path)
        save_parquet(kept, parquet_path, by_date=False)
    finally:
        kept.unpersist()
