"""Materialise a result that several later steps read.

Written as Parquet in the folder named by ``spark.checkpoint.dir``, so it lies in
shared storage, survives the loss of executors, and later steps read only the
columns they need.  With ``by``, the files are bucketed by those columns, and
later windows and joins on them need no shuffle.
"""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

_SETTING = "spark.checkpoint.dir"


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="meterlake-")


def staging_root(spark: SparkSession) -> str:
    root = spark.conf.get(_SETTING, None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_root()
    raise RuntimeError(f"set {_SETTING} to a folder that all executors can reach")


# Staged results of this process: path, and table name if there is one.
_staged: list[tuple[str, str | None]] = []


#: Rows of a bucket of a staged table, about; and buckets at most, which bounds the files.
BUCKET_ROWS, MOST_BUCKETS = 2_000_000, 20_000


def bucket_count(spark: SparkSession, rows: int | None) -> int:
    """Buckets for a table of so many rows: at least the session's partitions, and more as it grows."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(MOST_BUCKETS, -(-(rows or 0) // BUCKET_ROWS)))


def stage(df: DataFrame, name: str, by: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """Store and read back.  ``rows``, if known, sets the number of buckets."""
    spark = df.sparkSession
    key = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{staging_root(spark)}/meterlake/{key}"
    writer = df.write.option("compression", "snappy").format("parquet")
    if not by:
        writer.save(path)
        _staged.append((path, None))
        return spark.read.schema(df.schema).parquet(path)
    # One file per bucket where the rows are already hashed by the same columns into as many parts.
    buckets = bucket_count(spark, rows)
    table = f"staged_{key}"
    writer.bucketBy(buckets, *by).option("path", path).saveAsTable(table)
    _staged.append((path, table))
    return spark.table(table)


def stage_observed(df: DataFrame, name: str, metrics: list, by: list[str] | None = None, rows: int | None = None):
    """Stage, and return aggregates observed while writing: they need no further scan."""
    seen = Observation()
    staged = stage(df.observe(seen, *metrics), name, by, rows)
    return staged, seen.get


def release(spark: SparkSession) -> int:
    """Drop everything staged by this process; results read from it must be stored by then."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    count = len(_staged)
    while _staged:
        path, table = _staged.pop()
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return count
