"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from meterlake.plans.staging import staging_root


def new_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def write(df: DataFrame, name: str) -> DataFrame:
    """Store ``df`` as Parquet and read it back: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete what ``write`` stored, once nothing reads it any more."""
    for df in tables:
        path = getattr(df, "_scratch_path", None)
        if path:
            spark = df.sparkSession
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
