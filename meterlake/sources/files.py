"""File sources: explicit schemas, name checks, best-effort types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import config
from meterlake.functions.calendar import parse_timestamp
from meterlake.operators import quality
from meterlake.schema import ANALYTICS_COLUMNS, EXPECTED_COLUMNS, MEASURES, READINGS, RENAMES, require

CORRUPT = "_corrupt_record"


def strip_names(df: DataFrame) -> DataFrame:
    """Blanks around column names removed, other spellings renamed to the canonical one."""
    names = [c.strip() for c in df.columns]
    return df.toDF(*[RENAMES.get(c, c) for c in names])


def read_text_columns(
    spark: SparkSession, path, encoding: str = "UTF-8", corrupt: bool = False
) -> DataFrame:
    """A CSV with header, every column as text, names stripped.

    The names come from the header line alone; no pass over the data infers types.
    """
    base = spark.read.option("header", True).option("encoding", encoding)
    names = base.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if corrupt:
        schema = schema.add(CORRUPT, T.StringType())
        base = base.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return strip_names(base.schema(schema).csv(path))


def load_raw_csv(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """A raw readings CSV; missing columns raise, extra ones are kept."""
    return require(read_text_columns(spark, path, encoding), EXPECTED_COLUMNS)


def load_csv(spark: SparkSession, path, schema: T.StructType = READINGS) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def enforce_types(df: DataFrame) -> DataFrame:
    """Canonical types: cells that do not convert become NULL, and so does NaN.

    NaN compares greater than any number in Spark, so it would break range checks.
    """
    out = {}
    for f in READINGS.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            is_text = isinstance(df.schema[f.name].dataType, T.StringType)
            out[f.name] = parse_timestamp(c) if is_text else c.cast(f.dataType)
        elif isinstance(f.dataType, T.DoubleType):
            number = c.try_cast("double")
            out[f.name] = F.when(~F.isnan(number), number)
        else:
            out[f.name] = c.cast(f.dataType)
    return df.withColumns(out)


def conversion_failures(before: DataFrame) -> DataFrame:
    """Per column: cells that had text but no usable value."""
    after = enforce_types(before.withColumns({f"_raw_{c}": F.col(c) for c in EXPECTED_COLUMNS}))
    cells = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count_if(F.col(f"_raw_{c}").isNotNull() & F.col(c).isNull()).alias("failed"),
        )
        for c in EXPECTED_COLUMNS
    ]
    return after.agg(F.array(*cells).alias("a")).select(F.explode("a").alias("r")).select("r.*")


def ingest(
    spark: SparkSession, path, encoding: str = "UTF-8", with_ordinal: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Load, strip names, parse times, enforce types; with a one-row quality report.

    The ordinal follows file name and position, so keep-first means the same rows
    every time the same files are read.
    """
    raw = load_raw_csv(spark, path, encoding)
    if with_ordinal:
        raw = with_file_ordinal(raw)
    typed = enforce_types(raw)
    return typed, quality.quality_report(typed)


def with_file_ordinal(df: DataFrame) -> DataFrame:
    """``_seq`` as one string that sorts by file, block and place in the block."""
    row = F.monotonically_increasing_id() % F.lit(1 << 33)
    place = F.concat_ws(
        "\t",
        F.col("_metadata.file_path"),
        F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"),
        F.lpad(row.cast("string"), 10, "0"),
    )
    return df.withColumn("_seq", place)


def analytics_projection(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in ANALYTICS_COLUMNS if c in df.columns])


def sample(df: DataFrame, fraction: float, seed: int = config.SAMPLE_SEED) -> DataFrame:
    """About the given share of the rows by a hash of their key and the seed; all at one or more.

    The same rows are picked however the table is partitioned.  The key is ``_seq`` where there
    is one, else meter and time.
    """
    if fraction >= 1.0:
        return df
    key = ["_seq"] if "_seq" in df.columns else [c for c in ("Meter_ID", "Timestamp") if c in df.columns]
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    bound = f"{round(fraction * 16**8):08x}"
    return df.filter(F.substring(F.md5(text), 1, 8) < bound)


def measures_of(df: DataFrame) -> list[str]:
    return [c for c in MEASURES if c in df.columns]
