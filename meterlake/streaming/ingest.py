"""Message encoding and decoding, stream sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming import DataStreamWriter

from meterlake.functions.calendar import parse_timestamp
from meterlake.schema import MEASURES, MESSAGE

VALUE, BAD = "value", "_malformed"
_FIELDS = [f.name for f in MESSAGE.fields]


def encode(df: DataFrame) -> DataFrame:
    """Key and JSON value of each reading, keyed by meter, stamped with the sending time."""
    sent = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [
        F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"),
        "Meter_ID",
        "Zone_ID",
        *MEASURES,
        sent.alias("ingestion_timestamp"),
    ]
    return df.select(F.col("Meter_ID").alias("key"), F.to_json(F.struct(*fields)).alias(VALUE))


def parse(df: DataFrame, value: str = VALUE) -> DataFrame:
    """Message fields and whether the message was malformed.

    In permissive mode a truncated document still gives the fields read so far,
    so the corrupt-record field, not an empty result, tells that it is bad.
    """
    schema = T.StructType(MESSAGE.fields + [T.StructField("_corrupt", T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    text = F.col(value).cast("string")
    out = df.withColumn("_m", F.from_json(text, schema, options))
    bad = F.col("_m").isNull() | F.col("_m._corrupt").isNotNull() | F.col("_m.Meter_ID").isNull()
    fields = {}
    for name in _FIELDS:
        c = F.col(f"_m.{name}")
        if name in MEASURES:
            c = F.when(~F.isnan(c), c)
        fields[name] = c
    sent = fields["Timestamp"]
    fields["Timestamp"] = parse_timestamp(sent)
    bad = bad | (sent.isNotNull() & fields["Timestamp"].isNull())
    return out.select(
        text.alias(VALUE), bad.alias(BAD), *[c.alias(n) for n, c in fields.items()]
    )


def decode(df: DataFrame, value: str = VALUE) -> DataFrame:
    """Readings from messages; malformed ones are skipped."""
    return parse(df, value).filter(~F.col(BAD)).drop(VALUE, BAD)


# --- sources ------------------------------------------------------------------


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of a topic.  The query's checkpoint keeps the position."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load()


def file_source(
    spark: SparkSession,
    path: str,
    fmt: str = "text",
    schema: T.StructType | None = None,
    max_files: int | None = None,
    glob: str | None = None,
) -> DataFrame:
    """New files of a folder: text lines as ``value``, or csv/json/parquet with a schema."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


# --- sinks --------------------------------------------------------------------


def _triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """``every`` such as '5 seconds'; without it, all that is there, then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None):
    writer = (
        encode(df)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, every).start()


def file_sink(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None
):
    """Append to files; exactly once by the checkpoint."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    if fmt == "csv":
        writer = writer.option("header", True)
    return _triggered(writer.outputMode("append"), every).start()


def split_sink(
    messages: DataFrame,
    good_path: str,
    dead_path: str,
    checkpoint: str,
    every: str | None = None,
):
    """Readings to one folder, malformed messages to another.

    Every batch goes to a folder named by its number and replaces it, so a batch
    repeated after a failure does not appear twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            good = batch.filter(~F.col(BAD)).drop(VALUE, BAD)
            good.write.mode("overwrite").parquet(f"{good_path}/batch={number}")
            dead = batch.filter(BAD).select(VALUE)
            dead.write.mode("overwrite").parquet(f"{dead_path}/batch={number}")
        finally:
            batch.unpersist()

    writer = parse(messages).writeStream.foreachBatch(write)
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start()


class ProgressCounts(StreamingQueryListener):
    """Rows in and out of every query of a session, added up report by report.

    A query keeps only its latest reports, so they are counted as they come.  Register with
    ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self):
        self._totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event):  # noqa: N802 - names of the interface
        self._totals.setdefault(str(event.id), {"batches": 0, "rows_in": 0, "rows_out": 0})

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        counts = self._totals.setdefault(str(p.id), {"batches": 0, "rows_in": 0, "rows_out": 0})
        counts["batches"] += 1
        counts["rows_in"] += int(p.numInputRows)
        counts["rows_out"] += max(int(p.sink.numOutputRows), 0)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def of(self, query) -> dict[str, int]:
        return dict(self._totals.get(str(query.id), {"batches": 0, "rows_in": 0, "rows_out": 0}))


def counted_sink(df: DataFrame, path: str, counts: str, checkpoint: str, every: str | None = None):
    """Rows to ``path`` and their number to ``counts``, both in a folder named by the batch.

    The numbers are observed while the rows are written and lie beside them in storage, so they
    outlive the process.  A batch that is repeated after a failure replaces its rows and its numbers: nothing
    is lost or counted twice over any number of restarts.
    """

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        kept = batch.observe(seen, F.count(F.lit(1)).alias("rows"))
        kept.write.mode("overwrite").parquet(f"{path}/batch={number}")
        row = [(number, int(seen.get["rows"]))]
        spark = batch.sparkSession
        spark.createDataFrame(row, "batch_id long, rows long").coalesce(1).write.mode("overwrite").parquet(f"{counts}/batch={number}")

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, every).start()


def durable_counts(spark: SparkSession, counts: str) -> dict[str, int]:
    """Batches and rows of every run of a stream that wrote its numbers to ``counts``."""
    row = spark.read.schema("batch_id long, rows long").parquet(f"{counts}/batch=*").agg(
        F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )
    return row.first().asDict()
