"""Files, tables, the query catalogue and the batch run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from meterlake import batch_run
from meterlake.operators import quality
from meterlake.queries import catalog
from meterlake.schema import EXPECTED_COLUMNS, MissingColumns
from meterlake.sources import files, tables


@pytest.fixture(scope="module")
def csv(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "readings")
    df = fixtures.readings_dup(spark, sf_dir).drop("_seq")
    renamed = df.toDF(*[f" {c}" if c == "Meter_ID" else c for c in df.columns])
    renamed.withColumn("Timestamp", F.date_format("Timestamp", "yyyy-MM-dd HH:mm:ss")).coalesce(2).write.option(
        "header", True
    ).option("ignoreLeadingWhiteSpace", False).csv(path)
    return path


def test_ingest(spark, csv, sf_dir):
    df, report = files.ingest(spark, csv)
    assert set(EXPECTED_COLUMNS) < set(df.columns) and "_seq" in df.columns
    assert dict(df.dtypes)["Timestamp"] == "timestamp_ntz"
    row = report.first()
    assert row.total_rows == fixtures.readings_dup(spark, sf_dir).count()
    assert row.duplicate_rows > 0


def test_missing_column_raises(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("Timestamp,Meter_ID\n2024-01-01,a\n")
    with pytest.raises(MissingColumns):
        files.load_raw_csv(spark, str(path))


def test_bad_cells_become_null_and_are_counted(spark, tmp_path):
    path = tmp_path / "x.csv"
    numbers = ",".join(["NaN", "abc"] + ["1"] * 7)
    path.write_text(",".join(EXPECTED_COLUMNS) + f"\nnot a time,a,z,{numbers}\n")
    raw = files.load_raw_csv(spark, str(path))
    row = files.enforce_types(raw).first()
    assert row.Timestamp is None and row.Voltage_V is None and row.Current_A is None
    bad = {r.column_name: r.failed for r in files.conversion_failures(raw).collect() if r.failed}
    assert bad == {"Timestamp": 1, "Voltage_V": 1, "Current_A": 1}


def test_rename_map(spark):
    df = spark.createDataFrame([("z", 1.0)], " `Zone ` string, Reactive_Power_kVAR double")
    assert files.strip_names(df).columns == ["Zone_ID", "Reactive_Power_kW"]


def test_parquet_by_date_prunes(spark, sf_dir, tmp_path):
    path = str(tmp_path / "p")
    df = fixtures.readings(spark, sf_dir)
    tables.save_parquet(df, path)
    back = spark.read.parquet(path)
    assert back.count() == df.count()
    plan = back.filter("reading_date = date'2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reading_date" in plan


def test_tables_csv_json(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    with pytest.raises(ValueError):
        tables.save_table(df, "t_x", "other")
    tables.save_table(df, "t_x", "replace")
    tables.save_table(df, "t_x", "append")
    assert spark.table("t_x").count() == 2
    spark.sql("drop table t_x")
    tables.save_csv_and_parquet(df, str(tmp_path / "c"), str(tmp_path / "q"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 1
    tables.save_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 1


def test_sample(spark):
    df = spark.range(1000)
    assert files.sample(df, 1.0) is df
    assert files.sample(df, 0.1).collect() == files.sample(df, 0.1).collect()


def test_catalog_metrics_and_errors(spark, sf_dir, tmp_path):
    df = fixtures.readings(spark, sf_dir)

    def broken(_):
        raise RuntimeError("no")

    queries = {
        "zones": catalog.STANDARD["zone_analysis"],
        "none": lambda d: d.filter("false"),
        "broken": broken,
    }
    rows = {r.name: r for r in catalog.run(df, str(tmp_path), queries=queries).collect()}
    assert rows["zones"].status == "SUCCESS" and rows["zones"].row_count == 4
    assert rows["none"].status == "EMPTY" and rows["broken"].status == "ERROR"
    assert "RuntimeError" in rows["broken"].notes
    assert catalog.load_result(spark, str(tmp_path), "zones").count() == 4
    with pytest.raises(catalog.CatalogError):
        catalog.select(["nope"])


def test_batch_run(spark, csv, tmp_path):
    out = str(tmp_path / "out")
    with pytest.raises(quality.ValidationFailed):
        batch_run.run(spark, csv, str(tmp_path / "strict"), as_of=dt.datetime(2024, 1, 2))
    metrics = {r.stage: r for r in batch_run.run(spark, csv, out, "clip_always", strict=False).collect()}
    assert metrics["analysis"].status == "success", metrics["analysis"].notes
    assert metrics["cleaning"].rows_input > metrics["cleaning"].rows_output > 0
    queries = spark.read.parquet(f"{out}/query_metrics")
    assert queries.count() == 72 and queries.filter("status = 'ERROR'").count() == 0
    for name in ("reports/ingestion", "reports/cleaning", "reports/features", "star/fact_energy_reading", "star/dq_quality_log"):
        assert spark.read.parquet(f"{out}/{name}").count() > 0, name
    assert spark.read.option("header", True).csv(f"{out}/csv/cleaned").count() == metrics["cleaning"].rows_output
    assert spark.read.parquet(f"{out}/analytics").count() == metrics["cleaning"].rows_output


def test_ingested_readings_as_csv(spark, csv, tmp_path):
    df, _ = files.ingest(spark, csv)
    tables.save_csv(df, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == df.count()
    assert dict(df.dtypes)["_seq"] == "string" and df.select("_seq").distinct().count() == df.count()


def test_sample_does_not_depend_on_partitions(spark, sf_dir):
    df = fixtures.readings(spark, sf_dir)
    once = {r[0] for r in files.sample(df, 0.2).select("_seq").collect()}
    assert once == {r[0] for r in files.sample(df.repartition(7), 0.2).select("_seq").collect()}
    assert 0.1 < len(once) / df.count() < 0.3
