"""Stream results equal batch results on closed windows."""

import json
import os
import shutil
import time

import pytest
from pyspark.sql import functions as F

from checks import fixtures, registry
from meterlake.operators import star
from meterlake.queries import audit
from meterlake.schema import MESSAGE
from meterlake.streaming import gaps, ingest, windows

SENTINEL = {"Timestamp": "2031-01-01 00:00:00", "Meter_ID": "MTR-END", "Zone_ID": "ZEND"}


@pytest.fixture(scope="module")
def readings(spark, sf_dir):
    return fixtures.readings(spark, sf_dir).drop("_seq").cache()


@pytest.fixture(scope="module")
def payload(readings, tmp_path_factory):
    """Three overlapping files of messages, every 50th cut short, then a sentinel."""
    root = tmp_path_factory.mktemp("payload")
    values = [r.value for r in ingest.encode(readings.orderBy("Timestamp")).select("value").collect()]
    n, bad = len(values), 0
    parts = [values[: n // 2], values[n // 3 : 2 * n // 3], values[n // 2 :]]
    parts = [parts[0], [v for v in parts[1] if v not in set(parts[0])], values[2 * n // 3 :]]
    for i, part in enumerate(parts):
        lines = []
        for j, v in enumerate(part):
            lines.append(v)
            if j % 50 == 0:
                lines.append(v[: len(v) // 2])
                bad += 1
        (root / f"part-{i}.txt").write_text("\n".join(lines) + "\n")
    (root / "part-9.txt").write_text(json.dumps(SENTINEL) + "\n")
    in_order(root)
    return str(root), bad


def in_order(root):
    """File times that follow the names, since the source reads by file time."""
    for i, f in enumerate(sorted(root.iterdir())):
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))


def drain(query):
    query.awaitTermination(180)
    if query.exception():
        raise query.exception()


def run(spark, df, tmp_path, name, mode="append"):
    out = f"{name}_{abs(hash(str(tmp_path)))}"
    q = (
        df.writeStream.format("memory").queryName(out).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    drain(q)
    return spark.table(out)


def same(a, b):
    cols = sorted(b.columns)
    left, right = a.select(cols).collect(), b.select(cols).collect()
    assert sorted(map(repr, left)) == sorted(map(repr, right))


def decoded(spark, payload):
    lines = ingest.file_source(spark, payload[0], max_files=1)
    return ingest.decode(lines)


def test_decode_skips_malformed(spark, payload, readings, tmp_path):
    got = run(spark, decoded(spark, payload), tmp_path, "decoded").filter("Meter_ID <> 'MTR-END'")
    same(got.drop("ingestion_timestamp"), readings)


def test_round_trip_batch(readings):
    same(ingest.decode(ingest.encode(readings)).drop("ingestion_timestamp"), readings)


def test_split_sink_keeps_dead_letters(spark, payload, readings, tmp_path):
    good, dead = str(tmp_path / "good"), str(tmp_path / "dead")
    lines = ingest.file_source(spark, payload[0], max_files=2)
    totals = ingest.ProgressCounts()
    spark.streams.addListener(totals)
    q = ingest.split_sink(lines, good, dead, str(tmp_path / "cp"))
    drain(q)
    for _ in range(100):
        if totals.of(q)["rows_in"] >= readings.count() + 1 + payload[1]:
            break
        time.sleep(0.1)
    spark.streams.removeListener(totals)
    assert totals.of(q)["rows_in"] == readings.count() + 1 + payload[1]
    assert spark.read.parquet(dead).count() == payload[1]
    assert spark.read.parquet(good).count() == readings.count() + 1


def test_deduplicate(spark, readings, payload, tmp_path):
    twice = decoded(spark, payload)
    got = run(spark, windows.deduplicate(twice.union(twice), "40 days"), tmp_path, "dedup")
    assert got.filter("Meter_ID <> 'MTR-END'").count() == readings.count()


def test_hourly_by_zone_equals_batch(spark, readings, payload, tmp_path):
    got = run(spark, windows.hourly_by_zone(decoded(spark, payload), "40 days"), tmp_path, "hourly")
    same(got, star.hourly_by_zone(readings))


def test_daily_by_meter_equals_batch(spark, readings, payload, tmp_path):
    got = run(spark, windows.daily_by_meter(decoded(spark, payload), "40 days"), tmp_path, "daily")
    same(got, star.daily_by_meter(readings))


def test_late_rows_are_dropped(spark, readings, payload, tmp_path):
    """A reading that comes after the watermark has passed its hour changes nothing."""
    root = tmp_path / "late"
    shutil.copytree(payload[0], root)
    late = {"Timestamp": "2024-01-02 03:00:00", "Meter_ID": "MTR-1", "Zone_ID": "Z1", "Active_Power_kW": 9}
    # Lateness is judged by the watermark of the batch before, hence one more batch.
    (root / "part-98.txt").write_text(json.dumps(SENTINEL | {"Meter_ID": None}) + "\n")
    (root / "part-99.txt").write_text(json.dumps(late) + "\n")
    in_order(root)
    df = ingest.decode(ingest.file_source(spark, str(root), max_files=1))
    got = run(spark, windows.hourly_by_zone(df, "40 days"), tmp_path, "late")
    same(got, star.hourly_by_zone(readings))


def test_sliding_average(spark, readings, payload, tmp_path):
    got = run(spark, windows.sliding_average(decoded(spark, payload), "40 days"), tmp_path, "sliding")
    w = F.window(F.col("Timestamp").cast("timestamp"), "24 hours", "1 hour")
    want = readings.groupBy(w.alias("w")).agg(
        F.try_divide(
            F.sum(F.col("Active_Power_kW").cast("decimal(18,7)")).cast("double"),
            F.count("Active_Power_kW"),
        ).alias("avg_power_kw")
    )
    same(
        got,
        want.select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "avg_power_kw",
        ),
    )


def test_restart_from_checkpoint(spark, readings, payload, tmp_path):
    lines = lambda: ingest.decode(ingest.file_source(spark, payload[0], max_files=1))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    drain(ingest.file_sink(lines(), out, cp))
    drain(ingest.file_sink(lines(), out, cp))
    assert spark.read.parquet(out).count() == readings.count() + 1


def test_quality_sink(spark, readings, payload, tmp_path):
    path = str(tmp_path / "quality")
    drain(windows.quality_sink(decoded(spark, payload), path, str(tmp_path / "cp")))
    totals = spark.read.parquet(path).agg(F.sum("rows"), F.sum("out_of_range_rows")).first()
    flagged = windows.range_flags(readings).filter("out_of_range > 0").count()
    assert tuple(totals) == (readings.count() + 1, flagged)


def test_gap_alerts_equal_batch(spark, sf_dir, readings, payload, tmp_path):
    got = run(spark, gaps.gap_alerts(decoded(spark, payload)), tmp_path, "gaps", "append")
    fact = star.fact_table(registry.readings(spark, sf_dir))
    want = audit.reading_gaps(fact, star.dim_meter(registry.readings(spark, sf_dir)))
    same(
        got.filter("Meter_ID <> 'MTR-END'"),
        want.drop("meter_name").withColumnRenamed("meter_id", "Meter_ID"),
    )


def test_message_schema_names():
    assert MESSAGE.fieldNames()[-1] == "ingestion_timestamp"


@pytest.mark.parametrize("cut", [1, 2, 6])
def test_gaps_do_not_depend_on_batches(spark, tmp_path, cut):
    """Late readings and copies on borders, in one, two and many batches."""
    minutes = [0, 15, 15, 30, 20, 45, 45, 75, 60, 61, 90, 120, 90]
    rows = [f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00" for m in minutes]
    source = tmp_path / "in"
    source.mkdir()
    size = -(-len(rows) // cut)
    for i in range(0, len(rows), size):
        (source / f"part-{i // size}.csv").write_text("".join(f"a,{t}\n" for t in rows[i : i + size]))
    (source / "part-9.csv").write_text("end,2031-01-01 00:00:00\n")
    in_order(source)
    stream = spark.readStream.schema("Meter_ID string, Timestamp timestamp_ntz").option("maxFilesPerTrigger", 1).csv(str(source))
    got = run(spark, gaps.gap_alerts(stream, delay="1 hour"), tmp_path, f"cut{cut}")
    steps = sorted(set(minutes))
    want = sorted(b - a for a, b in zip(steps, steps[1:]) if b - a != 15)
    assert sorted(r.time_gap_minutes for r in got.filter("Meter_ID = 'a'").collect()) == want


def test_bad_times_are_malformed(spark):
    sent = ['{"Meter_ID": "a", "Timestamp": "not a time"}', '{"Meter_ID": "a", "Timestamp": "2024-01-01 00:00:00"}', '{"Meter_ID": "a"}']
    out = ingest.parse(spark.createDataFrame([(s,) for s in sent], "value string"))
    assert [r[ingest.BAD] for r in out.collect()] == [True, False, False]


def test_idle_meters_leave_the_state(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "part-0.csv").write_text("".join(f"m{i},2024-01-01 00:00:00\n" for i in range(20)))
    (source / "part-1.csv").write_text("m0,2024-01-01 01:00:00\nbusy,2024-01-20 00:00:00\n")
    (source / "part-2.csv").write_text("busy,2024-01-20 00:15:00\n")
    (source / "part-3.csv").write_text("busy,2024-01-20 00:30:00\nm1,2024-01-20 00:30:00\n")
    in_order(source)
    stream = spark.readStream.schema("Meter_ID string, Timestamp timestamp_ntz").option("maxFilesPerTrigger", 1).csv(str(source))
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    q = ingest.file_sink(gaps.gap_alerts(stream, idle_days=5), out, cp)
    drain(q)
    told = [(r.Meter_ID, r.time_gap_minutes) for r in spark.read.parquet(out).collect()]
    # The hour of m0 was told before it left; m1 came back as a new meter.
    assert told == [("m0", 60)]
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 2


def test_counts_outlive_restarts_and_repeated_batches(spark, payload, tmp_path):
    lines = lambda: ingest.file_source(spark, payload[0], max_files=1)
    out, counts, cp = str(tmp_path / "out"), str(tmp_path / "counts"), tmp_path / "cp"
    files = len(os.listdir(payload[0]))
    drain(ingest.counted_sink(lines(), out, counts, str(cp)))
    first = ingest.durable_counts(spark, counts)
    rows = sum(1 for f in os.listdir(payload[0]) for _ in open(f"{payload[0]}/{f}"))
    assert first == {"batches": files, "rows": rows} and spark.read.parquet(out).count() == rows
    # Killed after the last batch was written and before it was committed.
    for f in (cp / "commits").iterdir():
        if f.name.strip(".").split(".")[0] == str(files - 1):
            f.unlink()
    drain(ingest.counted_sink(lines(), out, counts, str(cp)))
    assert ingest.durable_counts(spark, counts) == first and spark.read.parquet(out).count() == rows
