"""Bands of any number, and deliveries merged into a stored star schema."""

import random

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from meterlake.operators import clean, features, increments, star
from meterlake.plans import bands


def lookup(values, rows):
    out = []
    for i, v in values:
        hits = [b for b, lo, hi in rows if v is not None and v == v and (lo is None or v >= lo) and (hi is None or v < hi)]
        out += [(i, b) for b in hits] or [(i, None)]
    return sorted(out, key=str)


def joined(spark, values, rows):
    v = spark.createDataFrame(values, "i int, x double")
    b = spark.createDataFrame(rows, "band int, _lo double, _hi double")
    return bands.join_bands(v, b, "x")


def test_bands_of_all_widths(spark):
    rng = random.Random(1)
    inf = float("inf")
    edges = [0.0, 1.0, -1.0, 2.0, 1e-9, 1e6, -1e6, 0.1, 0.30000000000000004]
    rows = []
    for i in range(400):
        lo = rng.choice([rng.uniform(-50, 50), rng.choice(edges), None])
        width = rng.choice([0.0, 1e-9, 0.25, 1.0, 3.0, 64.0, 1e7])
        rows.append((i, lo, None if rng.random() < 0.1 else (rng.uniform(-50, 50) if lo is None else lo + width)))
    rows += [(1000, -inf, 0.0), (1001, 0.0, inf), (1002, 5.0, 1.0), (1003, None, None), (1004, None, -inf)]
    values = [(i, rng.choice([rng.uniform(-60, 60), rng.choice(edges), r[1] or 0.0, r[2] or 0.0])) for i, r in enumerate(rows)]
    values += [(9001, None), (9002, inf), (9003, -inf), (9004, float("nan")), (9005, 1.0), (9006, 1.0)]
    got = sorted([(r["i"], r["band"]) for r in joined(spark, values, rows).collect()], key=str)
    assert got == lookup(values, rows)


def test_very_many_bands_without_a_nested_loop(spark):
    b = spark.range(100_000).select(F.col("id").cast("int").alias("band"), (F.col("id") / 10).alias("_lo"), ((F.col("id") + 3) / 10).alias("_hi"))
    v = spark.range(20_000).select(F.col("id").cast("int").alias("i"), (F.col("id") * 0.5 + 0.26).alias("x"))
    out = bands.join_bands(v, b, "x")
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == sum(1 for i in range(20_000) for b in range(int((i * 0.5 + 0.26) * 10) - 4, int((i * 0.5 + 0.26) * 10) + 2)
                              if 0 <= b < 100_000 and b / 10 <= i * 0.5 + 0.26 < (b + 3) / 10) + sum(1 for i in range(20_000) if i * 0.5 + 0.26 >= 100_002 / 10)


def totals():
    return {"bands": (F.count("band"), F.sum), "first_band": (F.min("band"), F.min), "total": (F.sum("band"), F.sum)}


def totalled(spark, values, rows):
    v = spark.createDataFrame(values, "i int, x double")
    b = spark.createDataFrame(rows, "band int, _lo double, _hi double")
    return sorted(map(tuple, bands.join_bands(v, b, "x", totals=totals()).select("i", "bands", "first_band", "total").collect()))


def expected_totals(values, rows):
    hits = {}
    for i, b in lookup(values, rows):
        hits.setdefault(i, []).extend([] if b is None else [b])
    return sorted((i, len(b) or None, min(b, default=None), sum(b) if b else None) for i, b in hits.items())


@pytest.mark.parametrize("upper", [12, 2])
def test_totals_of_overlapping_bands(spark, monkeypatch, upper):
    monkeypatch.setattr(bands, "UPPER", upper)
    rng = random.Random(3)
    inf, nan = float("inf"), float("nan")
    edges = [0.0, -0.0, 1.0, 0.1, 0.30000000000000004, -inf, inf, 5.0, -5.0, None]
    rows = [(i, rng.choice([rng.uniform(-9, 9), rng.choice(edges)]), rng.choice([rng.uniform(-9, 9), rng.choice(edges)])) for i in range(500)]
    values = [(i, rng.choice([rng.uniform(-10, 10), rng.choice(edges)])) for i in range(300)] + [(400, nan), (401, None), (402, 1.0), (403, 1.0)]
    assert totalled(spark, values, rows) == expected_totals(values, rows)
    assert totalled(spark, values[:1], rows) == expected_totals(values[:1], rows)
    assert totalled(spark, values, rows[:1]) == expected_totals(values, rows[:1])
    assert totalled(spark, values[:3], []) == [(i, None, None, None) for i in range(3)] and totalled(spark, [], rows) == []


def test_totals_make_no_pairs(spark):
    """Every value lies in half of the bands: 800 million pairs, of which none is listed."""
    b = spark.range(40_000).select(F.col("id").cast("int").alias("band"), F.col("id").cast("double").alias("_lo"), (F.col("id") + 40_000.0).alias("_hi"))
    v = spark.range(40_000).select(F.col("id").cast("int").alias("i"), (F.col("id") + 20_000.0).alias("x"))
    out = bands.join_bands(v, b, "x", totals=totals())
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r["i"]: (r["bands"], r["first_band"]) for r in out.collect()}
    # x = i + 20000 lies in the bands from x - 39999 to x.
    want = {i: (min(i + 20_000, 39_999) - max(i - 19_999, 0) + 1, max(i - 19_999, 0)) for i in range(40_000)}
    assert got == want


def test_no_bands_and_no_values(spark):
    assert [tuple(r) for r in joined(spark, [(1, 2.0)], []).collect()] == [(1, 2.0, None)]
    assert joined(spark, [], [(1, 0.0, 1.0)]).count() == 0
    assert [tuple(r) for r in joined(spark, [(1, None)], [(1, 0.0, 1.0)]).collect()] == [(1, None, None)]


def test_profiles_beyond_the_limit(spark, monkeypatch):
    fact = spark.createDataFrame([(1, 0.5), (2, 3.0), (3, None), (4, 99.0), (5, -1.0)], "reading_id int, active_power_kw double")
    few = star.band_lookup(fact, star.dim_load_profile(spark)).select("reading_id", "load_profile_id")
    monkeypatch.setattr(star, "MOST_PROFILES", 1)
    many = star.band_lookup(fact, star.dim_load_profile(spark)).select("reading_id", "load_profile_id")
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


@pytest.fixture(scope="module")
def delivery(spark, sf_dir):
    r = fixtures.readings(spark, sf_dir)
    r = features.load_category(features.power_factor(features.peak_flag(features.season(features.temporal(r)))))
    # One row without a time, one repeated.
    odd = r.limit(1).withColumns({"Timestamp": F.lit(None).cast("timestamp_ntz"), "_seq": F.lit(10**9).cast("long")})
    return clean.flag_outliers(r.unionByName(odd), ["Active_Power_kW"]).cache()


TABLES = {
    "fact_energy_reading": ["reading_id", "timestamp", "meter_id", "active_power_kw", "reading_date"], "dim_meter": None, "dim_zone": None, "dim_time": None,
    "agg_daily_consumption": None, "agg_hourly_zone_consumption": None, "agg_monthly_consumption": None,
}


def files(path):
    return {str(f): f.stat().st_mtime_ns for f in path.rglob("part-*.parquet")}


def test_second_delivery_touches_its_own_dates(spark, delivery, tmp_path):
    days = sorted(r[0] for r in delivery.select(F.to_date("Timestamp")).distinct().collect() if r[0])
    late = days[len(days) * 3 // 4 :]
    day = F.to_date("Timestamp")
    a, b = tmp_path / "two", tmp_path / "one"
    first = delivery.filter(day.isNull() | ~day.isin(late))
    second = delivery.filter(day.isin(late))
    increments.merge_delivery(spark, first, str(a))
    before = files(a)
    # The second one also repeats a day of the first.
    merged = increments.merge_delivery(spark, second.unionByName(first.filter(day == days[0])), str(a))
    assert merged == {"facts": second.dropDuplicates(["Timestamp", "Meter_ID"]).count(), "days": len(late) + 1}
    after = files(a)
    gone = [f for f in before if f not in after]
    assert all(str(days[0]) in f or "month=" in f or "dim_" in f for f in gone)
    assert all(after[f] == t for f, t in before.items() if f in after)
    again = increments.merge_delivery(spark, second, str(a))
    assert again["facts"] == 0
    increments.merge_delivery(spark, delivery, str(b))
    for name, columns in TABLES.items():
        two, one = spark.read.parquet(str(a / name)), spark.read.parquet(str(b / name))
        columns = columns or sorted(one.columns)
        assert sorted(map(repr, two.select(*columns).collect())) == sorted(map(repr, one.select(*columns).collect())), name


def test_months_come_from_the_stored_days(spark, delivery, tmp_path):
    path = str(tmp_path / "months")
    day = F.dayofmonth("Timestamp")
    for part in (day <= 12, (day > 9) | day.isNull()):
        increments.merge_delivery(spark, delivery.filter(part), path)
    fact = spark.read.parquet(f"{path}/fact_energy_reading")
    stored, want = spark.read.parquet(f"{path}/agg_monthly_consumption"), star.agg_monthly_consumption(fact)
    columns = sorted(want.columns)
    assert sorted(map(repr, stored.select(*columns).collect())) == sorted(map(repr, want.select(*columns).collect()))
    given = star.agg_monthly_consumption(daily=star.agg_daily_consumption(fact))
    assert sorted(map(repr, given.collect())) == sorted(map(repr, want.collect()))


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_rows_are_sorted_only_where_there_are_copies(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(increments, "MOST_COPIED", most)
    rows = [(1, "a", "x"), (2, "a", "y"), (None, "b", "z"), (3, None, "u")]
    single = spark.createDataFrame(rows, "t int, m string, v string")
    copies = spark.createDataFrame([*rows, (1, "a", "X"), (None, "b", "Z"), (3, None, "u")], "t int, m string, v string")
    alone, folded = increments.one_of_each(single, ["t", "m"]), increments.one_of_each(copies, ["t", "m"])
    assert "SortAggregate" not in alone._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, alone.collect())) == sorted(map(repr, single.collect()))
    assert sorted(((r["t"], r["m"]) for r in folded.collect()), key=repr) == sorted((r[:2] for r in rows), key=repr)
    path = str(tmp_path / "t")
    assert increments.append_absent(spark, copies.filter("t < 3"), path, ["t", "m"]).count() == 2
    assert increments.append_absent(spark, copies, path, ["t", "m"]).count() == 2
    assert spark.read.parquet(path).count() == 4
