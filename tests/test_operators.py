"""Traps on hand-made frames: nulls, ties, bounds, empty input, odd names."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlake import config
from meterlake.functions import calendar, electrical, exact
from meterlake.functions.exact import clip, exact_avg, exact_sum, out_of_range, rounded, safe_divide
from meterlake.operators import analytics, clean, features, quality, star
from meterlake.plans import splits
from meterlake.queries import consumption, reports
from meterlake.schema import MEASURES, MissingColumns, require

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "_seq long, Timestamp timestamp_ntz, Meter_ID string, Zone_ID string, " + ", ".join(
    f"{c} double" for c in MEASURES
)
GOOD = dict(
    Voltage_V=230.0, Current_A=10.0, Active_Power_kW=3.0, Reactive_Power_kW=4.0,
    Apparent_Power_kVA=5.0, Frequency_Hz=50.0, Sub_Meter_Kitchen=1.0, Sub_Meter_HVAC=1.0,
    Outdoor_Temp_C=20.0,
)


def frame(spark, *rows):
    """Rows as (minute, meter, zone, overrides)."""
    data = []
    for i, (minute, meter, zone, over) in enumerate(rows):
        values = GOOD | over
        data.append((i, T0 + dt.timedelta(minutes=minute), meter, zone, *[values[c] for c in MEASURES]))
    return spark.createDataFrame(data, SCHEMA)


def column(df, name, order="_seq"):
    return [r[0] for r in df.orderBy(order).select(name).collect()]


# --- functions ---------------------------------------------------------------


def values(spark, expr, *xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_rounded_half_away_from_zero(spark):
    assert values(spark, rounded("x", 1), 0.25, -0.25, 2.0, None) == [0.3, -0.3, 2.0, None]


def test_clip_keeps_null(spark):
    assert values(spark, clip("x", 0, 5), -1.0, None, 6.0, 5.0) == [0.0, None, 5.0, 5.0]


def test_out_of_range_null_is_inside(spark):
    assert values(spark, out_of_range("x", 190, 250), 190.0, 250.0, None, 189.9, 250.1) == [
        False, False, False, True, True,
    ]


def test_safe_divide(spark):
    assert values(spark, safe_divide(F.lit(1.0), "x"), 2.0, 0.0, None) == [0.5, 0.0, None]


def test_load_bands_bounds_and_fallback(spark):
    got = values(spark, electrical.banded("x"), 0.0, 1.0, 3.0, 10.0, -1.0, None, 0.99)
    assert got == ["Low", "Medium", "High", "VeryHigh", "VeryHigh", "VeryHigh", "Low"]


def test_right_closed_bins(spark):
    label = electrical.right_closed("x", [F.lit(0.0), F.lit(1.0), None], ["a", "b"])
    assert values(spark, label, 0.0, 1.0, 1.1, -1.0, None) == [None, "a", "b", None, None]


def test_timestamp_formats(spark):
    texts = [
        "2024-02-03 04:05:06", "2024/02/03 04:05:06", "03-02-2024 04:05:06", "03/02/2024 04:05:06",
        "2024-02-03", "2024/02/03", "nonsense", None,
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(calendar.parse_timestamp("t")).collect()]
    full, day = dt.datetime(2024, 2, 3, 4, 5, 6), dt.datetime(2024, 2, 3)
    assert got == [full] * 4 + [day] * 2 + [None, None]


def test_seasons_and_weekdays(spark):
    df = spark.range(1, 13).select(
        calendar.season("id").alias("s"), calendar.season("id", "temperate").alias("t")
    )
    rows = df.collect()
    assert rows[8].s == "Monsoon" and rows[8].t == "Autumn" and rows[11].s == "Winter"
    sunday = spark.sql("select timestamp_ntz'2024-01-07 00:00:00' as t")
    row = sunday.select(calendar.weekday_monday0("t"), calendar.weekday_sunday0("t")).first()
    assert tuple(row) == (6, 0)


def test_require_columns(spark):
    with pytest.raises(MissingColumns):
        require(spark.range(1), ["Meter_ID"])


# --- cleaning -----------------------------------------------------------------


def test_keep_first_null_keys_and_idempotent(spark):
    df = frame(spark, (0, "a", "z", {}), (0, "a", "z", {"Voltage_V": 1.0}), (0, None, "z", {}), (0, None, "z", {}))
    once = clean.keep_first(df)
    assert sorted(column(once, "_seq")) == [0, 2]
    assert clean.keep_first(once).count() == 2
    assert sorted(column(clean.keep_first(df, few_copies=True), "_seq")) == [0, 2]


def test_fill_order_and_median(spark):
    p = "Active_Power_kW"
    df = frame(
        spark,
        (0, "a", "z", {p: None}), (1, "a", "z", {p: 2.0}), (2, "a", "z", {p: None}),
        (0, "b", "z", {p: None}), (0, "c", "z", {p: 6.0}),
    )
    # The median is taken after the fills: 2, 2, 2, 6.
    assert column(clean.fill_missing(df), p) == [2.0, 2.0, 2.0, 2.0, 6.0]
    assert column(clean.fill_missing(df.filter("Meter_ID = 'b'")), p) == [None]


def test_repair_modes(spark):
    p = "Active_Power_kW"
    rows = [(0, "a", "z", {p: -1.0}), (1, "a", "z", {p: 30.0}), (2, "a", "z", {p: 25.0, "Voltage_V": 300.0})]
    df = frame(spark, *rows)
    assert column(clean.repair_ranges(df, mode="compat"), p) == [30.0, 25.0]
    assert column(clean.repair_ranges(df), p) == [25.0, 25.0]
    assert column(clean.repair_ranges(df), "Voltage_V") == [230.0, 250.0]
    no_drop = frame(spark, *rows[1:])
    assert column(clean.repair_ranges(no_drop, mode="compat"), p) == [25.0, 25.0]
    with pytest.raises(ValueError):
        clean.repair_ranges(df, mode="other")


def test_repair_counts_follow_earlier_drops(spark):
    df = frame(spark, (0, "a", "z", {"Current_A": -1.0, "Active_Power_kW": -1.0}), (1, "a", "z", {}))
    row = clean.repair_counts(df).first()
    assert row.Current_A_dropped == 1 and row.Active_Power_kW_dropped == 0


def test_after_clip_always_validity_passes(spark, sf_dir):
    from checks import fixtures

    fixed = clean.repair_ranges(clean.fill_missing(fixtures.readings(spark, sf_dir)))
    assert all(r.passed for r in quality.check_validity(fixed).collect())


def test_constant_column_has_no_outliers(spark):
    df = frame(spark, *[(i, "a", "z", {}) for i in range(5)])
    assert set(column(clean.flag_outliers(df), "is_anomaly")) == {False}
    assert set(column(clean.flag_zscore(df, "Active_Power_kW"), "is_zscore_outlier")) == {False}


def test_empty_input(spark):
    empty = frame(spark, (0, "a", "z", {})).filter("false")
    assert clean.clean_readings(empty).count() == 0
    assert features.temporal(empty).count() == 0
    assert quality.null_profile(empty).count() == 12
    assert consumption.daily_consumption(empty).count() == 0
    assert analytics.histogram(empty).count() == 0
    assert quality.modal_gap(empty).first().modal_gap_seconds is None
    assert {r.check_name for r in quality.validate(empty).collect()} >= {"overall", "validity"}


def test_logical_rules_only_where_violated(spark):
    df = frame(spark, (0, "a", "z", {"Voltage_V": 0.0}))
    rows = {r.rule: r.row_count for r in clean.logical_inconsistencies(df).collect()}
    assert rows == {"zero_voltage_with_current": 1}


# --- features ------------------------------------------------------------------


def test_power_factor_zero_apparent(spark):
    df = frame(spark, (0, "a", "z", {"Apparent_Power_kVA": 0.0}), (1, "a", "z", {"Active_Power_kW": 9.0}), (2, "a", "z", {"Active_Power_kW": None}))
    assert column(features.power_factor(df), "power_factor") == [0.0, 1.0, None]


def test_bucket_repeated_edges_raise(spark):
    df = frame(spark, *[(i, "a", "z", {}) for i in range(5)])
    with pytest.raises(ValueError, match="edges"):
        features.consumption_bucket(df)


def test_rolling_equals_pandas(spark, sf_dir):
    from checks import fixtures

    df = fixtures.readings(spark, sf_dir)
    got = features.rolling(df, columns=["Active_Power_kW"]).toPandas().sort_values(["Meter_ID", "Timestamp"])
    roll = got.groupby("Meter_ID")["Active_Power_kW"].rolling(24, min_periods=1)
    for kind, want in (("mean", roll.mean()), ("std", roll.std())):
        have = got[f"Active_Power_kW_rolling_{kind}_24h"].reset_index(drop=True)
        assert ((have - want.reset_index(drop=True)).abs().fillna(0) < 1e-9).all()
        assert (have.isna() == want.reset_index(drop=True).isna()).all()


def test_group_features_null_zone(spark):
    df = frame(spark, (0, "a", None, {}), (1, "a", "z", {"Active_Power_kW": 5.0}))
    rows = features.group_features(df).orderBy("_seq").collect()
    assert rows[0].zone_avg_power_kW is None and rows[1].zone_avg_power_kW == 5.0
    assert rows[0].meter_daily_consumption_kWh == 8.0 and rows[0].meter_avg_power_kW == 4.0


def test_hot_meter_features_equal_plain(spark, sf_dir, monkeypatch):
    """The whole chain on splits gives what plain windows give."""
    from checks import fixtures

    df = fixtures.readings_dup(spark, sf_dir).withColumn(
        "Meter_ID", F.when(F.col("_seq") % 3 == 0, "MTR-0").otherwise(F.col("Meter_ID"))
    )
    plain = features.feature_table(clean.clean_readings(df))
    want = sorted(map(repr, plain.collect()))
    tiny = config.SplitPolicy(min_rows=30, max_groups=64, max_slices=16, map_rows=0)
    real, seen = splits.measure, []

    def small(frame, keys, order, policy=None):
        s = real(frame, keys, order, tiny)
        seen.append(s.any)
        return s

    monkeypatch.setattr(clean, "measure", small)
    monkeypatch.setattr(features, "measure", small)
    split = features.feature_table(clean.clean_readings(df)).select(plain.columns)
    assert any(seen)
    rounded_columns = [c for c, t in split.dtypes if t == "double"]
    digits = {c: rounded(c, 6) for c in rounded_columns}
    got = sorted(map(repr, split.withColumns(digits).collect()))
    assert got == sorted(map(repr, plain.withColumns(digits).collect())) and len(want) == len(got)


# --- queries -------------------------------------------------------------------


def test_single_reading_has_no_deviation(spark):
    df = frame(spark, (0, "a", "z", {}))
    assert analytics.hourly_stats(df).first().std is None
    assert consumption.hourly_volatility(df).count() == 0


def test_totals_are_conserved(spark, sf_dir):
    from checks import fixtures

    df = fixtures.readings(spark, sf_dir)
    n = df.count()
    for query, c in (
        (consumption.hourly_consumption, "record_count"),
        (consumption.zone_analysis, "Record_Count"),
        (consumption.zone_statistics, "total_readings"),
        (consumption.anomaly_counts, "total_readings"),
        (consumption.load_volatility, "readings"),
        (consumption.peak_hours, "record_count"),
    ):
        assert query(df).agg(F.sum(c)).first()[0] == n
    hours = consumption.peak_hours(df).groupBy("period_classification").count().collect()
    assert {r[0]: r[1] for r in hours} == {"Peak": 12, "Off-Peak": 12}


def test_null_zone_has_no_zone_average(spark):
    df = frame(spark, (0, "a", None, {}), (1, "b", "z", {}))
    fact = star.fact_table(df)
    rows = {r.meter_id: r for r in reports.meter_vs_zone(fact, star.dim_meter(df)).collect()}
    assert rows["a"].zone_avg_power_kw is None and rows["a"].performance_category == "Below Average"


def test_meter_status_keeps_meters_without_zones(spark):
    df = frame(spark, (0, "a", "z", {}))
    zones = star.dim_zone(df).filter("false")
    fact = star.fact_table(df.withColumn("is_anomaly", F.lit(0)))
    row = star.current_meter_status(fact, star.dim_meter(df), zones).first()
    assert (row.meter_id, row.zone_id, row.zone_name, row.total_readings) == ("a", "z", None, 1)
    none = star.current_meter_status(fact.filter("false"), star.dim_meter(df), zones).first()
    assert none.zone_id is None and none.total_readings == 0


def test_insert_absent(spark):
    old = star.dim_load_profile(spark)
    new = old.limit(1).unionByName(
        spark.createDataFrame([(9, "Extra", 25.0, 40.0, "x")], old.schema)
    )
    assert star.insert_absent(old, new, ["load_category"]).count() == 5


def test_validation_gate(spark):
    df = frame(spark, (0, "a", "z", {"Voltage_V": 999.0}))
    with pytest.raises(quality.ValidationFailed):
        quality.require_valid(df)
    assert quality.require_valid(frame(spark, (0, "a", "z", {}))) is not None


def test_no_unpartitioned_window_over_readings(spark, sf_dir):
    """Plans over raw readings hold neither a cross product nor a single-task window."""
    from checks import registry

    for name in ("F6_rolling_rows", "B18_context_spikes_all", "Q4_3_reading_gaps", "W1_row_number"):
        plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "SinglePartition" not in plan, name


# --- values of any size ----------------------------------------------------------


def test_sums_take_any_value(spark):
    big = frame(spark, (0, "a", "z", {"Active_Power_kW": 1e12}), (1, "a", "z", {"Active_Power_kW": 2.5}))
    row = consumption.daily_consumption(big).first()
    assert row.daily_total_power == 1e12 + 2.5
    tiny = frame(spark, *[(i, "a", "z", {"Active_Power_kW": 4e-8}) for i in range(1000)])
    assert tiny.agg(exact_sum("Active_Power_kW")).first()[0] == pytest.approx(4e-5, rel=1e-9)
    endless = frame(spark, (0, "a", "z", {"Active_Power_kW": float("inf")}), (1, "a", "z", {"Active_Power_kW": 1.0}))
    row = endless.agg(exact_sum("Active_Power_kW").alias("s"), exact_avg("Active_Power_kW").alias("m")).first()
    assert row.s == row.m == float("inf")
    none = frame(spark, (0, "a", "z", {"Active_Power_kW": None}))
    assert none.agg(exact_sum("Active_Power_kW")).first()[0] is None


def test_rounding_keeps_what_a_long_cannot_hold(spark):
    df = spark.createDataFrame([(1e17,), (float("-inf"),), (2.345,)], "x double")
    assert [r[0] for r in df.select(rounded("x", 2)).collect()] == [1e17, float("-inf"), 2.35]


def test_next_reading_is_strictly_later(spark):
    from meterlake.queries import audit

    df = frame(spark, (0, "a", "z", {}), (0, "a", "z", {}), (15, "a", "z", {}), (45, "a", "z", {}))
    rows = audit.reading_gaps(star.fact_table(df), star.dim_meter(df)).collect()
    assert [(r.time_gap_minutes, r.gap_type) for r in rows] == [(30, "Missing readings")]


@pytest.mark.parametrize("order", ["id", "-id", "hash(id)"])
def test_sums_keep_every_digit(spark, order):
    """Values with more than seven decimals are summed whole, in any order."""
    rows = spark.range(1000).selectExpr("id", "0.12345675D AS v").orderBy(F.expr(order))
    got = rows.agg(exact.exact_sum("v").alias("s"), exact.exact_avg("v").alias("a")).first()
    assert got["s"] == 123.45675 and got["a"] == 0.12345675
    mixed = rows.select(F.when(F.col("id") % 2 == 0, 1.0 / 3).when(F.col("id") % 5 == 0, 1e15).otherwise(4e-9).alias("v"))
    want = 500 / 3 + 100 * 1e15 + 400 * 4e-9
    assert abs(mixed.agg(exact.exact_sum("v")).first()[0] - want) <= abs(want) * 1e-15
    w = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    last = spark.range(1000).selectExpr("id", "0.12345675D AS v").withColumn("s", exact.exact_over("v", w)).filter("id = 999").first()
    assert last["s"] == 123.45675
