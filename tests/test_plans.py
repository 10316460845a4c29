"""Split plans give the same result as plain windows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlake.config import SplitPolicy
from meterlake.plans import ordered, quantiles, sketches, splits

TINY = SplitPolicy(min_rows=20, max_groups=64, max_slices=16, map_rows=0)


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(600):
        key = "hot" if i % 3 else rnd.choice(["a", "b", "c", None])
        ts = rnd.randrange(0, 5000)
        v = None if rnd.random() < 0.3 else float(rnd.randrange(0, 40))
        rows.append((i, key, ts, v))
    for i in range(600, 700):  # many equal order values
        rows.append((i, "hot", 77, float(i % 5)))
    return spark.createDataFrame(rows, "seq long, k string, ts long, v double").cache()


def same(a, b):
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def hot(df, keys, order):
    s = splits.measure(df, keys, order, TINY)
    assert s.any
    return s


def test_measure_none_on_small(skewed):
    assert not splits.measure(skewed, ["k"], "ts").any


def test_hot_groups_are_bounded(skewed):
    s = hot(skewed, ["k"], "ts")
    assert len(s.rows) <= TINY.max_groups
    sizes = s.hot(skewed, ["ts", "seq"]).groupBy("k", splits.SLICE).count()
    assert sizes.filter("k = 'hot'").count() > 3


@pytest.fixture(scope="module")
def unsplittable(spark):
    """A hot group whose rows mostly lack a time or share one, and whose values are mostly equal."""
    rows = []
    for i in range(2000):
        ts = None if i % 5 < 2 else (100 if i % 5 < 4 else i)
        v = 7.0 if i % 5 else (None if i % 25 == 0 else float(i % 11))
        rows.append((i, "hot" if i % 10 else "b", ts, v))
    rows += [(1, "hot", 100, float("nan")), (1, "hot", 100, float("inf"))] * 20
    return spark.createDataFrame(rows, "seq long, k string, ts long, v double").cache()


LOW = SplitPolicy(min_rows=100, max_groups=64, max_slices=64, map_rows=0)


@pytest.mark.parametrize("order", [["ts", "seq"], ["ts"]])
def test_null_and_repeated_times_are_cut(unsplittable, order):
    s = splits.measure(unsplittable, ["k"], "ts", LOW)
    sizes = s.hot(unsplittable, order).groupBy(splits.SLICE).count()
    assert sizes.count() > 10 and sizes.agg(F.max("count")).first()[0] <= LOW.min_rows
    ranges = s.hot(unsplittable, order).groupBy(splits.SLICE).agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy(splits.SLICE).collect()
    assert all(x["b"] is None or y["a"] is not None and x["b"] <= y["a"] for x, y in zip(ranges, ranges[1:]))


def test_running_over_null_and_repeated_times(unsplittable):
    args = (["k"], ["ts", "seq", "v"], {"n": F.lit(1), "s": F.when(~F.isnan("v") & (F.col("v") < 100), F.col("v"))})
    plain = ordered.running(unsplittable, *args, splits.none(["k"], "ts"), {"t": F.lit(1)})
    split = ordered.running(unsplittable, *args, splits.measure(unsplittable, ["k"], "ts", LOW), {"t": F.lit(1)})
    same(plain, split.select(plain.columns))


def test_fill_and_frames_over_null_times(unsplittable):
    df = unsplittable.filter("seq <> 1")
    s = splits.measure(df, ["k"], "ts", LOW)
    plain = ordered.fill(df, ["k"], ["ts", "seq"], ["v"], splits.none(["k"], "ts"))
    same(plain, ordered.fill(df, ["k"], ["ts", "seq"], ["v"], s).select(plain.columns))
    exprs = {"m": lambda w: F.sum("v").over(w.rowsBetween(-23, 0))}
    plain = ordered.frames(df, ["k"], ["ts", "seq"], exprs, splits.none(["k"], "ts"), 23)
    same(plain, ordered.frames(df, ["k"], ["ts", "seq"], exprs, s, 23, slab=30).select(plain.columns))


@pytest.mark.parametrize("keys", [["k"], []])
def test_rank_where_most_values_are_equal(unsplittable, keys):
    s = splits.measure(unsplittable, keys, "v", LOW)
    assert s.any
    plain = ordered.rank_desc(unsplittable, keys, "v", "r", splits.none(keys, "v"))
    split = ordered.rank_desc(unsplittable, keys, "v", "r", s)
    same(plain, split.select(plain.columns))
    # No sort of rows, and the value that most rows share is looked up where they lie.
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("keys", [["k"], []])
def test_running(skewed, keys):
    args = (keys, ["ts", "seq"], {"n": F.lit(1), "s": F.col("v")})
    plain = ordered.running(skewed, *args, splits.none(keys, "ts"), {"t": F.col("v")})
    split = ordered.running(skewed, *args, hot(skewed, keys, "ts"), {"t": F.col("v")})
    same(plain, split.select(plain.columns))


def test_fill(skewed):
    args = (["k"], ["ts", "seq"], ["v"])
    plain = ordered.fill(skewed, *args, splits.none(["k"], "ts"))
    split = ordered.fill(skewed, *args, hot(skewed, ["k"], "ts"))
    same(plain, split.select(plain.columns))


def test_rank(skewed):
    s = hot(skewed.filter("v is not null"), ["k"], "v")
    plain = ordered.rank_desc(skewed, ["k"], "v", "r", splits.none(["k"], "v"))
    split = ordered.rank_desc(skewed, ["k"], "v", "r", s)
    same(plain, split.select(plain.columns))


@pytest.mark.parametrize("before,after", [(23, 0), (10, 10), (0, 1)])
def test_frames(skewed, before, after):
    exprs = {
        "m": lambda w: F.sum("v").over(w.rowsBetween(-before, after)),
        "c": lambda w: F.count("v").over(w.rowsBetween(-before, after)),
    }
    args = (["k"], ["ts", "seq"], exprs)
    plain = ordered.frames(skewed, *args, splits.none(["k"], "ts"), before, after)
    split = ordered.frames(skewed, *args, hot(skewed, ["k"], "ts"), before, after, slab=30)
    same(plain, split.select(plain.columns))


@pytest.mark.parametrize("policy", [TINY, SplitPolicy()])
def test_quantiles_equal_percentile(skewed, policy):
    got = quantiles.group_quantiles(skewed, ["k"], "v", [0.05, 0.25, 0.5, 0.95], policy=policy)
    want = skewed.groupBy("k").agg(
        *[F.percentile("v", p).alias(quantiles.quantile_name(p)) for p in (0.05, 0.25, 0.5, 0.95)]
    )
    same(got, want)


PROBS = (0.0, 0.05, 0.25, 0.5, 0.95, 1.0)


@pytest.fixture(scope="module")
def many_values(spark):
    """Random, constant, two-valued, tied, odd and empty groups."""
    base = spark.range(120_000).withColumn("g", F.col("id") % 6)
    r = F.rand(3)
    v = (
        F.when(F.col("g") == 0, r).when(F.col("g") == 1, 4.25).when(F.col("g") == 2, F.floor(r * 2)).when(F.col("g") == 3, F.floor(r * 50))
        .when(F.col("g") == 4, F.when(r < 0.1, float("inf")).when(r < 0.2, float("-inf")).when(r < 0.3, None).otherwise(r * 1e9))
    )
    return base.select(F.when(F.col("g") != 3, F.col("g")).alias("g"), v.alias("v"), (F.col("id") * 3 % 1000).alias("w")).cache()


def test_brackets_equal_percentile(many_values):
    got = quantiles.long_quantiles(many_values, ["g"], ["v", "w"], PROBS, policy=TINY)
    want = None
    for c in ("v", "w"):
        one = many_values.groupBy("g").agg(*[F.percentile(F.col(c).cast("double"), p).alias(quantiles.quantile_name(p)) for p in PROBS])
        one = one.select("g", F.lit(c).alias("column_name"), *[quantiles.quantile_name(p) for p in PROBS])
        want = one if want is None else want.union(one)
    same(got, want)
    whole = quantiles.wide_quantiles(many_values, ["v", "w"], PROBS, policy=TINY).first().asDict()
    assert whole == quantiles.wide_quantiles(many_values, ["v", "w"], PROBS).first().asDict()


def test_brackets_move_few_values(many_values):
    values = many_values.filter("g = 0").select("g", "v")
    inside = quantiles._inside(values, quantiles._brackets(values, ["g"], ["v"], PROBS, quantiles.REACH), ["g"], ["v"], PROBS)
    assert inside.count() < 0.01 * values.count() * len(PROBS)


def test_brackets_that_miss_are_widened(many_values, monkeypatch):
    monkeypatch.setattr(quantiles, "REACH", 0)
    monkeypatch.setattr(quantiles, "ACCURACY", 60)
    got = quantiles.group_quantiles(many_values.filter("g in (0, 2)"), ["g"], "v", [0.31, 0.5], policy=TINY)
    want = many_values.filter("g in (0, 2)").groupBy("g").agg(F.percentile("v", 0.31).alias("q31"), F.percentile("v", 0.5).alias("q50"))
    same(got, want)


def test_sketches_merge(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 3).alias("g"), F.timestamp_seconds(F.col("id") * 40).cast("timestamp_ntz").alias("t"), (F.rand(5) * 100).alias("v"),
        F.pmod(F.xxhash64("id"), F.lit(30_000)).alias("m"),
    )
    days = sketches.daily_sketches(df.withColumn("v", F.expr("if(g = 2 and day(t) = 3, null, v)")), ["g"], "t", "v")
    months = sketches.merged(days, ["g", F.trunc("day", "month").alias("month")])
    probs = [0.05, 0.5, 0.95]
    q = sketches.sketch_quantiles(months, probs)
    seen = df.withColumn("month", F.trunc(F.to_date("t"), "month")).withColumn("v", F.expr("if(g = 2 and day(t) = 3, null, v)"))
    checked = sketches.rank_within(seen, ["g", "month"], "v", q, probs).collect()
    assert len(checked) == q.count() and all(r["within"] for r in checked)
    assert {(r["g"], r["month"]): r["n"] for r in checked} == {(r["g"], r["month"]): r["n"] for r in q.collect()}
    per_day = df.groupBy("g", F.to_date("t").alias("day")).agg(sketches.distinct_sketch("m").alias("s"))
    direct = df.groupBy("g").agg(F.hll_sketch_estimate(sketches.distinct_sketch("m")).alias("direct"), F.count_distinct("m").alias("exact"))
    for r in sketches.merged_distinct(per_day, ["g"], "s", "merged").join(direct, "g").collect():
        assert abs(r["merged"] - r["exact"]) <= 0.03 * r["exact"] and abs(r["merged"] - r["direct"]) <= 0.01 * r["exact"]


def test_wide_quantiles_and_empty(skewed):
    one = quantiles.wide_quantiles(skewed, ["v", "ts"], [0.5]).first()
    assert one["v_q50"] is not None and one["ts_q50"] is not None
    empty = quantiles.wide_quantiles(skewed.filter("false"), ["v"], [0.5]).collect()
    assert [tuple(r) for r in empty] == [(None,)]


def test_plain_plan_has_one_exchange(skewed):
    out = ordered.frames(
        skewed, ["k"], ["ts", "seq"],
        {"m": lambda w: F.avg("v").over(w.rowsBetween(-23, 0))},
        splits.none(["k"], "ts"), 23,
    )
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert Window.unboundedPreceding is not None


@pytest.mark.parametrize("policy", [TINY, SplitPolicy()])
def test_groups_without_values_give_nulls(spark, policy):
    df = spark.createDataFrame([("a", 1.5), ("b", None), (None, None), (None, 2.0)], "k string, v double")
    got = quantiles.group_quantiles(df, ["k"], "v", [0.5], policy=policy).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == ["('a', 1.5)", "('b', None)", "(None, 2.0)"]


def _range_frame(df, hours):
    at = F.unix_micros(F.col("t").cast("timestamp"))
    w = Window.partitionBy("k").orderBy(at).rangeBetween(-hours * 3_600_000_000, 0)
    return df.withColumns({"m": F.avg("x").over(w), "s": F.stddev_samp("x").over(w)})


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("hours", [0, 1, 23])
def test_sliding_equals_range_frames(spark, hours, hot):
    """Ties, ends on a border, missing times, values and keys, a huge value that must leave no trace."""
    rng = random.Random(hours)
    rows = []
    for i in range(1500):
        t = None if i % 40 == 0 else f"2024-01-{1 + i // 400:02d} {rng.randrange(24):02d}:{rng.choice((0, 0, 15, 30)):02d}:00"
        x = None if i % 17 == 0 else 1e12 if i == 700 else 0.1 if i % 3 else rng.random()
        rows.append((i, rng.choice(["a", "a", "b", None]), t, x, "other"))
    rows.append((1500, "before", "1969-12-31 23:59:00", 2.0, "other"))
    df = spark.createDataFrame(rows, "i int, k string, t string, x double, _extra string").withColumn("t", F.to_timestamp("t").cast("timestamp_ntz"))
    s = splits.measure(df, ["k"], "t", SplitPolicy(min_rows=200, max_groups=4)) if hot else splits.none(["k"], "t")
    assert s.any == hot
    got = {r.i: r for r in ordered.sliding(df, ["k"], "t", {"x": ("m", "s")}, hours, s).collect()}
    want = _range_frame(df, hours).collect()
    assert len(got) == len(want)
    for r in want:
        mine = got[r.i]
        assert (mine.m is None) == (r.m is None) and (mine.s is None) == (r.s is None)
        assert r.m is None or mine.m == pytest.approx(r.m, rel=1e-12)
        assert r.s is None or mine.s == pytest.approx(r.s, rel=1e-9, abs=1e-9)


def test_sliding_is_linear_in_dense_series(spark):
    """100,000 readings an hour: a frame of a day holds over two million, each added twice."""
    df = spark.range(3_000_000).select(
        F.lit("a").alias("k"), F.timestamp_micros(F.col("id") * 36_000).cast("timestamp_ntz").alias("t"), (F.col("id") % 7).cast("double").alias("x")
    )
    out = ordered.sliding(df, ["k"], "t", {"x": ("m", "s")}, 23, splits.none(["k"], "t"))
    n, least, most = out.agg(F.count("s"), F.min("m"), F.max("m")).first()
    assert (n, least) == (2_999_999, 0.0) and most == pytest.approx(3.0, abs=1e-3)
