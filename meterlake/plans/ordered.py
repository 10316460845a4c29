"""Ordered, per-group operators that stay bounded when one group is huge.

Each has two forms with the same result.  Without hot groups it is one window
over ``keys``.  With them, windows run over ``(keys, slice)`` and the part that
crosses a slice border is added from a small table of slice summaries, or, for
frames of a fixed number of rows, from copied border rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from meterlake.plans.joins import attach_to_rows
from meterlake.plans.splits import SLICE, Splits, measure, null_safe
from meterlake.plans.staging import stage

FIRST, LAST = Window.unboundedPreceding, Window.unboundedFollowing


def _spec(keys, order) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def _attach(df: DataFrame, summary: DataFrame, keys) -> DataFrame:
    """Join slice summaries: at most two rows per hot-group slice, hence broadcast."""
    names = [f"_s{i}" for i in range(len(keys) + 1)]
    renamed = summary
    for old, new in zip((*keys, SLICE), names):
        renamed = renamed.withColumnRenamed(old, new)
    on = null_safe(df, renamed, zip((*keys, SLICE), names))
    return df.join(F.broadcast(renamed), on, "left").drop(*names)


def running(
    df: DataFrame,
    keys,
    order,
    sums: dict[str, Column],
    splits: Splits,
    totals: dict[str, Column] | None = None,
) -> DataFrame:
    """Running sums from the group's first row to the current one, in ``order``.

    ``totals`` are sums over the whole group.
    """
    keys, totals = list(keys), totals or {}

    def plain(rows: DataFrame) -> DataFrame:
        w = _spec(keys, order).rowsBetween(FIRST, 0)
        whole = Window.partitionBy(*keys)
        return rows.withColumns(
            {n: F.sum(c).over(w) for n, c in sums.items()}
            | {n: F.sum(c).over(whole) for n, c in totals.items()}
        )

    if not splits.any:
        return plain(df)

    hot = splits.hot(df, order)
    w = _spec([*keys, SLICE], order).rowsBetween(FIRST, 0)
    own = hot.withColumns({n: F.sum(c).over(w) for n, c in sums.items()})
    per_slice = hot.groupBy(*keys, SLICE).agg(
        *[F.sum(c).alias(f"_sum_{n}") for n, c in sums.items()],
        *[F.sum(c).alias(f"_all_{n}") for n, c in totals.items()],
    )
    before = _spec(keys, [SLICE]).rowsBetween(FIRST, -1)
    whole = Window.partitionBy(*keys)
    summary = per_slice.select(
        *keys,
        SLICE,
        *[F.sum(f"_sum_{n}").over(before).alias(f"_pre_{n}") for n in sums],
        *[F.sum(f"_all_{n}").over(whole).alias(f"_tot_{n}") for n in totals],
    )
    joined = _attach(own, summary, keys)
    out = {}
    for n in sums:
        out[n] = F.when(F.col(f"_pre_{n}").isNull(), F.col(n)).otherwise(
            F.coalesce(F.col(n), F.col(f"_pre_{n}") * 0) + F.col(f"_pre_{n}")
        )
    out |= {n: F.col(f"_tot_{n}") for n in totals}
    drop = [f"_pre_{n}" for n in sums] + [f"_tot_{n}" for n in totals] + [SLICE]
    return plain(splits.cold(df)).unionByName(joined.withColumns(out).drop(*drop))


def rank_desc(df: DataFrame, keys, value: str, name: str, splits: Splits) -> DataFrame:
    """RANK by ``value`` descending, NULLs last.

    With hot groups the rank is counted: equal values become one row with their
    number, the rows with greater values are a running sum over those, and each row looks
    up its value.  So a value that most rows share is one row.
    """
    keys = list(keys)
    if not splits.any:
        return df.withColumn(name, F.rank().over(_spec(keys, [F.col(value).desc_nulls_last()])))
    counted = stage(df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    v = F.col(value)
    # NaN is the greatest value; NULL comes last.
    place = F.when(v.isNull(), 2).when(F.isnan(v.cast("double")), 0).otherwise(1)
    keyed = counted.withColumns({"_place": place, "_down": F.when(place == 1, -v)})
    upto = running(keyed, keys, ["_place", "_down"], {"_upto": F.col("_n")}, measure(keyed, keys, "_down", splits.policy))
    names = [f"_g{i}" for i in range(len(keys) + 1)]
    ranks = upto.select(
        *[F.col(c).alias(n) for c, n in zip((*keys, value), names)], (F.col("_upto") - F.col("_n") + 1).alias("_rank"), "_n"
    )
    # Values of very many rows are few, so their rows stay where they are.
    total = counted.agg(F.sum("_n")).first()[0] or 0
    many = F.col("_n") > max(splits.policy.min_rows // 8, total // splits.policy.max_groups)
    ranks = stage(ranks, "value-ranks")
    frequent = F.broadcast(ranks.filter(many).drop("_n"))  # at most max_groups rows
    pairs = list(zip((*keys, value), names))
    found = df.join(frequent, null_safe(df, frequent, pairs), "left").drop(*names)
    rest = found.filter("_rank IS NULL").drop("_rank")
    seldom = ranks.filter(~many).drop("_n")
    looked_up = rest.join(seldom, null_safe(rest, seldom, pairs), "left").drop(*names)
    return found.filter("_rank IS NOT NULL").unionByName(looked_up).withColumnRenamed("_rank", name)


def fill(
    df: DataFrame, keys, order, columns, splits: Splits, backward: bool = True
) -> DataFrame:
    """Forward fill within each group, then backward fill for what is left.

    What a forward fill leaves open lies before the group's first value, so the
    backward fill is that value.  A frame from the current row to the end would
    give the same, but rescans the rest of the group for every row.
    """
    keys, columns = list(keys), list(columns)

    def up(c, w):
        return F.last(c, ignorenulls=True).over(w.rowsBetween(FIRST, 0))

    def down(c, w):
        return F.first(c, ignorenulls=True).over(w.rowsBetween(FIRST, LAST))

    def plain(rows: DataFrame) -> DataFrame:
        w = _spec(keys, order)
        return rows.withColumns(
            {c: F.coalesce(up(c, w), down(c, w)) if backward else up(c, w) for c in columns}
        )

    if not splits.any:
        return plain(df)

    hot = splits.hot(df, order)
    at = F.struct(*order)
    per_slice = hot.groupBy(*keys, SLICE).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_last_{c}") for c in columns],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_first_{c}") for c in columns],
    )
    before = _spec(keys, [SLICE]).rowsBetween(FIRST, -1)
    after = _spec(keys, [SLICE]).rowsBetween(1, LAST)
    summary = per_slice.select(
        *keys,
        SLICE,
        *[F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_pre_{c}") for c in columns],
        *[F.first(f"_first_{c}", ignorenulls=True).over(after).alias(f"_post_{c}") for c in columns],
    )
    w = _spec([*keys, SLICE], order)
    own = hot.withColumns(
        {f"_up_{c}": up(c, w) for c in columns} | {f"_down_{c}": down(c, w) for c in columns}
    )
    joined = _attach(own, summary, keys)
    sources = ("_up_", "_pre_", "_down_", "_post_") if backward else ("_up_", "_pre_")
    drop = [f"{p}{c}" for c in columns for p in ("_up_", "_down_", "_pre_", "_post_")]
    filled = joined.withColumns(
        {c: F.coalesce(*[f"{p}{c}" for p in sources]) for c in columns}
    ).drop(*drop, SLICE)
    return plain(splits.cold(df)).unionByName(filled)


def frames(
    df: DataFrame,
    keys,
    order,
    exprs: dict[str, Callable[[WindowSpec], Column]],
    splits: Splits,
    before: int = 0,
    after: int = 0,
    slab: int = 1_000_000,
) -> DataFrame:
    """Window expressions that look at most ``before``/``after`` rows away.

    ``exprs`` maps an output name to a function of the window (partitioned and
    ordered, without a frame).  Rows of hot groups are numbered, cut into slabs
    of equal row count, and the rows near a border are copied to the neighbour,
    so that each slab sees its whole frame.
    """
    keys = list(keys)
    plain = {n: f(_spec(keys, order)) for n, f in exprs.items()}
    if not splits.any:
        return df.withColumns(plain)

    slab = max(slab, before, after, 1)
    numbered = running(splits.hot_rows(df), keys, order, {"_pos": F.lit(1)}, splits)
    at, here = F.col("_pos") - 1, F.col("_slab")
    numbered = numbered.withColumn("_slab", F.floor(at / slab))
    homes = F.array_compact(
        F.array(
            here,
            F.when(at % slab >= slab - before, here + 1) if before else F.lit(None).cast("long"),
            F.when((at % slab < after) & (here > 0), here - 1)
            if after
            else F.lit(None).cast("long"),
        )
    )
    spread = numbered.withColumn("_home", F.explode(homes))
    w = _spec([*keys, "_home"], order)
    hot = (
        spread.withColumns({n: f(w) for n, f in exprs.items()})
        .filter(F.col("_home") == F.col("_slab"))
        .drop("_home", "_slab", "_pos")
    )
    return splits.cold(df).withColumns(plain).unionByName(hot)


def sliding(
    df: DataFrame, keys, time: str, columns: dict[str, tuple[str, str]], hours: int, splits: Splits
) -> DataFrame:
    """Mean and sample deviation over the last ``hours`` of each group, both ends included.

    ``columns`` maps a column to the names of the two.  The clock is cut into blocks as long as the
    span.  A frame that ends in a block is then the block's rows up to its end, and the rows of the
    block before from its start on.  Those are copied, narrow and one span later, so both parts are
    running aggregates, one forwards and one backwards: each row is added twice, however many its
    frame holds.  Nothing is subtracted, so a large value leaves no trace in frames it is not in.

    A long series is cut by the clock, so it never lies in one task.  Readings without a time have
    each other as their frame; with hot groups that is an aggregate they look up.
    """
    keys, span = list(keys), hours * 3_600_000_000
    if not splits.any:
        return _blocks(df, keys, time, columns, span)
    timeless = df.filter(F.col(time).isNull())
    figures = [f(c).alias(n) for c, names in columns.items() for f, n in zip((F.avg, F.stddev_samp), names)]
    told = attach_to_rows(timeless, timeless.groupBy(*keys).agg(*figures), keys, null_keys=True)
    return _blocks(df.filter(F.col(time).isNotNull()), keys, time, columns, span).unionByName(told)


def _blocks(df: DataFrame, keys, time: str, columns: dict[str, tuple[str, str]], span: int) -> DataFrame:
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = df.withColumns({"_at": at, "_copy": F.lit(False)} | {f"_v_{c}": F.col(c).cast("double") for c in columns})
    rows = rows.withColumn("_block", F.floor(F.col("_at") / span) if span else F.col("_at"))
    if span:
        kept = {*keys, *(f"_v_{c}" for c in columns)}
        copies = rows.filter("_at IS NOT NULL").select(
            *[F.col(c) if c in kept else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns if c not in ("_at", "_copy", "_block")],
            (F.col("_at") + span).alias("_at"),
            F.lit(True).alias("_copy"),
            (F.col("_block") + 1).alias("_block"),
        )
        rows = rows.unionByName(copies)
    block = Window.partitionBy(*keys, "_block")
    sides = {
        "f": (block.orderBy(F.col("_at").asc()).rangeBetween(FIRST, 0), ~F.col("_copy")),
        "b": (block.orderBy(F.col("_at").desc()).rangeBetween(FIRST, 0), F.col("_copy")),
    }
    running_ = {}
    for side, (w, mine) in sides.items():
        for c in columns:
            x = F.when(mine, F.col(f"_v_{c}"))
            running_ |= {f"_{side}{n}_{c}": f(x).over(w) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_pop))}
    framed = rows.withColumns(running_).filter(~F.col("_copy"))
    return framed.select(
        *df.columns,
        *[e.alias(n) for c, names in columns.items() for e, n in zip(_merged(c), names)],
    )


def _merged(c: str) -> tuple[Column, Column]:
    """Mean and sample deviation of two sets together, from count, mean and variance of each."""
    (n, m, v), (k, q, u) = [[F.col(f"_{side}{x}_{c}") for x in "nmv"] for side in "fb"]
    total = n + k
    m, q = F.coalesce(m, q), F.coalesce(q, m)  # an empty set has the mean of the other
    v, u = F.coalesce(v, F.lit(0.0)), F.coalesce(u, F.lit(0.0))
    mean = m + (q - m) * (k / total)
    squares = n * v + k * u + (q - m) * (q - m) * (n * (k / total))
    return F.when(total > 0, mean), F.when(total > 1, F.sqrt(squares / (total - 1)))
