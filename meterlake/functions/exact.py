"""Sums, averages and rounding that do not depend on row order.

Adding doubles in another order changes the last digits, so totals would differ
between runs, retries and partitionings.  A value is therefore added as
DECIMAL(18,7), which fits a long, where that keeps it to a millionth.  What the
decimal leaves over, at most half a unit of its last place, is added beside it as a
double: its own rounding lies some nine digits below the last one of a sum, so
nothing is cut and the order still does not show.  Very large, very small and
non-finite values go to the second lane whole.  So sums take any input and means
cover the rows they count.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(18,7)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lanes(c) -> tuple[Column, Column]:
    """The value as a decimal where that is close to it, and as a double the rest, or elsewhere all of it."""
    x = _col(c).cast("double")
    d = x.try_cast(DECIMAL)
    left = x - d.cast("double")
    close = F.coalesce(F.abs(left) <= F.abs(x) * 1e-6, F.lit(False))
    return F.when(close, d), F.when(close, left).otherwise(x)


def joined(exact_part: Column, rest: Column) -> Column:
    """Sum of both lanes; NULL if neither holds a value."""
    s = exact_part.cast("double")
    return F.coalesce(s + rest, s, rest)


def exact_sum(c) -> Column:
    d, x = lanes(c)
    return joined(F.sum(d), F.sum(x))


def exact_over(c, window) -> Column:
    """Sum over a window."""
    d, x = lanes(c)
    return joined(F.sum(d).over(window), F.sum(x).over(window))


def exact_avg(c) -> Column:
    return F.try_divide(exact_sum(c), F.count(_col(c)))


def rounded(c, digits: int) -> Column:
    """Half away from zero on the double itself."""
    x, scale = _col(c), float(10**digits)
    near = F.signum(x) * F.floor(F.abs(x) * scale + 0.5) / scale + F.lit(0.0)
    # From 2**52 on, and for infinities, there is nothing to round and a long may not hold it.
    return F.when(F.abs(x) * scale >= float(2**52), x.cast("double")).otherwise(near)


def percentage(part, whole, digits: int | None = 2) -> Column:
    p = F.try_divide(_col(part).cast("double") * 100.0, _col(whole))
    return p if digits is None else rounded(p, digits)


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def safe_divide(num, den, default: float = 0.0) -> Column:
    """num/den; ``default`` where den is zero; NULL where either is NULL."""
    n, d = _col(num), _col(den)
    return F.when(d != 0, n / d).when(d == 0, F.lit(default))


def clip(c, low=None, high=None) -> Column:
    """Bounded value.  NULL stays NULL, which least/greatest would not keep."""
    x = _col(c)
    out = x
    if high is not None:
        out = F.when(x > high, F.lit(float(high))).otherwise(out)
    if low is not None:
        out = F.when(x < low, F.lit(float(low))).otherwise(out)
    return out


def out_of_range(c, low=None, high=None) -> Column:
    """True outside the closed range; NULL counts as inside."""
    x = _col(c)
    cond = F.lit(False)
    if low is not None:
        cond = cond | (x < low)
    if high is not None:
        cond = cond | (x > high)
    return F.coalesce(cond, F.lit(False))


def growth_percent(now, before) -> Column:
    return F.try_divide(_col(now) - _col(before), _col(before)) * 100.0
