"""Numeric scalar functions: coercion, ranges, guarded ratios."""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def round_half_up(c: Column | str, digits: int = 6) -> Column:
    """Rounding by plain double arithmetic.

    The small offset keeps values that end exactly in half a unit from tipping
    either way with the last bit of a sum.
    """
    unit = F.lit(float(10**digits))
    return F.floor(col(c) * unit + F.lit(0.5001)) / unit


def to_number(c: Column | str) -> Column:
    """Text or number to double; text that is not a plain number (`nan`, `3d`, `inf`) is null, and
    so are NaN and the infinities."""
    text = col(c).cast("string")
    return F.when(text.rlike(_NUMBER), F.btrim(text).try_cast("double"))


def number_in(df: DataFrame, c: str) -> Column:
    """to_number() of a column of the frame. A column of numbers is not written as text and read again."""
    kind = dict(df.dtypes).get(c)
    if kind == "double":
        return F.when(F.abs(col(c)) < F.lit(math.inf), col(c))
    return col(c).cast("double") if kind in ("tinyint", "smallint", "int", "bigint") else to_number(c)


def between_or_null(c: Column | str, low=None, high=None) -> Column:
    """Value inside the bounds, null outside."""
    c = col(c)
    inside = F.lit(True)
    if low is not None:
        inside = inside & (c >= F.lit(low))
    if high is not None:
        inside = inside & (c <= F.lit(high))
    return F.when(inside, c)


def clip(c: Column | str, low, high) -> Column:
    c = col(c)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num / den as double, `default` when the denominator is zero or null."""
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(default))


def flag(condition: Column) -> Column:
    """Condition to 0/1, where an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def any_flag(names: Sequence[str]) -> Column:
    """1 when at least one of the 0/1 columns is set."""
    total = sum((col(n) for n in names[1:]), col(names[0]))
    return (total > 0).cast("int")


def width_bucket(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based fixed-width bin; the last bin includes its upper edge."""
    width = (high - low) / F.lit(float(bins))
    raw = F.when(width > 0, F.floor((value - low) / width)).otherwise(F.lit(0))
    return F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1)).cast("int")
