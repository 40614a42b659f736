"""Null-safe helpers: a missing value is NULL, never NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Number = Column | float | int | str


def col(x: Number) -> Column:
    """A column by name, a literal double, or the column itself."""
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(float(x))


def missing(x: Number) -> Column:
    """NaN to NULL."""
    return F.when(~F.isnan(col(x)), col(x))


def clip(x: Number, low: Number | None = None, high: Number | None = None) -> Column:
    """Bounds that keep NULL, unlike greatest and least."""
    x = col(x)
    out = x
    if low is not None:
        out = F.greatest(out, col(low))
    if high is not None:
        out = F.least(out, col(high))
    return F.when(x.isNotNull(), out)


def ratio(a: Number, b: Number) -> Column:
    """a / b, NULL where b is 0."""
    return F.try_divide(col(a), F.when(col(b) != 0, col(b)))


def acos(x: Number) -> Column:
    return F.acos(clip(x, -1.0, 1.0))


def hash_uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 32 bits of the md5 of the parts, the same under any partitioning."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
