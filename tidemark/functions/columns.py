"""Small column expressions shared by the operators. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: str | Column) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    c = col(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def strict_sum(c: str | Column) -> Column:
    """Sum that is NULL as soon as one row of the group is NULL: no partial totals."""
    c = col(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL unless the denominator is positive."""
    return F.when(col(den) > 0, col(num) / col(den))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def all_of(conds) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def any_of(conds) -> Column:
    return reduce(lambda a, b: a | b, conds, F.lit(False))


def micros(c: str | Column) -> Column:
    """Microseconds since the epoch (exact integers, so interval arithmetic has no rounding)."""
    return F.unix_micros(col(c).cast("timestamp"))


def day(c: str | Column) -> Column:
    """`YYYY-MM-DD` string of a timestamp, the form partitions use."""
    return F.date_format(col(c), "yyyy-MM-dd")


def last_day(c: str | Column) -> Column:
    """Largest `YYYY-MM-DD` of a group, compared as a date: a fixed-width buffer keeps the aggregate hashed."""
    return F.date_format(F.max(col(c).try_cast("date")), "yyyy-MM-dd")


def first_day(c: str | Column) -> Column:
    return F.date_format(F.min(col(c).try_cast("date")), "yyyy-MM-dd")


def version_key(c: str | Column) -> Column:
    """Numeric order for dotted versions: `1.10` sorts after `1.9`."""
    return F.transform(F.split(col(c), r"\."), lambda p: p.try_cast("int"))


def version_at_least(c: str | Column, minimum: str) -> Column:
    parts = [int(p) for p in minimum.split(".")]
    return version_key(c) >= F.array(*[F.lit(p) for p in parts])


def chain(cases, otherwise=None) -> Column:
    """First matching case wins: `cases` is a sequence of (condition, value)."""
    out = None
    for cond, value in cases:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(cond, value) if out is None else out.when(cond, value)
    if out is None:
        return F.lit(otherwise)
    return out if otherwise is None else out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))
