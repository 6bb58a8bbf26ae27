"""Scalars with pinned semantics, all from built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column | str) -> Column:
    """A double as decimal(18,4), so sums do not depend on the order of addition."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,4)")


def exact_sum(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double")


def exact_avg(c: Column | str) -> Column:
    return F.sum(money(c)).cast("double") / F.count(c)


def half_up(c: Column, places: int) -> Column:
    """Rounded half away from zero in decimal, not in binary."""
    return F.round(c.cast("decimal(28,8)"), places).cast("double")


def weekday(c: Column) -> Column:
    """0 for Sunday to 6."""
    return (F.dayofweek(c) - 1).cast("long")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
