"""Conditional aggregate expressions (the SQL ``FILTER (WHERE ...)`` forms).

Both are partial-aggregation friendly: Spark combines them map-side before
any shuffle, so a hot group costs one row per map task on the wire.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(cond: Column) -> Column:
    """``count(*) FILTER (WHERE cond)``: 0 when no row matches."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def sum_where(value: Column, cond: Column) -> Column:
    """``sum(value) FILTER (WHERE cond)``: NULL when no row matches."""
    return F.sum(F.when(cond, value))


def sum_where_or_zero(value: Column, cond: Column) -> Column:
    """``coalesce(sum(value) FILTER (WHERE cond), 0)``."""
    return F.coalesce(sum_where(value, cond), F.lit(0))
