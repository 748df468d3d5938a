"""Scalar column helpers. All of them build JVM-side expressions (no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def pick(values: Sequence[str], index: Column) -> Column:
    """``values[index]`` for a 0-based integer column (a CASE over a modulo).

    Built as ``element_at(array(...), index + 1)`` so the lookup is one
    expression instead of a chain of WHEN branches.
    """
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def dec(text: str) -> Column:
    """A decimal literal (never routed through a Python float)."""
    return F.lit(Decimal(text))


def date_plus_days(date_text: str, days: Column) -> Column:
    """``DATE 'x' + INTERVAL n DAY`` as a midnight TIMESTAMP_NTZ."""
    return F.date_add(F.to_date(F.lit(date_text)), days.cast("int")).cast("timestamp_ntz")


def timestamp_plus_seconds(ts_text: str, seconds: Column) -> Column:
    """``TIMESTAMP 'x' + INTERVAL n SECOND`` as TIMESTAMP_NTZ."""
    base = F.lit(ts_text).cast("timestamp_ntz")
    return F.timestamp_add("SECOND", seconds, base)


def gap_exceeds(ts: Column, prev: Column, gap_seconds: int) -> Column:
    """``ts - prev > interval`` with SQL three-valued logic (NULL if either is NULL)."""
    return (ts - prev) > F.make_dt_interval(secs=F.lit(gap_seconds))


def micros_between(start: Column, end: Column) -> Column:
    """``end - start`` in microseconds, independent of the session time zone.

    Subtracting two TIMESTAMP_NTZ values gives a day-time interval on wall
    clock values; its fields are summed exactly. (Functions that cast
    TIMESTAMP_NTZ to TIMESTAMP would pass through the session zone, where a
    DST gap makes the mapping non-monotonic.)
    """
    d = end - start
    whole = (F.extract(F.lit("DAY"), d).cast("long") * 86_400_000_000
             + F.extract(F.lit("HOUR"), d).cast("long") * 3_600_000_000
             + F.extract(F.lit("MINUTE"), d).cast("long") * 60_000_000)
    return whole + (F.extract(F.lit("SECOND"), d) * 1_000_000).cast("long")
