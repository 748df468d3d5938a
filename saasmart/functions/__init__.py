from saasmart.functions.aggregates import count_where, sum_where, sum_where_or_zero
from saasmart.functions.columns import (
    date_plus_days,
    dec,
    gap_exceeds,
    micros_between,
    pick,
    timestamp_plus_seconds,
)

__all__ = [
    "count_where",
    "sum_where",
    "sum_where_or_zero",
    "date_plus_days",
    "dec",
    "gap_exceeds",
    "micros_between",
    "pick",
    "timestamp_plus_seconds",
]
