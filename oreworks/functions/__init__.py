from oreworks.functions.expressions import (
    cap_category,
    days_between,
    exact_sum,
    percent_of,
    ts_literal,
    utc_timestamp,
    utc_timestamp_sql,
)
from oreworks.functions.momentum import momentum, register_momentum

__all__ = [
    "cap_category",
    "days_between",
    "exact_sum",
    "momentum",
    "percent_of",
    "register_momentum",
    "ts_literal",
    "utc_timestamp",
    "utc_timestamp_sql",
]
