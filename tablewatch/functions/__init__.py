"""Column expressions shared by the operators."""

from tablewatch.functions.checks import (
    BLANK,
    FAIL,
    PASS,
    any_equals,
    equal_flag,
    freshness_flag,
    match_flag,
    type_length_flag,
)
from tablewatch.functions.columns import extract_paths, lower_columns, prefixed, typed_null
from tablewatch.functions.time import (
    as_of_date,
    as_of_ts,
    hours_before,
    load_time,
    previous_day,
    to_datetime,
)

__all__ = [
    "BLANK",
    "FAIL",
    "PASS",
    "any_equals",
    "as_of_date",
    "as_of_ts",
    "equal_flag",
    "extract_paths",
    "freshness_flag",
    "hours_before",
    "load_time",
    "lower_columns",
    "match_flag",
    "prefixed",
    "previous_day",
    "to_datetime",
    "type_length_flag",
    "typed_null",
]
