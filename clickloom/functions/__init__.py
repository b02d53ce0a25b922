"""Scalar column expressions: text, time, numbers."""

from clickloom.functions.numbers import ratio_half_up, round_half_up
from clickloom.functions.text import (
    is_empty,
    is_not_empty,
    lists_overlap,
    packed_get,
    packed_set,
    pad_two,
    split_list,
    trim_comma,
)
from clickloom.functions.times import (
    as_timestamp,
    date_hour,
    day_key,
    format_date,
    format_time,
    is_after,
    is_before,
    minute_key,
    parse_day_key,
    parse_time,
    seconds_between,
    split_minute_key,
    today,
    yesterday,
)

__all__ = [
    "as_timestamp",
    "date_hour",
    "day_key",
    "format_date",
    "format_time",
    "is_after",
    "is_before",
    "is_empty",
    "is_not_empty",
    "lists_overlap",
    "minute_key",
    "packed_get",
    "packed_set",
    "pad_two",
    "parse_day_key",
    "parse_time",
    "ratio_half_up",
    "round_half_up",
    "seconds_between",
    "split_list",
    "split_minute_key",
    "today",
    "trim_comma",
    "yesterday",
]
