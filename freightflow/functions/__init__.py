from .time import (
    clock_to_number,
    date_to_ms,
    datetime_to_ms,
    ms_to_date,
    ms_to_datetime,
    number_to_clock,
)
from .values import as_double, as_long, is_blank, json_row, whole_div

__all__ = [
    "as_double",
    "as_long",
    "clock_to_number",
    "date_to_ms",
    "datetime_to_ms",
    "is_blank",
    "json_row",
    "ms_to_date",
    "ms_to_datetime",
    "number_to_clock",
    "whole_div",
]
