"""Conversions between epoch numbers and text. All follow the session time zone."""

from pyspark.sql import functions as F

from .values import whole_div

DATE = "yyyy-MM-dd"
DATETIME = "yyyy-MM-dd HH:mm:ss"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def ms_to_date(ms):
    return F.date_format(F.timestamp_millis(_col(ms)), DATE)


def ms_to_datetime(ms):
    return F.date_format(F.timestamp_millis(_col(ms)), DATETIME)


def date_to_ms(text):
    """Start of the day in milliseconds; null when the text is not a date."""
    return F.unix_millis(F.try_to_timestamp(_col(text), F.lit(DATE)))


def datetime_to_ms(text):
    """Milliseconds of a date and time; null when the text is not one."""
    return F.unix_millis(F.try_to_timestamp(_col(text), F.lit(DATETIME)))


def clock_to_number(text, unit="seconds"):
    """`H:M:S` as seconds or milliseconds; null unless it has three whole numbers."""
    parts = F.split(_col(text), ":")

    def part(i):
        return F.get(parts, F.lit(i)).try_cast("bigint")

    seconds = F.when(
        F.size(parts) == 3, part(0) * 3600 + part(1) * 60 + part(2)
    )
    return seconds if unit == "seconds" else seconds * 1000


def number_to_clock(number, unit="seconds"):
    """Seconds or milliseconds as `HH:MM:SS`; the hours go on past 24."""
    seconds = _col(number).cast("bigint")
    if unit != "seconds":
        seconds = whole_div(seconds, 1000)
    text = F.format_string(
        "%02d:%02d:%02d",
        whole_div(seconds, 3600),
        whole_div(seconds % 3600, 60),
        seconds % 60,
    )
    return F.when(seconds.isNotNull(), text)
