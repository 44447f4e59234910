"""Tolerant reads of text values and the JSON form of a row."""

from pyspark.sql import functions as F


def as_long(c):
    return F.col(c).try_cast("bigint")


def as_double(c):
    return F.col(c).try_cast("double")


def is_blank(c):
    """Null, empty or white space only."""
    return F.coalesce(F.trim(c.cast("string")) == "", F.lit(True))


def json_row(columns):
    """One JSON object per row; null fields are left out."""
    return F.to_json(F.struct(*columns))


def whole_div(a, b):
    """Division of whole numbers, rounded toward zero."""
    a = F.col(a) if isinstance(a, str) else a
    return F.call_function("div", a, b if not isinstance(b, int) else F.lit(b))
