"""Calendar keys and month arithmetic."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(column: str | Column) -> Column:
    """yyyyMMdd as int, by arithmetic rather than by formatting and parsing text."""
    value = F.col(column) if isinstance(column, str) else column
    return F.year(value) * 10000 + F.month(value) * 100 + F.dayofmonth(value)


def key_year(column: str) -> Column:
    """The year of a date key."""
    return F.floor(F.col(column) / 10000).cast("int")


def key_month(column: str) -> Column:
    """The month of a date key, 1 to 12."""
    return (F.floor(F.col(column) / 100) % 100).cast("int")


def month_text(year: str, month: str) -> Column:
    """yyyy-MM."""
    return F.format_string("%04d-%02d", F.col(year), F.col(month))


def month_start(year: str, month: str) -> Column:
    """First day of the month; NULL for a month that does not exist."""
    return F.try_to_date(F.format_string("%04d-%02d-01", F.col(year), F.col(month)), "yyyy-MM-dd")


def month_index(year: str | Column, month: str | Column) -> Column:
    """A number that grows by one per month, so that December and January are neighbours."""
    return _col(year) * 12 + _col(month)


def index_year(index: str | Column) -> Column:
    return F.floor((_col(index) - 1) / 12).cast("int")


def index_month(index: str | Column) -> Column:
    return (_col(index) - index_year(index) * 12).cast("int")


def to_second(column: str | Column) -> Column:
    """Cut a timestamp to whole seconds, keeping its type with or without time zone."""
    value = F.col(column) if isinstance(column, str) else column
    return F.date_trunc("second", value)


def moment(value: datetime | Column | None) -> Column:
    """A point in time: a time without zone is one of the session's zone, None is now."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    return F.lit(value) if value.tzinfo else F.lit(value.isoformat(sep=" ")).cast("timestamp")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
