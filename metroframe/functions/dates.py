"""DT-*: date parsing, parts, month arithmetic and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c) -> Column:
    """DT-1: text to date, null when unparseable (accepts '2024-1-5' and
    '2024-01-05 00:00:00.0')."""
    return _col(c).try_cast("date")


def parse_month(c, fmt: str = "yyyyMM") -> Column:
    """DT-2: year-month text to the first day of that month."""
    return F.try_to_date(_col(c), fmt)


def month_end(c) -> Column:
    """DT-3: last day of the month of ``c``."""
    return F.last_day(_col(c))


def add_months(c, n: int) -> Column:
    """DT-3/DT-4: shift by whole months (clamped to month end)."""
    return F.add_months(_col(c), n)


def previous_month(c) -> Column:
    """DT-4: the same day one month earlier."""
    return F.add_months(_col(c), -1)


def year_month(c) -> tuple[Column, Column]:
    """DT-5: year and month parts."""
    return F.year(_col(c)), F.month(_col(c))


def request_date_text(c) -> Column:
    """STR-12: a date as the 'yyMMdd' partition text."""
    return F.date_format(_col(c), "yyMMdd")


def shift_hours(c, hours: int) -> Column:
    """DT-6: move a timestamp by whole hours (UTC to a fixed local offset)."""
    return _col(c) + F.make_interval(hours=F.lit(hours))
