"""Period starts, age in whole days, date texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "MM")


def quarter_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "QUARTER")


def year_start(day: Column | str) -> Column:
    return F.trunc(_col(day), "YEAR")


def week_start(day: Column | str) -> Column:
    """Monday of the week."""
    return F.trunc(_col(day), "WEEK")


def quarter_week(day: Column | str) -> Column:
    """Week start, but never before the start of the quarter."""
    return F.greatest(week_start(day), quarter_start(day))


def iso_date(day: Column | str) -> Column:
    return F.date_format(_col(day), "yyyy-MM-dd")


def iso_midnight(day: Column | str) -> Column:
    return F.concat(iso_date(day), F.lit("T00:00:00Z"))


def whole_days(since: Column | str, as_of: Column) -> Column:
    """Complete 24-hour periods between two timestamps (not calendar days)."""
    return F.timestamp_diff("DAY", _col(since), as_of)


def in_range(day: Column | str, start: Column, excluded_end: Column) -> Column:
    return (_col(day) >= start) & (_col(day) < excluded_end)


def in_month(day: Column | str, start: Column) -> Column:
    return in_range(day, start, F.add_months(start, 1))


def in_quarter(day: Column | str, start: Column) -> Column:
    return in_range(day, start, F.add_months(start, 3))


def in_year(day: Column | str, start: Column) -> Column:
    return in_range(day, start, F.add_months(start, 12))


def in_last_year(stamp: Column | str, as_of: Column) -> Column:
    """Both ends included: from the same day twelve months ago to the day of ``as_of``."""
    return F.to_date(_col(stamp)).between(F.add_months(F.to_date(as_of), -12), F.to_date(as_of))
