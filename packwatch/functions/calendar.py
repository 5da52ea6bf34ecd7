"""Run-date parameters: each job takes one ``as_of`` and derives its half-open range."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone


def _day(as_of: date | datetime) -> date:
    return as_of.date() if isinstance(as_of, datetime) else as_of


def previous_hour(as_of: datetime) -> tuple[datetime, datetime]:
    end = as_of.replace(minute=0, second=0, microsecond=0)
    return end - timedelta(hours=1), end


def previous_day(as_of: date | datetime) -> tuple[date, date]:
    end = _day(as_of)
    return end - timedelta(days=1), end


def previous_week(as_of: date | datetime) -> tuple[date, date]:
    """Monday to Monday of the last full week before ``as_of``."""
    end = _day(as_of) - timedelta(days=_day(as_of).weekday())
    return end - timedelta(days=7), end


def previous_month(as_of: date | datetime) -> str:
    """``yyyy-MM`` of the calendar month before ``as_of``."""
    return (_day(as_of).replace(day=1) - timedelta(days=1)).strftime("%Y-%m")


def month_range(as_of: date | datetime) -> tuple[date, date]:
    """From the last day of the previous month up to, not including, ``as_of``."""
    return _day(as_of).replace(day=1) - timedelta(days=1), _day(as_of)


def day_micros(day: date) -> int:
    """Epoch microseconds of the start of the day, UTC."""
    start = datetime.combine(day, time(), timezone.utc)
    return (start - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
