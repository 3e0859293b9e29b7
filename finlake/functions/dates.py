"""Date arguments, validated in Python before any plan is built.

Under ANSI mode a bad date literal would fail inside a task; checking up
front gives one clear error instead.
"""
from __future__ import annotations

import datetime as dt


def parse_date(value: str | dt.date) -> dt.date:
    """``YYYY-MM-DD`` (or a ``date``) to a ``date``; ValueError otherwise."""
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def check_month(year: int, month: int) -> None:
    if not 1 <= int(month) <= 12:
        raise ValueError(f"month must be 1..12, got {month}")
    if not 1 <= int(year) <= 9999:
        raise ValueError(f"year out of range: {year}")


def month_bounds(year: int, month: int) -> tuple[dt.date, dt.date]:
    """Half-open range [first day, first day of the next month)."""
    check_month(year, month)
    first = dt.date(int(year), int(month), 1)
    nxt = dt.date(first.year + (first.month == 12), first.month % 12 + 1, 1)
    return first, nxt


def month_key(year: int, month: int) -> str:
    """``YYYY-MM`` label of a month."""
    check_month(year, month)
    return f"{int(year):04d}-{int(month):02d}"
