"""Trading-calendar column functions.

All of them are built-in expressions (no Python per row), so they stay inside
whole-stage code generation where Spark allows it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import FIRST_OFFSET_DAYS, HOLIDAYS


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_holiday(d: Column | str) -> Column:
    """month-day in the fixed holiday list, any year."""
    return F.date_format(_c(d), "MM-dd").isin(list(HOLIDAYS))


def is_weekend(d: Column | str) -> Column:
    """Saturday or Sunday (``weekday`` is 0 for Monday)."""
    return F.weekday(_c(d)) >= 5


def is_trading_day(d: Column | str) -> Column:
    return ~is_weekend(d) & ~is_holiday(d)


def weekday_name(d: Column | str) -> Column:
    """short weekday name (Mon, Tue, ...)."""
    return F.date_format(_c(d), "E")


def weekday_number(d: Column | str) -> Column:
    """weekday number, 1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(d))


def minute_stamp(ts: Column | str) -> Column:
    """timestamp text to the minute with seconds forced to 00 (calendar year, not week-year)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:00")


def next_trading_days_sql(as_of: str, n: int, first_offset_days: int = FIRST_OFFSET_DAYS) -> str:
    """SQL text of :func:`next_trading_days` for a column name or SQL expression ``as_of``."""
    hol = ", ".join(f"'{h}'" for h in HOLIDAYS)
    lo, hi = first_offset_days, first_offset_days + 2 * n + 30
    return (
        f"slice(filter(sequence(date_add({as_of}, {lo}), date_add({as_of}, {hi})), "
        f"d -> weekday(d) < 5 AND NOT date_format(d, 'MM-dd') IN ({hol})), 1, {n})"
    )


def next_trading_days(as_of: Column | str, n: int, first_offset_days: int = FIRST_OFFSET_DAYS) -> Column:
    """array of the next ``n`` trading days, first candidate ``as_of + first_offset_days``.

    Over-generates 2n + 30 calendar days (each week has 5 weekdays and at most
    9 holidays fall in a year, so this always holds n trading days), filters
    weekends and holidays, and keeps the first n.
    """
    if isinstance(as_of, str):
        return F.expr(next_trading_days_sql(as_of, n, first_offset_days))
    start = F.date_add(as_of, first_offset_days)
    days = F.sequence(start, F.date_add(start, 2 * n + 30))
    trading = F.filter(days, lambda d: (F.weekday(d) < 5) & ~F.date_format(d, "MM-dd").isin(list(HOLIDAYS)))
    return F.slice(trading, 1, n)
