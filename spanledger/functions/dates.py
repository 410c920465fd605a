"""Date literals, calendar rules and month arithmetic. No clock is ever read."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DateLike = dt.date | str
TimeLike = dt.datetime | str


def date_lit(value: DateLike | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    text = value if isinstance(value, str) else value.strftime("%Y-%m-%d")
    return F.lit(text).cast("date")


def ts_lit(value: TimeLike | Column, data_type: T.DataType | str = "timestamp") -> Column:
    """A timestamp literal of the wanted flavour (with or without time zone).

    It goes through text, so neither the Python nor the JVM default zone can
    shift it; the session time zone decides for zoned types.
    """
    if isinstance(value, Column):
        return value.cast(data_type)
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast(data_type)


def interval(amount: int, unit: str) -> Column:
    units = {"hour": "hours", "day": "days", "month": "months", "year": "years"}
    if unit not in units:
        raise ValueError(f"unknown interval unit: {unit!r}")
    return F.make_interval(**{units[unit]: F.lit(amount)})


def month_start(d: str | Column) -> Column:
    return F.trunc(d, "month")


def month_end(d: str | Column) -> Column:
    return F.last_day(d)


def period_key(d: str | Column) -> Column:
    """``yyyyMM`` text of a date."""
    return F.date_format(d, "yyyyMM")


def lag_period(run_date: DateLike | Column) -> Column:
    """Period key of the day before ``run_date``."""
    return period_key(F.date_sub(date_lit(run_date), 1))


def get_dates(kind: str, run_date: DateLike | Column) -> Column:
    today = date_lit(run_date)
    if kind == "today":
        return today
    if kind == "yesterday":
        return F.date_sub(today, 1)
    if kind == "lag_period":
        return lag_period(today)
    raise ValueError(f"kind must be 'today', 'yesterday' or 'lag_period', not {kind!r}")


def first_working_day(d: str | Column) -> Column:
    """First Monday-to-Friday day of the month of ``d`` (holidays are ignored)."""
    first = month_start(d)
    # weekday(): Monday is 0, so Saturday needs 2 more days and Sunday 1.
    days_to_monday = F.when(F.weekday(first) < 5, F.lit(0)).otherwise(F.lit(7) - F.weekday(first))
    return F.date_add(first, days_to_monday)


def is_first_working_day(d: str | Column, allow_manual: bool = True) -> Column:
    """True on that day; a NULL date counts as a manual run when allowed."""
    day = (F.col(d) if isinstance(d, str) else d).cast("date")
    hit = day == first_working_day(day)
    return F.coalesce(hit, F.lit(True)) if allow_manual else hit


def month_number(d: Column) -> Column:
    """Months since year 0, so differences count calendar months."""
    return F.year(d) * 12 + F.month(d)


def spine_step_from(start: Column, d: Column) -> Column:
    """Smallest k with ``start + k months >= d``."""
    k = month_number(d) - month_number(start)
    return F.when(F.add_months(start, k) < d, k + 1).otherwise(k)


def spine_step_until(start: Column, d: Column) -> Column:
    """Largest k with ``start + k months <= d``."""
    k = month_number(d) - month_number(start)
    return F.when(F.add_months(start, k) > d, k - 1).otherwise(k)
