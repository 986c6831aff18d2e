"""Date column expressions.

``as_of`` is always an explicit argument (never ``current_date()``) so that a
check gives the same answer when re-run.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.constants import CHECK_LABEL, MONTH_NAMES_PT
from ledgerlens.functions._util import as_col, as_date, to_date_value


def as_of_column(as_of) -> Column:
    """The run date as a DATE literal."""
    return as_date(as_of)


def base_date_shift(date, days: int = 1) -> Column:
    """``date + days`` (constant-folded for a literal date)."""
    return F.date_add(as_date(date), days)


def days_overdue(due, as_of) -> Column:
    """Calendar days from ``due`` to ``as_of`` (day boundaries crossed, like a DAY date diff).

    The two-argument ``datediff(end, start)`` counts calendar days; NULL due stays NULL.
    """
    return F.datediff(as_date(as_of), as_col(due))


def days_to_due(due, as_of) -> Column:
    """Calendar days from ``as_of`` to ``due`` (positive while not yet due)."""
    return F.datediff(as_col(due), as_date(as_of))


def days_overdue_floor(due, as_of) -> Column:
    """0 when ``due >= as_of``, else the days overdue. NULL due stays NULL (not ``greatest``)."""
    due = as_col(due)
    return F.when(due >= as_date(as_of), F.lit(0)).otherwise(days_overdue(due, as_of))


def year_month(date) -> tuple[Column, Column]:
    d = as_col(date)
    return F.year(d), F.month(d)


def month_name_pt(date=None, *, month=None) -> Column:
    """Portuguese month name of a date (or of a month number); else ``VERIFICAR``."""
    m = F.month(as_col(date)) if month is None else as_col(month)
    names = F.array(*[F.lit(n) for n in MONTH_NAMES_PT])
    in_range = (m >= 1) & (m <= 12)
    return F.when(in_range, F.element_at(names, m)).otherwise(F.lit(CHECK_LABEL))


def weekend_flag(date) -> Column:
    """Saturday or Sunday; ``dayofweek`` numbers Sunday = 1 .. Saturday = 7."""
    return F.dayofweek(as_col(date)).isin(1, 7)


def weekday_name(date, labels: dict[str, str] | None = None) -> Column:
    """English weekday name (``Saturday``); ``labels`` maps it to another language."""
    name = F.date_format(as_col(date), "EEEE")
    if not labels:
        return name
    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(m, name), name)


def holiday_flag(date, holidays: Iterable) -> Column:
    """Date (cast to DATE) is one of ``holidays`` (a literal set: an ``InSet`` check)."""
    days = sorted({to_date_value(h) for h in holidays})
    return as_col(date).cast("date").isin(*days)


def month_end_exclude(date, days: int = 3) -> Column:
    """True unless the date is within the last ``days`` days of its month."""
    d = as_col(date)
    return F.dayofmonth(d) <= F.dayofmonth(F.last_day(d)) - days


def date_text(date, pattern: str = "dd/MM/yyyy") -> Column:
    return F.date_format(as_col(date), pattern)
