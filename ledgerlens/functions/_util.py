from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def as_date(d) -> Column:
    """A typed DATE literal from a ``date``/ISO string, or a Column as is."""
    if isinstance(d, Column):
        return d
    if isinstance(d, _dt.datetime):
        d = d.date()
    if isinstance(d, str):
        d = _dt.date.fromisoformat(d)
    return F.lit(d)


def to_date_value(d) -> _dt.date:
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, str):
        return _dt.date.fromisoformat(d)
    return d
