"""Row predicates shared by the checks.

Each returns a boolean ``Column`` built from plain column comparisons, so that
Catalyst can push it to the Parquet/JDBC scan where the column is a stored one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.constants import REVERSAL_MARKER, UNSETTLED_SENTINEL
from ledgerlens.functions._util import as_col, as_date


def open_as_of(settled, after, *, inclusive: bool, sentinel=UNSETTLED_SENTINEL,
               keep_null: bool = False) -> Column:
    """Row still unsettled relative to ``after``.

    Three variants appear in the audited checks:
      (a) settled >= base + 1 day, or sentinel     -> ``open_as_of(c, base_date_shift(base), inclusive=True)``
      (b) settled >= a date, or sentinel           -> ``inclusive=True``
      (c) settled > base, or sentinel, or NULL     -> ``inclusive=False, keep_null=True``
    """
    s = as_col(settled)
    bound = as_date(after)
    cond = (s >= bound) if inclusive else (s > bound)
    cond = cond | (s == as_date(sentinel))
    if keep_null:
        cond = cond | s.isNull()
    return cond


def code_filter(c, include: Iterable | str | None = None,
                exclude: Iterable | str | None = None) -> Column:
    """Equality / IN / NOT IN on a code column. NULL never passes (SQL three-valued logic)."""
    col = as_col(c)
    cond = None
    if include is not None:
        inc = [include] if isinstance(include, str) else list(include)
        cond = (col == inc[0]) if len(inc) == 1 else col.isin(*inc)
    if exclude is not None:
        exc = [exclude] if isinstance(exclude, str) else list(exclude)
        ex = ~col.isin(*exc)
        cond = ex if cond is None else (cond & ex)
    return F.lit(True) if cond is None else cond


def reversal_exclude(c, marker: str = REVERSAL_MARKER) -> Column:
    """Invoice number does not contain the reversal marker (``NOT LIKE '%EST%'``); NULL drops."""
    return ~as_col(c).contains(marker)


def numeric_threshold(c, more_than) -> Column:
    """Strict ``>``."""
    return as_col(c) > more_than


def in_date_range(c, start=None, end=None) -> Column:
    """Inclusive range on a DATE column; either bound may be omitted."""
    col = as_col(c)
    cond = F.lit(True)
    if start is not None and end is not None:
        return col.between(as_date(start), as_date(end))
    if start is not None:
        cond = col >= as_date(start)
    if end is not None:
        cond = col <= as_date(end)
    return cond
