"""Scope and membership filters, constant columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions._util import as_col
from ledgerlens.functions.predicates import code_filter, in_date_range


def scope_condition(*, establishments: Iterable[str] | str | None, date_col: str | None = None, start=None, end=None,
                    establishment_col: str = "cod_estabelecimento") -> Column:
    """Establishment equality/list and an inclusive date range, as one predicate."""
    out = F.lit(True)
    if establishments is not None:
        out = out & code_filter(establishment_col, include=establishments)
    if date_col is not None and (start is not None or end is not None):
        out = out & in_date_range(date_col, start, end)
    return out


def scope_filter(df: DataFrame, *, establishments: Iterable[str] | str | None,
                 date_col: str | None = None, start=None, end=None,
                 establishment_col: str = "cod_estabelecimento") -> DataFrame:
    """The rows of a scope (see :func:`scope_condition`).

    Both predicates are plain comparisons on stored columns, so they reach the
    Parquet scan (``PushedFilters``) and prune ``partitionBy`` directories.
    """
    return df.filter(scope_condition(establishments=establishments, date_col=date_col, start=start, end=end,
                                     establishment_col=establishment_col))


def member_filter(df: DataFrame, col, values, *, value_col: str | None = None) -> DataFrame:
    """Keep rows whose ``col`` is in ``values``.

    A Python list becomes an ``IN``/``InSet`` predicate; a DataFrame becomes a
    left-semi join with its distinct values.
    """
    if isinstance(values, DataFrame):
        key = value_col or values.columns[0]
        right = values.select(F.col(key).alias("__member")).distinct()
        return df.join(right, as_col(col) == F.col("__member"), "left_semi")
    return df.filter(as_col(col).isin(*list(values)))


def constant_label(df: DataFrame, name: str, value) -> DataFrame:
    """Replace (or add) a column with a literal."""
    return df.withColumn(name, F.lit(value))
