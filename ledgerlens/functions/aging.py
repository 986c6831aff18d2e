"""Ageing buckets and the advance-offset status.

The three schemes look alike but differ at negatives and NULL; their edges are
kept separate on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.constants import (
    AGING_360_EDGES,
    AGING_360_LABELS,
    AGING_720_EDGES,
    AGING_720_LABELS,
    AGING_NO_DUE_DATE,
    AGING_TO_DUE_CHECK,
    AGING_TO_DUE_EDGES,
    AGING_TO_DUE_LABELS,
    OFFSET_NOT_APPLICABLE,
    OFFSET_OK,
    OFFSET_WRITE_OFF_ACL,
    OFFSET_WRITE_OFF_ATC,
    OFFSET_WRITE_OFF_DPC,
    OFFSET_WRITE_OFF_TCC,
)
from ledgerlens.functions._util import as_col
from ledgerlens.functions.dates import days_overdue, days_to_due


def bucket_overdue_720(days) -> Column:
    """Buckets over a days-overdue column: negatives fall in the first bucket, NULL has no due date."""
    d = as_col(days)
    expr = F.when(d <= AGING_720_EDGES[0], F.lit(AGING_720_LABELS[0]))
    for edge, label in zip(AGING_720_EDGES[1:], AGING_720_LABELS[1:-1]):
        expr = expr.when(d <= edge, F.lit(label))
    expr = expr.when(d > AGING_720_EDGES[-1], F.lit(AGING_720_LABELS[-1]))
    return expr.otherwise(F.lit(AGING_NO_DUE_DATE))


def aging_overdue_720(due, as_of) -> Column:
    return bucket_overdue_720(days_overdue(due, as_of))


def bucket_overdue_360(days) -> Column:
    """Buckets 0-30, 31-60, ..., 181-360, >360; negatives and NULL have no due date."""
    d = as_col(days)
    lower = 0
    expr = None
    for edge, label in zip(AGING_360_EDGES, AGING_360_LABELS[:-1]):
        cond = (d >= lower) & (d <= edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lower = edge + 1
    expr = expr.when(d > AGING_360_EDGES[-1], F.lit(AGING_360_LABELS[-1]))
    return expr.otherwise(F.lit(AGING_NO_DUE_DATE))


def aging_overdue_360(due, as_of) -> Column:
    return bucket_overdue_360(days_overdue(due, as_of))


def bucket_to_due(days) -> Column:
    """Days until due: 1-30, 31-60, 61-90, 91-120, >120; not positive or NULL -> ``Verificar``."""
    d = as_col(days)
    lower = 1
    expr = None
    for edge, label in zip(AGING_TO_DUE_EDGES, AGING_TO_DUE_LABELS[:-1]):
        cond = (d >= lower) & (d <= edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
        lower = edge + 1
    expr = expr.when(d > AGING_TO_DUE_EDGES[-1], F.lit(AGING_TO_DUE_LABELS[-1]))
    return expr.otherwise(F.lit(AGING_TO_DUE_CHECK))


def aging_to_due(due, as_of) -> Column:
    return bucket_to_due(days_to_due(due, as_of))


def offset_status(acl, dpc, atc, tcc) -> Column:
    """First match wins: ACL = 0, then DPC vs ACL, then TCC vs ATC, else not applicable."""
    acl, dpc, atc, tcc = (as_col(c) for c in (acl, dpc, atc, tcc))
    return (
        F.when(acl == 0, F.lit(OFFSET_OK))
        .when(dpc > acl, F.lit(OFFSET_WRITE_OFF_ACL))
        .when(dpc < acl, F.lit(OFFSET_WRITE_OFF_DPC))
        .when(tcc > atc, F.lit(OFFSET_WRITE_OFF_ATC))
        .when(tcc < atc, F.lit(OFFSET_WRITE_OFF_TCC))
        .otherwise(F.lit(OFFSET_NOT_APPLICABLE))
    )
