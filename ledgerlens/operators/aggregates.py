"""Grouping operators.

All aggregates are Spark built-ins, so every ``groupBy`` runs as partial
(map-side) + final hash aggregation: a hot group key is pre-aggregated in each
task before the shuffle and never gathered into one task as rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions._util import as_col


def _by(by) -> list:
    if isinstance(by, (str, Column)):
        return [by]
    return list(by)


def conditional_sum(value, cond) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``; the ELSE 0 keeps an empty side at 0, not NULL."""
    return F.sum(F.when(cond, as_col(value)).otherwise(F.lit(0)))


def conditional_count(cond) -> Column:
    """``COUNT(CASE WHEN cond THEN 1 END)`` as a ``bigint``."""
    return F.count(F.when(cond, F.lit(1)))


def conditional_sums(df: DataFrame, by, value, cases: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*_by(by)).agg(*[conditional_sum(value, c).alias(n) for n, c in cases.items()])


def conditional_counts(df: DataFrame, by, cases: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(*_by(by)).agg(*[conditional_count(c).alias(n) for n, c in cases.items()])


def grouped_sum(df: DataFrame, by, values: Mapping[str, str] | Sequence[str]) -> DataFrame:
    if not isinstance(values, Mapping):
        values = {v: v for v in values}
    return df.groupBy(*_by(by)).agg(*[F.sum(src).alias(name) for name, src in values.items()])


def any_label(cols: Sequence[str] | Mapping[str, str]) -> list[Column]:
    """``MAX(col)`` to carry a descriptive column through a grouping (deterministic, unlike ``first``)."""
    if not isinstance(cols, Mapping):
        cols = {c: c for c in cols}
    return [F.max(src).alias(name) for name, src in cols.items()]


def label_aggregate(df: DataFrame, by, labels: Mapping[str, str], sums: Mapping[str, Column],
                    counts: Mapping[str, Column] = {}) -> DataFrame:
    """``GROUP BY by`` with ``MAX(label)`` columns, sums and counts, planned for scale.

    A string ``MAX`` has no fixed-width buffer, so Spark would sort every input
    row (SortAggregate). Here the raw rows are first hash-aggregated by the keys
    *and* the label columns (sums and counts only); the string ``MAX`` then runs
    over that small pre-aggregate. Sums of partial sums and counts are exact; the
    sums are cast back to the type a single ``SUM`` gives.
    """
    keys = _by(by)
    label_src = list(dict.fromkeys(labels.values()))
    phase1 = df.groupBy(*keys, *label_src).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()],
        *[F.count(e).alias(n) for n, e in counts.items()])
    sum_types = {n: phase1.schema[n].dataType for n in sums}
    return phase1.groupBy(*keys).agg(
        *[F.max(src).alias(name) for name, src in labels.items()],
        *[F.sum(n).cast(sum_types[n]).alias(n) for n in sums],
        *[F.sum(n).cast("bigint").alias(n) for n in counts])


def distinct_count_having(df: DataFrame, by, col: str, more_than: int, *, name: str = "qtd",
                          extra: Sequence[Column] = ()) -> DataFrame:
    """Groups with more than ``more_than`` distinct non-NULL ``col`` values.

    Exact ``countDistinct`` (Spark expands it into a (group, value) de-duplication
    shuffle that spreads a hot group over many tasks), then a HAVING filter.
    """
    agg = df.groupBy(*_by(by)).agg(F.countDistinct(col).alias(name), *extra)
    return having_filter(agg, F.col(name) > more_than)


def having_filter(grouped: DataFrame, condition: Column) -> DataFrame:
    return grouped.filter(condition)


def distinct_rows(df: DataFrame, cols: Sequence) -> DataFrame:
    """``GROUP BY`` without aggregates."""
    return df.select(*cols).distinct()


def expression_group(df: DataFrame, exprs: Mapping[str, Column], aggs: Sequence[Column]) -> DataFrame:
    """Group by named expressions (``YEAR(d)``, ``MONTH(d)``, a cleaned id, ...)."""
    return df.groupBy(*[e.alias(n) for n, e in exprs.items()]).agg(*aggs)


def aggregate_arithmetic(grouped: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Columns computed from aggregate columns after the grouping."""
    out = grouped
    for name, e in exprs.items():
        out = out.withColumn(name, e)
    return out
