"""Code-to-label lookups as expressions (CASE over IN sets, literal maps): no join, inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.constants import CHECK_LABEL
from ledgerlens.functions._util import as_col


def label_lookup(c, mapping: dict, default) -> Column:
    """Code -> label as ``CASE WHEN c IN (codes of label 1) THEN label 1 ...``.

    One ``IN`` per distinct label (a hash-set probe), no join; comparisons follow
    the column's collation, so a case-insensitive view matches case-insensitively.
    The first label listing a code wins.
    """
    col = as_col(c)
    by_label: dict = {}
    for code, label in mapping.items():
        by_label.setdefault(label, []).append(code)
    expr = None
    for label, codes in by_label.items():
        cond = col.isin(*codes)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def operation_label(c, labels: dict[str, str], default: str = CHECK_LABEL) -> Column:
    """Operation code -> text; unknown (or NULL) codes -> ``default``."""
    return label_lookup(c, labels, default)


def invert_groups(groups: dict[str, tuple | list]) -> dict[str, str]:
    """{group: codes} -> {code: group}; the first group listing a code wins, duplicates collapse."""
    out: dict[str, str] = {}
    for group, codes in groups.items():
        for code in codes:
            out.setdefault(code, group)
    return out
