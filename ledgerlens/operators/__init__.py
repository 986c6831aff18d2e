"""DataFrame-level operators the audit checks are assembled from."""

from ledgerlens.operators.aggregates import (
    aggregate_arithmetic,
    any_label,
    conditional_count,
    conditional_counts,
    conditional_sum,
    conditional_sums,
    distinct_count_having,
    distinct_rows,
    expression_group,
    grouped_sum,
    having_filter,
    label_aggregate,
)
from ledgerlens.operators.joins import (
    group_lookup,
    semi_join_back,
)
from ledgerlens.operators.ordering import ordered_output, ranked_output
from ledgerlens.operators.scope import constant_label, member_filter, scope_condition, scope_filter
from ledgerlens.operators.windows import count_over, count_rows_over

__all__ = [n for n in dir() if not n.startswith("_")]
