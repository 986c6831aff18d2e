"""Column-level building blocks (all built-in Spark expressions, no Python UDF)."""

from ledgerlens.functions.aging import (
    aging_overdue_360,
    aging_overdue_720,
    aging_to_due,
    bucket_overdue_360,
    bucket_overdue_720,
    bucket_to_due,
    offset_status,
)
from ledgerlens.functions.confirm import (
    confirm_message,
    confirm_note_lines,
    confirm_notes,
    confirm_notes_text,
    confirm_phone,
    confirm_removed_count,
    confirm_sanitize,
    strip_text,
)
from ledgerlens.functions.dates import (
    as_of_column,
    base_date_shift,
    date_text,
    days_overdue,
    days_overdue_floor,
    days_to_due,
    holiday_flag,
    month_end_exclude,
    month_name_pt,
    weekday_name,
    weekend_flag,
    year_month,
)
from ledgerlens.functions.labels import invert_groups, label_lookup, operation_label
from ledgerlens.functions.predicates import (
    code_filter,
    in_date_range,
    numeric_threshold,
    open_as_of,
    reversal_exclude,
)
from ledgerlens.functions.taxid import tax_id_clean, tax_id_length, tax_id_type

__all__ = [n for n in dir() if not n.startswith("_")]
