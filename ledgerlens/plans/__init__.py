"""The audit checks, each a parameterised DataFrame -> DataFrame function."""

from ledgerlens.plans.afo import afo01_supplier_advances
from ledgerlens.plans.bin import (
    bin01_note_detail,
    bin01_report,
    bin01_note_summary,
    bin02_split_notes,
    bin06_no_finance_moves,
)
from ledgerlens.plans.car import (
    car04_individual_billing,
    car05_advance_offset,
    car06_overdue_receivables,
    car07_open_bin_overdue,
    car09_open_travel_advances,
    car10_multiple_advances,
)
from ledgerlens.plans.cax import cax02_cash_over_limit
from ledgerlens.plans.confirm import (
    confirm_messages,
    confirm_outcomes,
    confirm_outcomes_by_instant,
    confirm_report,
    mark_not_found,
)
from ledgerlens.plans.rec import billing_extract, rec07_weekend_holiday_billing, write_billing_extract
from ledgerlens.plans.suite import CATALOG, audit_suite, params_text, run_check, select_checks

__all__ = [n for n in dir() if not n.startswith("_")]
