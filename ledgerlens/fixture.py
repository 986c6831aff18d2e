"""Check parameters for the TPC-H-like test tables (FIXTURES.md §3).

The test tables' dates span 1995-2001, so the audited 2025 scopes would select
nothing; these scopes are used instead, identically by the Spark queries, the
DuckDB oracle and the benchmark.
"""

from __future__ import annotations

import datetime as _dt

# Establishments R011..R151 (nation keys 1-15).
ESTABLISHMENTS = tuple(f"R{n:02d}1" for n in range(1, 16))

AS_OF = _dt.date(1998, 12, 31)
BASE_DATE = _dt.date(1998, 12, 31)
YEAR_START = _dt.date(1998, 1, 1)
YEAR_END = _dt.date(1998, 12, 31)
WIDE_START = _dt.date(1995, 1, 1)
SETTLED_FROM = _dt.date(1998, 1, 1)
HOLIDAYS = (_dt.date(1998, 9, 7), _dt.date(1998, 12, 25))
GROUP_LABEL = "GRUPO TESTE"
CAR10_MORE_THAN = 11
REPLY_TIMEOUT_SECONDS = 24 * 3600
RUN_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)
COMPANY = "Empresa Teste"
TEMPLATE = "{nome_cliente}, a {empresa} pede que confirme estas notas:\n{notas}\nResponda SIM ou NÃO."

# Per-check keyword arguments.
PARAMS = {
    "afo01_supplier_advances": dict(establishments=ESTABLISHMENTS, base_date=BASE_DATE),
    "bin01_note_summary": dict(establishments=ESTABLISHMENTS, start=WIDE_START, end=YEAR_END,
                               group_label=GROUP_LABEL),
    "bin01_note_detail": dict(establishments=ESTABLISHMENTS, start=WIDE_START, end=YEAR_END),
    "bin02_split_notes": dict(establishments=ESTABLISHMENTS, start=WIDE_START, end=YEAR_END),
    "bin06_no_finance_moves": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END),
    "cax02_cash_over_limit": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END),
    "car04_individual_billing": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END),
    "car05_advance_offset": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END, as_of=AS_OF),
    "car06_overdue_receivables": dict(establishments=ESTABLISHMENTS, start=WIDE_START, end=YEAR_END,
                                      settled_from=SETTLED_FROM, as_of=AS_OF),
    "car07_open_bin_overdue": dict(establishments=ESTABLISHMENTS, base_date=BASE_DATE),
    "car09_open_travel_advances": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END,
                                       as_of=AS_OF),
    "car10_multiple_advances": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END,
                                    more_than=CAR10_MORE_THAN),
    "rec07_weekend_holiday_billing": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END,
                                          holidays=HOLIDAYS),
    "billing_extract": dict(establishments=ESTABLISHMENTS, start=YEAR_START, end=YEAR_END),
}
