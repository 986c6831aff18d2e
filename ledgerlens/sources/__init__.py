"""Sources and sinks: ERP views (Parquet, JDBC, test tables), contact sheets, result writers."""

from ledgerlens.sources.contacts import confirm_contacts, read_contacts_csv, resolve_aliases
from ledgerlens.sources.sinks import (
    CONFIRM_RESULT_SCHEMA,
    confirm_results,
    format_dates,
    write_partitioned,
    write_report,
)
from ledgerlens.sources.testdata import VIEW_BUILDERS, Tables, testdata_view
from ledgerlens.sources.views import (
    VIEW_SCHEMAS,
    canonical_columns,
    collated_scope,
    fold_key,
    load_view,
    materialize_view,
    split_histogram,
    split_predicates,
    with_collation,
)

__all__ = [n for n in dir() if not n.startswith("_")]
