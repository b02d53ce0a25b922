"""Writers: appended result tables, tables of running totals, actions stored by session."""

from clickloom.sinks.append import (
    ResultWriter,
    append_jdbc,
    append_table,
    jdbc_results,
    parquet_results,
    replace_task,
)
from clickloom.sinks.layout import StoredActions, store_by_session, stored_actions
from clickloom.sinks.totals import CROWDED, TotalsTable

__all__ = [
    "CROWDED",
    "ResultWriter",
    "StoredActions",
    "TotalsTable",
    "append_jdbc",
    "append_table",
    "jdbc_results",
    "parquet_results",
    "replace_task",
    "store_by_session",
    "stored_actions",
]
