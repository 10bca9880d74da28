"""Scans, fixture adapters and sinks."""

from cauce.sources.tables import read_table, scan_transactions, scan_features, stored_transactions
from cauce.sources.fixtures import orders_transactions, events_transactions, scored_rows
from cauce.sources.sinks import write_table, write_transactions, RunLog

__all__ = [
    "read_table", "scan_transactions", "scan_features", "stored_transactions",
    "orders_transactions", "events_transactions", "scored_rows",
    "write_table", "write_transactions", "RunLog",
]
