"""Readers and writers."""

from ledgersift.sources.readers import read_requests, read_txn, read_txn_csv
from ledgersift.sources.writers import write_report, write_stage

__all__ = ["read_txn", "read_txn_csv", "read_requests", "write_stage", "write_report"]
