"""Ledger reporting and incremental replication as Spark DataFrame jobs."""

from tallyloom.session import shared_folder, tune
from tallyloom.sources.erp import Erp
from tallyloom.sources.ledger import Ledger

__all__ = ["Erp", "Ledger", "shared_folder", "tune"]
