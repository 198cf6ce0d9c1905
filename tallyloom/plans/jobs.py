"""A report job: a list of reports over one set of tables, each written as a snapshot with a run-log entry."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from tallyloom.operators.journal import stage_journal
from tallyloom.operators.snapshots import SnapshotStore
from tallyloom.sources.erp import Erp
from tallyloom.sources.ledger import Ledger


@dataclass(frozen=True)
class ReportCall:
    """``report(tables, **params)`` written under the names in ``targets``."""

    targets: str | tuple[str, ...]
    report: Callable[..., DataFrame]
    params: Mapping[str, Any] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    order_by: tuple[str | Column, ...] = ()


def run_job(
    store: SnapshotStore,
    tables: Ledger | Erp,
    calls: Sequence[ReportCall],
    *,
    journal_path: str | None = None,
    stop_on_error: bool = True,
) -> dict[str, int | None]:
    """Run the calls in order and return the row count per target, None for a failed one.

    With ``journal_path`` the ledger's lines and headers are joined and written once, and every call reads that.
    A failure is in the run log either way; ``stop_on_error=False`` goes on with the next call.
    """
    if journal_path is not None:
        tables = stage_journal(tables, journal_path)
    done: dict[str, int | None] = {}
    for call in calls:
        first, *copies = (call.targets,) if isinstance(call.targets, str) else call.targets
        try:
            done[first] = store.write(first, lambda: call.report(tables, **call.params), call.partition_by, call.order_by)
            for name in copies:
                done[name] = store.write(name, store.read(first), call.partition_by, call.order_by)
        except Exception:
            if stop_on_error:
                raise
            done.setdefault(first, None)
            for name in copies:
                done.setdefault(name, None)
    return done
