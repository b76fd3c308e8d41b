"""Table reconciliation on Spark: map, union, compare and report, all as DataFrame plans."""

from tallymark.plans.reconcile import ReconResult, recon_counts, reconcile
from tallymark.plans.report import compare_and_report, summarize
from tallymark.plans.validation import ValidationJob, run_validation
from tallymark.spec import (
    ColumnMap,
    DeclaredColumn,
    GlobalRule,
    LookupJoin,
    ServerSource,
    TableMap,
)

__all__ = [
    "ColumnMap",
    "DeclaredColumn",
    "GlobalRule",
    "LookupJoin",
    "ReconResult",
    "ServerSource",
    "TableMap",
    "ValidationJob",
    "compare_and_report",
    "recon_counts",
    "reconcile",
    "run_validation",
    "summarize",
]
