"""Branchable tables on Spark: load on a branch, check there, publish by a merge."""

from branchyard.errors import (
    AlreadyExists,
    AuditFailed,
    MergeConflict,
    StaleHead,
    UnknownRef,
    UnknownTable,
)
from branchyard.operators.store import BranchStore

__all__ = [
    "AlreadyExists",
    "AuditFailed",
    "BranchStore",
    "MergeConflict",
    "StaleHead",
    "UnknownRef",
    "UnknownTable",
]
