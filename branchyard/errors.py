"""Errors raised by the store and its operators."""

from __future__ import annotations


class UnknownRef(LookupError):
    """The ref or commit does not exist, or the ref was dropped."""


class UnknownTable(LookupError):
    """The table (or namespace) does not exist at the ref."""


class AlreadyExists(ValueError):
    """A ref or table of that name is already there."""


class StaleHead(RuntimeError):
    """The ref moved since the caller looked at it."""


class MergeConflict(RuntimeError):
    """Both sides changed the same tables or rows; nothing was published."""

    def __init__(self, message: str, keys: list[str]):
        super().__init__(message)
        self.keys = keys


class AuditFailed(RuntimeError):
    """A check before publishing did not pass; nothing was published."""
