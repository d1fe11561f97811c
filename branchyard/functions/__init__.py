"""Column expressions used by the operators."""

from branchyard.functions.expressions import (
    counted_once,
    header_line,
    matches_fully,
    member_of,
    same_row,
)

__all__ = ["counted_once", "header_line", "matches_fully", "member_of", "same_row"]
