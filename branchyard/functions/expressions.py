"""Column expressions: all stay inside Spark's generated code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """Column name safe for ``F.col``, also with dots or spaces in it."""
    return "`" + name.replace("`", "``") + "`"


def header_line(columns: Sequence[str]) -> Column:
    """True for a row that is the file's header line read as data."""
    return reduce(
        lambda a, b: a & b,
        [F.col(quoted(c)).cast("string").eqNullSafe(F.lit(c)) for c in columns],
    )


def matches_fully(column: str, pattern: str) -> Column:
    """The whole text fits the pattern; NULL does not."""
    return F.coalesce(F.col(quoted(column)).rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def member_of(column: str, values: Sequence) -> Column:
    """The value is one of ``values``; NULL is not."""
    return F.coalesce(F.col(quoted(column)).isin(list(values)), F.lit(False))


def counted_once(condition: Column) -> Column:
    """Number of rows for which the condition holds, 0 for no rows."""
    return F.coalesce(F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint")


def same_row(a: Column, b: Column) -> Column:
    """Equal, with two missing rows (or two NULLs) counted as equal."""
    return a.eqNullSafe(b)
