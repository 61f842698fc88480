"""Column-set operators (P1-P5, P11): positional ranges and many-column
projections.  Column order is part of the reference schemas, so ranges are
taken from ``df.columns``; everything resolves to one ``select``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` inclusive, in schema order."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    if i > j:
        i, j = j, i
    return cols[i:j + 1]


def select_range(df: DataFrame, *ranges: tuple[str, str] | str) -> DataFrame:
    """Keep the listed names and ``(first, last)`` ranges, in the given order."""
    out: list[str] = []
    for r in ranges:
        names = [r] if isinstance(r, str) else col_range(df, *r)
        out.extend(n for n in names if n not in out)
    return df.select(*out)


def drop_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """``-a:-b`` / ``!(a:b)``: drop a positional range."""
    return df.drop(*col_range(df, first, last))


def require_columns(df: DataFrame, cols: list[str], what: str) -> list[str]:
    """``cols``, all of which must be columns of ``df``: a renamed or missing
    vendor item is an error that names it, never a column left out."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: missing columns {missing}")
    return list(cols)


def first_columns(df: DataFrame, n: int) -> DataFrame:
    """``select(1:n)``."""
    return df.select(*df.columns[:n])


def across(df: DataFrame, cols: list[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply ``fn`` to every column in ``cols`` in one projection."""
    wanted = set(cols)
    return df.select(*[fn(F.col(c)).alias(c) if c in wanted else F.col(c) for c in df.columns])


def relocate(df: DataFrame, cols: list[str], before: str | None = None) -> DataFrame:
    """P5: move ``cols`` to the front, or right before ``before``."""
    rest = [c for c in df.columns if c not in cols]
    if before is None:
        return df.select(*cols, *rest)
    i = rest.index(before)
    return df.select(*rest[:i], *cols, *rest[i:])
