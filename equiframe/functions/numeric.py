"""Numeric scalar functions (X15, X16) and null predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """Ratio; a zero or NULL denominator gives NULL (ANSI-safe)."""
    return F.try_divide(_col(num), _col(den))


def round_half_even(c, scale: int = 0) -> Column:
    """banker's rounding, as R ``round``."""
    return F.bround(_col(c), scale)


def first_non_null(*cols) -> Column:
    """Prefer the first argument, else the next."""
    return F.coalesce(*[_col(c) for c in cols])


def any_not_null(cols: list) -> Column:
    """TRUE when at least one of ``cols`` is not NULL."""
    return reduce(lambda a, b: a | b, [_col(c).isNotNull() for c in cols])


def all_differ_from(cols: list, sentinel: str = "-") -> Column:
    """keep only when every column differs from ``sentinel``.

    A NULL comparison yields NULL, so a NULL value also drops the row under
    ``filter`` (as the reference's ``if_all(.x != "-")``).
    """
    return reduce(lambda a, b: a & b, [_col(c) != F.lit(sentinel) for c in cols])
