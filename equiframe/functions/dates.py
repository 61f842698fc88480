"""Date and quarter scalar functions (X8-X11, X13-X14, D1 rule).

Quarters are stored as text ``"YYYY Qn"`` (lexical order = time order) and
compared/ordered through the integer ordinal ``year*4 + quarter - 1``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymmdd(c) -> Column:
    """``20230102`` -> DATE (NULL on bad text)."""
    return F.try_to_date(_col(c).cast("string"), "yyyyMMdd")


def quarter_string(year, quarter) -> Column:
    """X11: (2022, 3) -> ``"2022 Q3"``."""
    return F.concat(_col(year).cast("string"), F.lit(" Q"), _col(quarter).cast("string"))


def date_quarter_string(d) -> Column:
    return quarter_string(F.year(_col(d)), F.quarter(_col(d)))


def quarter_year(fs_q) -> Column:
    """Year part of ``"YYYY Qn"`` (positions 1-4); NULL for malformed text."""
    return F.substring(_col(fs_q), 1, 4).try_cast("int")


def quarter_number(fs_q) -> Column:
    """Quarter part of ``"YYYY Qn"`` (position 7); NULL for malformed text."""
    return F.substring(_col(fs_q), 7, 1).try_cast("int")


def quarter_ordinal(fs_q) -> Column:
    """Gap-free integer order of quarters: year*4 + quarter - 1."""
    return quarter_year(fs_q) * 4 + quarter_number(fs_q) - 1


def is_q4(fs_q) -> Column:
    """last quarter of the year."""
    return quarter_number(fs_q) == 4


def report_quarter(base_dt) -> Column:
    """The latest statement quarter considered published on ``base_dt``.

    The quarter of (day - 6 months) in March, else of (day - 5 months).
    ``add_months`` clamps an impossible day to the month end, which equals
    the reference's "NA then fill from the prior day" (weekdays only).
    """
    d = _col(base_dt)
    lagged = F.add_months(d, F.when(F.month(d) == 3, F.lit(-6)).otherwise(F.lit(-5)))
    return date_quarter_string(lagged)


def report_year(base_dt) -> Column:
    """The latest annual report year: year of (day - 15 months)."""
    return F.year(F.add_months(_col(base_dt), -15))


def cutoff_date(as_of: _dt.datetime) -> _dt.date:
    """Last complete trading date as of a wall-clock time.

    Data for a day is final from 09:00 the next day, so before 09:00 the
    cut-off is two days back, otherwise one.  ``as_of`` is always passed in;
    nothing reads the clock.
    """
    back = 2 if as_of.hour < 9 else 1
    return as_of.date() - _dt.timedelta(days=back)
