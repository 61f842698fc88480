"""D1 trading calendar with reporting lag, D2 incremental update plan."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equiframe.functions.dates import cutoff_date, report_quarter, report_year
from equiframe.operators.joins import after_high_water_mark, bounded_broadcast

# Fixed-date public holidays (month, day) used when no exchange holiday
# list is landed: New Year, Independence Movement Day, Children's Day,
# Memorial Day, Liberation Day, National Foundation Day, Hangul Day,
# Christmas.
FIXED_HOLIDAYS = [(1, 1), (3, 1), (5, 5), (6, 6), (8, 15), (10, 3), (10, 9), (12, 25)]


def year_days(years: DataFrame, year_col: str = "year") -> DataFrame:
    """Every calendar day of each year in ``years`` (one row per year in,
    at most 366 rows out per year; runs where the years are)."""
    y = F.col(year_col).cast("int")
    return years.select(
        y.alias("year"),
        F.explode(F.sequence(F.make_date(y, F.lit(1), F.lit(1)),
                             F.make_date(y, F.lit(12), F.lit(31)))).alias("base_dt"))


def fixed_holidays(years: DataFrame, year_col: str = "year",
                   month_days: list[tuple[int, int]] | None = None) -> DataFrame:
    md = month_days or FIXED_HOLIDAYS
    y = F.col(year_col).cast("int")
    days = F.array(*[F.make_date(y, F.lit(m), F.lit(d)) for m, d in md])
    return years.select(F.explode(days).alias("base_dt"))


def business_days(years: DataFrame, holidays: DataFrame, year_col: str = "year") -> DataFrame:
    """The weekdays of ``years`` minus ``holidays`` (column base_dt).

    Holidays are bounded (a few dozen per year) and broadcast.
    """
    days = year_days(years.select(year_col).distinct(), year_col)
    weekdays = days.filter(F.weekday("base_dt") < 5)
    hol = bounded_broadcast(holidays.select(F.col("base_dt").cast("date").alias("base_dt")).distinct())
    return weekdays.join(hol, on="base_dt", how="left_anti").select("base_dt")


def with_report_lag(df: DataFrame, date_col: str = "base_dt") -> DataFrame:
    """Attach ``fs_q`` (latest published quarter) and ``fs_y``."""
    d = F.col(date_col)
    return df.withColumn("fs_q", report_quarter(d)).withColumn("fs_y", report_year(d).cast("int"))


def business_calendar(years: DataFrame, holidays: DataFrame, year_col: str = "year") -> DataFrame:
    """The ``workdays`` table (base_dt, fs_q, fs_y) for the given years."""
    return with_report_lag(business_days(years, holidays, year_col))


# --- D2: what to load next -------------------------------------------------

def days_to_update(workdays: DataFrame, stock_daily: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Trading days after the last loaded day, up to the cut-off of
    ``as_of`` (data for a day is final the next morning)."""
    cut = cutoff_date(as_of)
    pending = after_high_water_mark(workdays.select("base_dt"), "base_dt", stock_daily, "base_dt")
    return pending.filter(F.col("base_dt") <= F.lit(cut))


def days_after(workdays: DataFrame, last_day: _dt.date | None, as_of: _dt.datetime) -> DataFrame:
    """``days_to_update`` where the last loaded day is known (``None``: nothing
    is loaded), so that both bounds reach the calendar's scan."""
    days = workdays.select("base_dt").filter(F.col("base_dt") <= F.lit(cutoff_date(as_of)))
    return days if last_day is None else days.filter(F.col("base_dt") > F.lit(last_day))


def years_to_update(stock_daily: DataFrame, as_of: _dt.datetime) -> DataFrame:
    """Calendar years to (re)build: the last loaded year and the current one."""
    last_year = stock_daily.agg(F.year(F.max("base_dt")).alias("year"))
    this_year = stock_daily.sparkSession.range(1).select(F.lit(as_of.year).alias("year"))
    return last_year.union(this_year).where(F.col("year").isNotNull()).distinct()


def quarters_to_update(workdays: DataFrame, company_fs_bs: DataFrame, stock_daily: DataFrame,
                       as_of: _dt.datetime) -> DataFrame:
    """Published quarters from the last stored statement quarter onwards,
    as of the last planned day.  No planned day -> no quarter."""
    last_day = days_to_update(workdays, stock_daily, as_of).agg(F.max("base_dt")).scalar()
    last_q = company_fs_bs.agg(F.max("fs_q")).scalar()
    return (workdays.filter((F.col("fs_q") >= last_q) & (F.col("base_dt") <= last_day))
                    .select("fs_q").distinct())


def new_symbols(stock_info: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Symbols in ``stock_info`` now that were not in the ``snapshot`` taken
    before the daily load."""
    return (stock_info.select("sym_cd").distinct()
                      .join(snapshot.select("sym_cd").distinct(), on="sym_cd", how="left_anti"))


def update_plan(workdays: DataFrame, stock_daily: DataFrame, company_fs_bs: DataFrame,
                stock_info: DataFrame, snapshot: DataFrame, as_of: _dt.datetime) -> dict[str, DataFrame]:
    """Everything the next load needs, as of ``as_of``: trading days,
    calendar years, statement quarters and new symbols (lazy frames)."""
    return {
        "days": days_to_update(workdays, stock_daily, as_of),
        "years": years_to_update(stock_daily, as_of),
        "quarters": quarters_to_update(workdays, company_fs_bs, stock_daily, as_of),
        "new_symbols": new_symbols(stock_info, snapshot),
    }
