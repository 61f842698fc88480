"""Statement tables, trailing-four-quarter and single-quarter P&L,
filled balance sheet.

Quarterly panels are keyed (sym_cd, fs_q).  The trailing P&L cuts a symbol's
quarters into blocks, each with the four rows before it, and the filled balance
sheet carries the last values from block to block, so no task holds more than
one block of a symbol.  All windows of the trailing computation share one
shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiframe.functions.dates import is_q4, quarter_ordinal, quarter_string, quarter_year
from equiframe.functions.numeric import any_not_null, first_non_null
from equiframe.operators.columns import require_columns
from equiframe.operators.filters import in_set, quarter_between
from equiframe.operators.joins import complete_grid, value_set
from equiframe.operators.windows import fill_forward
from equiframe.sources.vendor import item_list, item_rows

KEYS = ["sym_cd", "fs_q"]
# P&L items excluded from the trailing computation.
PL_EXCLUDED = ["dpr", "prop_div"]
#: Grid rows that a row's trailing P&L looks back (last year's value, and last
#: year's Q4 is among them), so also the later rows that a changed row reaches.
LOOK_BACK = 4
# Quarters per block of a symbol (16 years; each repeats the LOOK_BACK before it).
BLOCK_QUARTERS = 64


def drop_all_null(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keep rows where at least one non-key column is not NULL."""
    keys = keys if keys is not None else KEYS
    rest = [c for c in df.columns if c not in keys]
    return df.filter(any_not_null(rest)) if rest else df


def split_statements(df: DataFrame, meta: DataFrame,
                     known_quarters: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """A normalised statement export -> (balance sheet, P&L).

    Columns are chosen by the metadata flags (a flagged item that ``df`` lacks
    is an error); rows with every item NULL are dropped.  With ``known_quarters`` (new-symbol variant) rows are kept only
    for quarters already present in the stored balance sheet.
    """
    rows = item_rows(meta, "fs")
    bs_cols = require_columns(df, item_list(rows, "fs", "bs"), "balance-sheet items")
    pl_cols = require_columns(df, item_list(rows, "fs", "pl"), "P&L items")
    bs = drop_all_null(df.select(*KEYS, *bs_cols))
    pl = drop_all_null(df.select(*KEYS, *pl_cols))
    if known_quarters is not None:
        bs = in_set(bs, "fs_q", known_quarters.select("fs_q"))
        pl = in_set(pl, "fs_q", known_quarters.select("fs_q"))
    return bs, pl


def trailing_pl(grid: DataFrame, items: list[str] | None = None, quarters: Column | None = None,
                block: int = BLOCK_QUARTERS) -> DataFrame:
    """Per item ``x`` of a (sym_cd, fs_q) grid of year-to-date values:

    * ``x_a4q`` -- trailing four quarters: Q4 -> ``x`` (NULL stays NULL);
      Q1-Q3 -> ``x + y1 - l4``, falling back to ``y1`` when any part is
      NULL, where ``y1`` is last year's Q4 value and ``l4`` the value four
      grid rows earlier;
    * ``x_n`` -- single quarter: ``x - previous quarter of the same year``
      (0 before the first quarter of the year; a NULL prior stays NULL).

    ``earn`` prefers ``earn_dom`` (controlling-interest) when present, and
    the earn_dom columns are dropped.  Rows with every output NULL are
    dropped.  ``l4`` counts grid rows: the grid must be complete, that is hold
    for each symbol a stretch of the quarter set ``quarters`` (a sorted array;
    default those of the grid) without a hole.

    Blocked like ``rolling``: a row's place in the quarter set gives its
    block of ``block`` quarters, and the ``LOOK_BACK`` rows before a block are
    copied into it.
    """
    if block < 1:
        raise ValueError("block must be >= 1")
    items = items or [c for c in grid.columns if c not in KEYS]
    if quarters is None:
        quarters = value_set(grid.select("fs_q").distinct(), "fs_q")
    size = max(block, LOOK_BACK)
    at = F.array_position(quarters, F.col("fs_q")) - 1
    home = F.col("_home")
    blocks = F.when(F.pmod(F.col("_at"), F.lit(size)) >= size - LOOK_BACK, F.array(home, home + 1)).otherwise(F.array(home))
    # Year and quarter ordinal as columns, used by every window spec, so one
    # sort on (sym_cd, _blk, _y, _o) serves all three windows: rows in (year,
    # ordinal) order are rows in ordinal order.
    g = (grid.select(*KEYS, *items, quarter_year("fs_q").alias("_y"), quarter_ordinal("fs_q").alias("_o"), at.alias("_at"))
             .withColumn("_home", F.floor(F.col("_at") / size).cast("long"))
             .withColumn("_blk", F.explode(blocks)).drop("_at")
             .repartition("sym_cd", "_blk"))
    y, o = F.col("_y"), F.col("_o")
    q4 = is_q4("fs_q")
    by_sym = Window.partitionBy("sym_cd", "_blk")
    w_rows = by_sym.orderBy(y, o)
    w_prev_year = by_sym.orderBy(y).rangeBetween(-1, -1)
    w_year = Window.partitionBy("sym_cd", "_blk", "_y").orderBy(o)

    # the lags first, last year's Q4 on top: the (symbol, block, year) range window
    # then reuses the ordering the lag windows sorted for
    lagged = g.select(*KEYS, *items, "_y", "_o", "_home", "_blk",
                      *[F.lag(F.col(x), 4).over(w_rows).alias(f"_l4_{x}") for x in items],
                      *[F.lag(F.col(x), 1, 0.0).over(w_year).alias(f"_l1_{x}") for x in items])
    a4q, net = {}, {}
    for x in items:
        v = F.col(x)
        y1 = F.max(F.when(q4, v)).over(w_prev_year)
        l4 = F.col(f"_l4_{x}")
        a4q[x] = F.when(q4, v).otherwise(first_non_null(v + y1 - l4, y1))
        net[x] = v - F.col(f"_l1_{x}")
    if "earn" in a4q and "earn_dom" in a4q:
        a4q["earn"] = first_non_null(a4q["earn_dom"], a4q["earn"])
        net["earn"] = first_non_null(net["earn_dom"], net["earn"])
    kept = [x for x in items if x != "earn_dom"]
    out = lagged.select(*KEYS, "_home", "_blk", *[a4q[x].alias(f"{x}_a4q") for x in kept],
                        *[net[x].alias(f"{x}_n") for x in kept])
    return drop_all_null(out.filter(F.col("_blk").eqNullSafe(home)).drop("_home", "_blk"))


def _quarters(bs: DataFrame) -> Column:
    """The quarters of the stored balance sheet, in order (at most four a year)."""
    return value_set(bs.where(F.col("fs_q").isNotNull()), "fs_q")


def _pl_grid(bs: DataFrame, pl: DataFrame) -> DataFrame:
    """Grid of every bs symbol x every bs quarter with the P&L items."""
    return complete_grid(bs, "sym_cd", "fs_q", pl.drop(*[c for c in PL_EXCLUDED if c in pl.columns]))


def trailing_pl_existing(bs: DataFrame, pl: DataFrame, first: str | Column,
                         last: str | Column) -> DataFrame:
    """D13 (existing symbols): quarters ``first..last`` recomputed.

    The grid starts at Q1 of the year before ``first`` so that ``y1`` and
    ``l4`` are available; the output is cut to ``first..last``.  Bounds may
    be literals or scalar-subquery Columns.
    """
    first_c = F.lit(first) if isinstance(first, str) else first
    start_1y = quarter_string(quarter_year(first_c) - 1, F.lit(1))
    grid = quarter_between(_pl_grid(bs, pl), start_1y, last)
    return quarter_between(trailing_pl(grid, quarters=_quarters(bs)), first_c, last)


def trailing_pl_range(bs: DataFrame, pl: DataFrame, quarters: DataFrame) -> DataFrame:
    """D13 for a set of quarters to update (first and last of the set,
    taken as scalar subqueries; an empty set selects nothing)."""
    first = quarters.agg(F.min("fs_q")).scalar()
    last = quarters.agg(F.max("fs_q")).scalar()
    return trailing_pl_existing(bs, pl, first, last)


def trailing_pl_new(bs: DataFrame, pl: DataFrame, symbols: DataFrame) -> DataFrame:
    """D13 (new symbols): every quarter of the given symbols."""
    grid = in_set(_pl_grid(bs, pl), "sym_cd", symbols.select("sym_cd"))
    return trailing_pl(grid, quarters=_quarters(bs))


def reached_keys(bs: DataFrame, landed: DataFrame, new_quarters: DataFrame) -> DataFrame:
    """Keys (sym_cd, fs_q) of the grid whose trailing P&L landed rows may
    change: the landed keys and the ``LOOK_BACK`` quarters after each, and for
    a quarter that the grid did not have those of every symbol.

    ``bs`` is the stored balance sheet after the load; the quarters travel as
    a scalar subquery (at most four a year).
    """
    quarters = _quarters(bs)

    def spread(keys: DataFrame) -> DataFrame:
        at = keys.withColumn("_at", F.array_position(quarters, F.col("fs_q")).cast("int")).filter(F.col("_at") > 0)
        return at.select("sym_cd", F.explode(F.slice(quarters, F.col("_at"), LOOK_BACK + 1)).alias("fs_q"))

    # a landed symbol without a balance sheet has no row in the grid
    listed = in_set(bs.select("sym_cd").filter(_within(bs, landed)), "sym_cd", landed.select("sym_cd")).distinct()
    of_symbols = spread(in_set(landed.select(*KEYS), "sym_cd", listed))
    every = bs.select("sym_cd").where(F.col("sym_cd").isNotNull()).distinct()
    added = new_quarters.agg(F.collect_set("fs_q")).scalar()
    of_quarters = spread(every.withColumn("fs_q", F.explode(added)))
    return of_symbols.unionByName(of_quarters).distinct()


def _within(table: DataFrame, keys: DataFrame) -> Column:
    """A range on the symbol that the scan can check against row groups sorted by it."""
    return F.col("sym_cd").between(keys.agg(F.min("sym_cd")).scalar(), keys.agg(F.max("sym_cd")).scalar())


def trailing_pl_reached(bs: DataFrame, pl: DataFrame, reached: DataFrame) -> DataFrame:
    """D13 by change set: the trailing P&L of the keys ``reached`` alone
    (``reached_keys``), as the whole table would give it.

    Per symbol the grid is the stretch of quarters from ``LOOK_BACK`` before
    the first reached one to the last, without a hole, so the windows count
    the same rows; P&L rows of other symbols are not read beyond their row
    group and not shuffled.
    """
    quarters = _quarters(bs)
    at = reached.withColumn("_at", F.array_position(quarters, F.col("fs_q")).cast("int"))
    span = at.groupBy("sym_cd").agg(F.greatest(F.min("_at") - LOOK_BACK, F.lit(1)).alias("_lo"), F.max("_at").alias("_hi"))
    grid = span.select("sym_cd", F.explode(F.slice(quarters, F.col("_lo"), F.col("_hi") - F.col("_lo") + 1)).alias("fs_q"))
    items = pl.drop(*[c for c in PL_EXCLUDED if c in pl.columns]).filter(_within(pl, reached))
    values = in_set(items, "sym_cd", reached.select("sym_cd"))
    full = trailing_pl(grid.join(values, on=KEYS, how="left"), [c for c in items.columns if c not in KEYS],
                       quarters)
    return full.join(reached, on=KEYS, how="left_semi").select(*full.columns)


BS_FILL = ["grs_asset", "cap", "net_asset"]


def filled_balance_sheet(bs: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Complete (symbol x quarter) grid with each balance-sheet item
    carried forward from the symbol's last reported quarter."""
    cols = cols or [c for c in bs.columns if c not in KEYS]
    grid = complete_grid(bs, "sym_cd", "fs_q")
    return fill_forward(grid, cols, ["sym_cd"], quarter_ordinal("fs_q"))

