"""Relational building blocks: column sets, filters, windows, joins, keys."""

from equiframe.operators.columns import across, col_range, drop_range, first_columns, relocate, require_columns, select_range
from equiframe.operators.filters import (between_dates, in_set, listed_common_shares, lookback_window,
                                         on_date, quarter_between, sym_dt_pick)
from equiframe.operators.joins import (after_high_water_mark, bounded_broadcast, broadcast_if_small,
                                       complete_grid, expand_grid, value_set)
from equiframe.operators.keys import assign_keys
from equiframe.operators.reshape import tag, union_by_name, unpivot_columns
from equiframe.operators.windows import (as_of_latest, fill_forward, latest_per_key,
                                         market_calendar, rolling, suffix_product)

__all__ = [
    "across", "after_high_water_mark", "as_of_latest", "assign_keys", "between_dates", "bounded_broadcast",
    "broadcast_if_small", "col_range", "complete_grid", "drop_range", "expand_grid", "fill_forward",
    "first_columns", "in_set", "latest_per_key", "listed_common_shares",
    "lookback_window", "market_calendar", "on_date", "quarter_between", "relocate", "require_columns", "rolling",
    "select_range", "suffix_product", "sym_dt_pick", "tag", "union_by_name", "unpivot_columns", "value_set",
]
