"""Scalar Column functions (all JVM built-ins, no Python UDFs)."""

from equiframe.functions.dates import (cutoff_date, date_quarter_string, is_q4, parse_yyyymmdd, quarter_number,
                                       quarter_ordinal, quarter_string, quarter_year,
                                       report_quarter, report_year)
from equiframe.functions.numeric import (all_differ_from, any_not_null, first_non_null,
                                         round_half_even, safe_div)
from equiframe.functions.text import (market_letters, null_if_equal, parse_number,
                                      quarter_label, recode_exact, remove_dashes, sector_recode,
                                      strip_prefix, unite)

__all__ = [
    "all_differ_from", "any_not_null", "cutoff_date", "date_quarter_string",
    "first_non_null", "is_q4", "market_letters", "null_if_equal",
    "parse_number", "parse_yyyymmdd", "quarter_label", "quarter_number",
    "quarter_ordinal", "quarter_string", "quarter_year", "recode_exact", "remove_dashes",
    "report_quarter", "report_year", "round_half_even", "safe_div", "sector_recode",
    "strip_prefix", "unite",
]
