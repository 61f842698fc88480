"""Text scalar functions (X1-X7, X12, P7, P8).  All are Column -> Column
built from ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# ---------------------------------------------------------------------------

# KRX industry names -> sector names used by the vendor (anchored, exact
# match; unmatched names stay as they are).
SECTOR_RECODE = {
    "음식료·담배": "음식료품",
    "섬유·의류": "섬유의복",
    "종이·목재": "종이목재",
    "출판·매체복제": "종이목재",
    "제약": "의약품",
    "비금속": "비금속광물",
    "금속": "철강금속",
    "기계·장비": "기계",
    "일반전기전자": "전기전자",
    "의료·정밀기기": "의료정밀",
    "운송장비·부품": "운수장비",
    "기타제조": "기타제조업",
    "전기·가스·수도": "전기가스업",
    "건설": "건설업",
    "유통": "유통업",
    "숙박·음식": "서비스업",
    "운송": "운수창고업",
    "금융": "기타금융",
    "기타서비스": "서비스업",
    "오락·문화": "서비스업",
    "통신서비스": "통신업",
    "방송서비스": "서비스업",
    "인터넷": "서비스업",
    "디지털컨텐츠": "서비스업",
    "소프트웨어": "서비스업",
    "컴퓨터서비스": "서비스업",
    "통신장비": "전기전자",
    "정보기기": "전기전자",
    "반도체": "전기전자",
    "IT부품": "전기전자",
}

# Index market names -> one-letter market code, replaced inside the text in
# this order.
MARKET_LETTERS = [("KRX", "X"), ("KOSPI", "P"), ("KOSDAQ", "Q"), ("테마", "T")]

# Index-level market codes -> market letter (index_daily).
MARKET_CODE_LETTER = {"01": "X", "02": "P", "03": "Q", "04": "T"}

# Managed-status column names -> integer type code; the status text that
# means "not managed".
MANAGED_TYPE_CODE = {"sym_mng": 1, "sym_stop": 2, "sym_reg": 3}
MANAGED_NORMAL = "정상"

# Vendor quarter labels -> quarter; both half-year spellings are accepted.
QUARTER_LABEL = {
    "1st-Quarter": "Q1",
    "Semi-Annual": "Q2",
    "Semi-Quarter": "Q2",
    "3rd-Quarter": "Q3",
    "Annual": "Q4",
}

# Word marking special-purpose acquisition companies in a listing name.
SPAC_WORD = "스팩"

# The first number in a text: optional minus, digits with thousands commas,
# optional fraction; or a bare fraction.
NUMBER_PATTERN = r"-?[0-9][0-9,]*([.][0-9]+)?|-?[.][0-9]+"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(c) -> Column:
    """First number in the text, thousands commas ignored.

    Text without a number -- including the vendor's NA, NaN, NULL, N/A, empty
    text and a lone ``-`` -- gives NULL (``try_cast`` of the empty match).
    """
    hit = F.regexp_extract(_col(c).cast("string"), NUMBER_PATTERN, 0)
    return F.regexp_replace(hit, ",", "").try_cast("double")


def strip_prefix(c, n: int = 1) -> Column:
    """Drop the first ``n`` characters (vendor ``A005930`` -> ``005930``)."""
    return F.substring(_col(c), n + 1, 1 << 30)


def remove_dashes(c) -> Column:
    """``2023-01-02`` -> ``20230102``."""
    return F.replace(_col(c), F.lit("-"), F.lit(""))


def recode_exact(c, mapping: dict) -> Column:
    """Exact-match dictionary recode; unmatched values are kept."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.coalesce(m[_col(c)], _col(c))


def sector_recode(c) -> Column:
    return recode_exact(c, SECTOR_RECODE)


def market_letters(c) -> Column:
    """Unanchored sequential replace of market names by letters."""
    out = _col(c)
    for name, letter in MARKET_LETTERS:
        out = F.replace(out, F.lit(name), F.lit(letter))
    return out


def quarter_label(c) -> Column:
    """Vendor quarter label -> ``Qn``; unknown labels stay as given."""
    return recode_exact(c, QUARTER_LABEL)


def unite(cols: list, sep: str = "") -> Column:
    """Concatenate with separator; NULL parts print as ``NA``."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("NA")) for c in cols])


def null_if_equal(c, value) -> Column:
    """NULL where the column equals ``value``."""
    return F.nullif(_col(c), F.lit(value))
