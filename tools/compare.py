"""Local stand-in for the driver's correctness gate.

Runs Spark frames and DuckDB SQL on the same sf dir and compares row count,
column names and an order-insensitive multiset of rows.
"""

from __future__ import annotations

import math
import sys

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if v.is_integer() and abs(v) < 2 ** 53:
            return str(int(v))
        return repr(v)
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) >= 10 and str(v)[10:].strip("0: ") == "" else str(v)
    return str(v)


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records")]
    return sorted(out, key=lambda t: tuple("" if x is None else x for x in t))


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def type_mismatches(spark_schema, duck_relation) -> dict[str, tuple[str, str]]:
    """Columns whose Spark type differs from the DuckDB result type."""
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
         for f in spark_schema.fields}
    d = {c: str(t) for c, t in zip(duck_relation.columns, duck_relation.types)}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame, show: int = 5) -> tuple[bool, str]:
    if sorted(spark_pdf.columns) != sorted(duck_pdf.columns):
        return False, f"columns differ: {sorted(spark_pdf.columns)} vs {sorted(duck_pdf.columns)}"
    if len(spark_pdf) != len(duck_pdf):
        return False, f"row count {len(spark_pdf)} vs {len(duck_pdf)}"
    a, b = rows(spark_pdf), rows(duck_pdf)
    if a == b:
        return True, f"{len(a)} rows equal"
    sa, sb = pd.Series(a).value_counts(), pd.Series(b).value_counts()
    only_a = [r for r in sa.index if sb.get(r, 0) != sa[r]]
    only_b = [r for r in sb.index if sa.get(r, 0) != sb[r]]
    cols = sorted(spark_pdf.columns)
    return False, (f"{len(only_a)} differing rows; cols={cols}\n spark: {only_a[:show]}\n duck:  {only_b[:show]}")


if __name__ == "__main__":
    print("use from python", file=sys.stderr)
