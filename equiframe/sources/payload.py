"""Landed web-service payloads -> rows.

The exchange answers with a JSON object whose *first* key holds an array of
flat records (all values text).  Payload documents are landed one per row;
the records are exploded in the executors, one document per task row, so
the work scales with the number of landed documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RECORDS_TYPE = "array<map<string,string>>"


def first_key_records(payload: Column | str) -> Column:
    """The array under the payload's first key, as ``array<map<string,string>>``
    (NULL for an empty or malformed document: ``get`` tolerates a missing
    first key under ANSI mode, where ``[0]`` would fail the job)."""
    p = F.col(payload) if isinstance(payload, str) else payload
    key = F.get(F.json_object_keys(p), 0)
    path = F.concat(F.lit("$['"), key, F.lit("']"))
    return F.from_json(F.call_function("get_json_object", p, path), RECORDS_TYPE)


def explode_payload(df: DataFrame, payload: str = "payload", fields: list[str] | None = None,
                    keep: list[str] | None = None) -> DataFrame:
    """One row per record.  ``fields`` become string columns (missing ->
    NULL); ``keep`` columns of the payload row are carried along."""
    keep = keep if keep is not None else [c for c in df.columns if c != payload]
    rows = df.select(*keep, F.explode(first_key_records(payload)).alias("_rec"))
    if fields is None:
        return rows
    return rows.select(*keep, *[F.col("_rec")[f].alias(f) for f in fields])


def explode_variant(df: DataFrame, fields: dict[str, tuple[str, str]], payload_col: str = "payload",
                    keep: list[str] | None = None) -> DataFrame:
    """S6 for records that are not flat texts: one row per record of the array
    under the payload's first key, with each field taken by its path and type
    (``{"close": ("$.px.close", "double")}``).

    The payload is parsed once, as a variant; nothing of the records' shape is
    declared beyond the fields asked for.  A payload that is no JSON object, or
    whose first key holds no array, gives no record; a record without a field,
    or with a value that does not convert, gives NULL there.  ``keep``: columns
    of ``df`` to carry along.
    """
    first = F.get(F.json_object_keys(F.col(payload_col)), F.lit(0))
    spark, keep = df.sparkSession, keep or []
    parsed = df.select(*keep, first.alias("_first"), F.try_parse_json(F.col(payload_col)).alias("_object"))
    # a variant keeps an object's keys in its own order: the first is told by the text
    arrays = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_object").outer()).select(
        F.col("key").alias("_key"), F.col("value").alias("_array"))).filter(F.col("_key") == F.col("_first"))
    # an object in the array's place would be exploded by its keys
    records = arrays.filter(F.schema_of_variant("_array").startswith("ARRAY")).lateralJoin(
        spark.tvf.variant_explode(F.col("_array").outer()).select(F.col("value").alias("_record")))
    return records.select(*keep, *[F.try_variant_get("_record", path, kind).alias(name) for name, (path, kind) in fields.items()])
