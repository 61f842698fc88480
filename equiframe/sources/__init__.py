"""Scans, landed-payload and vendor normalisers, and table writes."""

from equiframe.sources.payload import explode_payload, first_key_records
from equiframe.sources.sinks import (delete_where, finish_swap, read_if_present, replace_partition,
                                     replace_partition_values, replace_partitions, upsert_partial,
                                     upsert_table)
from equiframe.sources.tables import TableStore, read_parquet
from equiframe.sources.vendor import cross_section, fiscal_basis, item_list, item_metadata, item_rows

__all__ = [
    "TableStore", "cross_section", "delete_where", "explode_payload", "first_key_records", "fiscal_basis",
    "finish_swap", "item_list", "item_metadata", "item_rows", "read_if_present", "read_parquet",
    "replace_partition", "replace_partition_values", "replace_partitions", "upsert_partial", "upsert_table",
]
