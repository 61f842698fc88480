"""Sharding by histogram sort.

Rows get a 128-bit sort key: hash of the text, then hash of the document id,
so equal texts are neighbours.  Splitters that cut the sorted order into
shards of near equal bytes are found without sorting: every round counts, in
all partitions, the exact bytes and rows below a set of candidate keys, and
narrows each splitter's bracket to the two candidates around its target, until
a candidate meets the tolerance.  Candidates first stand between texts, so a
group of equal texts is cut only where the group itself is wider than the
tolerance, and then between its documents.  With the splitters known, rows
move once.

A round sends at most ``PROBES`` sums to the driver, whatever the table.
Shards are cut further into parts of equal bytes (the same search), which are
the tasks of the exchange; exact counts below the splitters give each part its
first slot, so slots are gapless without another pass.

Defined cases: NULL text has no bytes and size 1; NULL ids take part like any
id; rows equal in id and text have one key and stay in one shard; an empty
table gives an empty result; an unused shard stays empty; other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from equiframe.llm.shared import stored

SHARDS = 8
TOLERANCE = 0.001      # of a shard's bytes
PROBES = 4096
PART_ROWS, MAX_PARTS = 20_000, 4096
_HALF = 1 << 64


def _hex(col: Column) -> Column:
    return F.lpad(F.hex(col), 16, "0")


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, key) of each row; key is 32 hex digits."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.concat(_hex(F.xxhash64(F.col(text))), _hex(F.xxhash64(F.col(doc_id).cast("long")))).alias("key"))


def _bytes_of(keys: list[int]) -> np.ndarray:
    return np.array([b"%032X" % k for k in keys], "S32")


def below(table: DataFrame, probes: list[int]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows with a key below each probe (ascending)."""
    at = _bytes_of(probes)

    def count(batches):
        size, rows = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
        for b in batches:
            k = np.searchsorted(at, np.array(b.column(0).to_pylist(), "S32"), "right")
            np.add.at(size, k, b.column(1).to_numpy())
            np.add.at(rows, k, 1)
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(size[used]), pa.array(rows[used])],
                                         names=["k", "size", "n"])

    parts = table.select("key", "size").mapInArrow(count, "k long, size long, n long")
    size, rows = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1, np.int64)
    for r in parts.groupBy("k").agg(F.sum("size").alias("size"), F.sum("n").alias("n")).collect():
        size[r.k], rows[r.k] = r["size"], r.n
    return np.cumsum(size)[:-1].tolist(), np.cumsum(rows)[:-1].tolist()


class _Bracket:
    """Where one splitter may lie: low < key <= high, with what lies below."""

    def __init__(self, target: float, tolerance: float, total: int, rows: int):
        self.target, self.tolerance = target, tolerance
        self.low, self.high = (0, 0, 0), (_HALF * _HALF, total, rows)
        self.found: tuple[int, int, int] | None = None

    def probes(self, n: int) -> list[int]:
        unit = _HALF if self.high[0] - self.low[0] > _HALF else 1
        a, b = -(-self.low[0] // unit), self.high[0] // unit
        return sorted({(a + (b - a) * i // (n + 1)) * unit for i in range(1, n + 1)} - {self.low[0], self.high[0]}
                      or {self.low[0] + (self.high[0] - self.low[0]) // 2})

    def narrow(self, counted: list[tuple[int, int, int]]) -> None:
        for c in counted:
            if self.low[0] < c[0] < self.high[0]:
                if c[1] <= self.target:
                    self.low = c
                else:
                    self.high = c
                    break
        ends = sorted((self.low, self.high), key=lambda c: abs(c[1] - self.target))
        if (abs(ends[0][1] - self.target) <= self.tolerance or self.high[0] - self.low[0] <= 1
                or self.high[2] - self.low[2] <= 1):
            self.found = ends[0]


def splitters(table: DataFrame, targets: list[tuple[float, float]], total: int, rows: int) -> list[tuple[int, int, int]]:
    """(key, bytes below, rows below) for each (target bytes, tolerance)."""
    brackets = [_Bracket(t, tol, total, rows) for t, tol in targets]
    while open_ := [b for b in brackets if b.found is None]:
        each = max(3, min(255, PROBES // len(open_)))
        probes = sorted({p for b in open_ for p in b.probes(each)})
        counted = list(zip(probes, *below(table, probes)))
        for b in open_:
            b.narrow(counted)
    return [b.found for b in brackets]


SCHEMA = "doc_id long, size long, text_crc32 long, key string, shard int, part int, first long"


def shard(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, text: str = "text",
          doc_id: str = "doc_id") -> DataFrame:
    """One row per document: size, text_crc32, shard and slot."""
    table = stored(keyed(docs, text, doc_id), "shard-keys")
    total, rows = (int(x or 0) for x in table.agg(F.sum("size"), F.count("*")).first())
    parts = max(1, min(MAX_PARTS // shards, -(-rows // (shards * PART_ROWS))))
    ideal = total / shards
    targets = [(total * i / (shards * parts), ideal * tolerance if i % parts == 0 else ideal / parts / 4)
               for i in range(1, shards * parts)]
    cuts = splitters(table, targets, total, rows) if rows else []
    for i in range(1, len(cuts)):  # a part may be empty, never negative
        cuts[i] = max(cuts[i], cuts[i - 1])
    at = _bytes_of([min(c[0], _HALF * _HALF - 1) for c in cuts])
    last = np.array([c[0] >= _HALF * _HALF for c in cuts], bool)
    begins = np.array([0] + [c[2] for c in cuts], np.int64)
    first = begins - np.repeat(begins[::parts], parts)[:len(begins)]

    def place(batches):
        for b in batches:
            k = np.searchsorted(at[~last], np.array(b.column(3).to_pylist(), "S32"), "right")
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array((k // parts).astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(first[k])],
                names=["doc_id", "size", "text_crc32", "key", "shard", "part", "first"])

    rank = F.row_number().over(Window.partitionBy("part").orderBy("key", "doc_id", "size", "text_crc32"))
    return (table.mapInArrow(place, SCHEMA).withColumn("slot", F.col("first") + rank - 1)
                 .select("doc_id", "size", "text_crc32", "shard", "slot"))
