"""Co-located copies of stored tables: bucketed by a key, partitioned by year.

A join of two copies with the same number of buckets on their key needs no
exchange, and a range of days still reads its years only.  The copies are
ordinary bucketed Spark tables over files below the store; the catalog may be
the session's own in-memory one, as a copy's definition (key, buckets, schema,
a folder and a stamp for each year) lies beside its files in ``layout-N.json``
and is declared anew where it is not known.

A stamp names a year's stored files as they were when they were copied.  A
copy whose stamps are not those of the stored table is not used, and
``write_copy`` rewrites the years whose stamps differ, into folders of their
own: a reader of the layout before keeps its files until the next but one.
"""

from __future__ import annotations

import hashlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from equiframe.sources import files
from equiframe.sources.sinks import read_table, swap_pending

YEAR = "year"


def stamps(spark: SparkSession, path: str) -> dict[str, str]:
    """Year -> a digest of the names, sizes and times of its stored files."""
    out = {}
    for folder in files.partition_folders(spark, path):
        if not folder.startswith(f"{YEAR}=") or "/" in folder:
            raise ValueError(f"{path} is not partitioned by {YEAR} alone: {folder!r}")
        listed = json.dumps(files.data_files(spark, f"{path}/{folder}"))
        out[folder.split("=", 1)[1]] = hashlib.md5(listed.encode()).hexdigest()
    return out


def _layouts(spark: SparkSession, copy: str) -> list[tuple[int, dict]]:
    """The numbered layouts of a copy, oldest first."""
    names = [name for name, *_ in files.data_files(spark, copy) if name.startswith("layout-") and name.endswith(".json")]
    numbered = sorted((int(name[len("layout-"):-len(".json")]), name) for name in names)
    return [(n, json.loads(files.read_text(spark, f"{copy}/{name}"))) for n, name in numbered]


def layout(spark: SparkSession, copy: str) -> dict | None:
    """The newest layout of a copy, ``None`` without one."""
    known = _layouts(spark, copy)
    return known[-1][1] if known else None


def write_copy(spark: SparkSession, path: str, copy: str, key: str, buckets: int) -> list[str]:
    """Bring the copy of the stored table ``path`` up to date; the years
    rewritten.  Rows are shuffled once on the key, so that a year has one file
    a bucket."""
    if buckets < 1:
        raise ValueError("buckets must be >= 1")
    known = _layouts(spark, copy)
    old = known[-1][1] if known else None
    want = stamps(spark, path)
    rows = read_table(spark, path)
    if rows is None:
        raise ValueError(f"{path} has no data to copy")
    fields = json.loads(rows.schema.json())
    same = old is not None and (old["key"], old["buckets"], old["schema"]) == (key, buckets, fields)
    kept = {y: v for y, v in old["years"].items() if want.get(y) == v["stamp"]} if same else {}
    changed = sorted(y for y in want if y not in kept)
    if same and not changed and len(kept) == len(old["years"]):
        return []
    years = dict(kept)
    if changed:
        folder, name = f"{copy}/{uuid.uuid4().hex}", f"copy_{uuid.uuid4().hex}"
        (rows.filter(F.col(YEAR).isin([int(y) for y in changed])).repartition(buckets, key)
             .write.format("parquet").partitionBy(YEAR).bucketBy(buckets, key).sortBy(key)
             .option("path", folder).saveAsTable(name))
        spark.sql(f"DROP TABLE {name}")  # its files stay
        years.update({y: {"stamp": want[y], "folder": f"{folder}/{YEAR}={y}"} for y in changed})
    new = {"key": key, "buckets": buckets, "schema": fields, "years": years}
    text, number = f"{copy}/.{uuid.uuid4().hex}", known[-1][0] + 1 if known else 1
    files.write_text(spark, text, json.dumps(new), replace=False)
    if not files.move(spark, text, f"{copy}/layout-{number:06d}.json"):
        raise RuntimeError(f"another writer made layout {number} of {copy}")
    # the layout before may still be read; those before it and their folders go
    used = {v["folder"] for one in (new, old or new) for v in one["years"].values()}
    for n, one in known[:-1]:
        for v in one["years"].values():
            if v["folder"] not in used:
                files.delete(spark, v["folder"])
        files.delete(spark, f"{copy}/layout-{n:06d}.json")
    return changed


def read_copy(spark: SparkSession, path: str, copy: str) -> DataFrame | None:
    """The copy as a bucketed table; ``None`` if it is not of the stored
    table as it is now (never copied, changed since, or amid a swap)."""
    known = _layouts(spark, copy)
    if not known or swap_pending(spark, path):
        return None
    number, made = known[-1]
    if {y: v["stamp"] for y, v in made["years"].items()} != stamps(spark, path):
        return None
    name = "by_key_" + hashlib.md5(f"{copy} {number} {json.dumps(made)}".encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        def quoted(text: str) -> str:
            return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

        fields = T.StructType.fromJson(made["schema"]).fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({YEAR}) "
                  f"CLUSTERED BY (`{made['key']}`) SORTED BY (`{made['key']}`) INTO {made['buckets']} BUCKETS "
                  f"LOCATION {quoted(copy)}")
        if made["years"]:
            spark.sql(f"ALTER TABLE {name} ADD " + " ".join(
                f"PARTITION ({YEAR}={int(y)}) LOCATION {quoted(v['folder'])}" for y, v in sorted(made["years"].items())))
    return spark.table(name)
