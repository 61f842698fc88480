"""Keyed partial-column upsert, predicate delete, partition replace.

The DataFrame forms (``upsert_partial``, ``delete_where``,
``replace_partition``) return the new table contents and are what the
queries use.  ``upsert_table`` / ``delete_rows`` / ``replace_partitions`` write
them: only the partitions that change are read, their new rows are staged
under the cluster's checkpoint folder and swapped in, so a Parquet path is
never overwritten while it is being read.

A swap survives a lost driver.  Once the staged rows are complete, a marker
beside the table names them, the partition folders they replace and those that
have no row any more.  From then on the new rows are the table: ``read_table``
reads the folders that are still staged from there, so readers never write and
see whole partitions.  Only a writer that holds the table's lease (its own
swap's, or one that takes a lost writer's over) moves folders
(``finish_swap``); moving can be repeated any number of times.
"""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.session import checkpoint_dir
from equiframe.sources import files
from equiframe.sources.lease import lease


def upsert_partial(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """S3: match on ``keys``; matched rows take the *supplied* source
    columns (a supplied NULL overwrites) and keep the others; unmatched
    source rows are inserted with the missing columns NULL.  Output has the
    target's columns in the target's order.

    One full outer join on the keys (each side shuffled once on the keys;
    AQE splits a skewed key).  Source keys are expected to be unique, as in a
    keyed table (``unique_by_key`` makes them so).
    """
    missing = [k for k in keys if k not in target.columns or k not in source.columns]
    if missing:
        raise ValueError(f"upsert keys {missing} must be columns of both target and source")
    supplied = [c for c in source.columns if c not in keys and c in target.columns]
    t = target.select(*[F.col(c).alias(c if c in keys else f"_t_{c}") for c in target.columns])
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in supplied], F.lit(True).alias("_src"))
    j = t.join(s, on=keys, how="full_outer")
    out: list[Column] = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in supplied:
            out.append(F.when(F.col("_src"), F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*out)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Drop rows where ``predicate`` is TRUE (a NULL predicate keeps the
    row, as SQL ``DELETE ... WHERE``)."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def replace_partition(target: DataFrame, new_rows: DataFrame, predicate: Column) -> DataFrame:
    """Every target row matching ``predicate`` is replaced by
    ``new_rows`` (delete + insert, as the yearly calendar refresh)."""
    kept = delete_where(target, predicate)
    return kept.unionByName(new_rows.select(*target.columns))


def replace_partition_values(target: DataFrame, new_rows: DataFrame, part: Column,
                             values: DataFrame) -> DataFrame:
    """S5 with the partitions named by data: rows of ``target`` whose
    ``part`` value is in ``values`` (one column) are replaced by the rows of
    ``new_rows`` with such a value.  The value set (years, days) is small;
    Spark picks the join by its size."""
    vals = values.select(F.col(values.columns[0]).alias("_part")).distinct()
    kept = target.withColumn("_part", part).join(vals, on="_part", how="left_anti").drop("_part")
    fresh = new_rows.withColumn("_part", part).join(vals, on="_part", how="left_semi").drop("_part")
    return kept.unionByName(fresh.select(*target.columns))


def _staging(spark: SparkSession, staging_root: str | None) -> str:
    """A folder of one write's own: its ``source``, new ``rows`` and marker."""
    root = staging_root or checkpoint_dir(spark)
    return f"{root.rstrip('/')}/staging-{uuid.uuid4().hex}"


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, or ``None`` when nothing readable was written yet
    (missing folder, or an empty partitioned write that left no files)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class ConflictingRows(ValueError):
    """Rows to store share a key and differ."""


_CONFLICT = "rows to store share a key and differ: "


def unique_by_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of equal key counted once; where they differ, the job that reads
    the result fails and names the key.  One aggregate, partial before its
    shuffle, so a key that stands very often is no hot task."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    both = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_lo"), F.max(F.struct(*rest)).alias("_hi"))
    name = F.concat(F.lit(_CONFLICT), F.to_json(F.struct(*keys)))
    one = F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_lo")).otherwise(F.raise_error(name))
    return both.select(*keys, one.alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def _marker(path: str) -> str:
    return f"{path.rstrip('/')}._swap"


def _read_marker(spark: SparkSession, path: str) -> dict | None:
    """What a swap is to do; ``None`` without one.  A marker appears whole, by a rename."""
    text = files.read_text(spark, _marker(path))
    return None if text is None else json.loads(text)


def _join(root: str, folder: str) -> str:
    return f"{root.rstrip('/')}/{folder}" if folder else root.rstrip("/")


def _read_folders(spark: SparkSession, root: str, folders: list[str]) -> DataFrame | None:
    """Some partitions of the table at ``root``, with their partition columns."""
    if not folders:
        return None
    return spark.read.option("basePath", root).parquet(*[_join(root, f) for f in folders])


def swap_pending(spark: SparkSession, path: str) -> bool:
    """Whether a writer's rows are complete and not all of them moved into place."""
    return _read_marker(spark, path) is not None


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored table, ``None`` if there are no rows or it was never written.
    Writes nothing: folders that a swap has staged, but not moved yet, are read
    where they are."""
    swap = _read_marker(spark, path)
    if swap is None:
        return read_if_present(spark, path)
    waiting = [f for f in swap["moves"] if files.exists(spark, _join(swap["stage"], f))]
    gone = {*waiting, *swap["drops"]}
    parts = [_read_folders(spark, path, [f for f in files.partition_folders(spark, path) if f not in gone]),
             _read_folders(spark, swap["stage"], waiting)]
    parts = [p for p in parts if p is not None]
    if len(parts) == 2:
        return parts[0].unionByName(parts[1], allowMissingColumns=True)
    return parts[0] if parts else None


def finish_swap(spark: SparkSession, path: str) -> None:
    """Do, or finish, the swap that the marker beside the table names, if there is one."""
    if not files.exists(spark, _marker(path)):
        return
    with lease(spark, path) as held:
        swap = _read_marker(spark, path)
        if swap is None:
            return
        held.check()
        stage, waiting = swap["stage"], [f for f in swap["moves"] if files.exists(spark, _join(swap["stage"], f))]
        if files.same_system(spark, stage, path):
            for f in waiting:
                files.delete(spark, _join(path, f))
                files.move(spark, _join(stage, f), _join(path, f))
        elif waiting:  # staged in another file system: written once more
            parts = swap["partition_by"]
            (spark.read.parquet(stage).write.mode("overwrite")
                  .option("partitionOverwriteMode", "dynamic" if parts else "static").partitionBy(*parts).parquet(path))
        for f in swap["drops"]:
            files.delete(spark, _join(path, f))
        files.delete(spark, _marker(path))
        files.delete(spark, swap["staging"])


def _swap(spark: SparkSession, path: str, staging: str, partition_by: list[str], drops: list[str] | None = None) -> None:
    """Put the complete staged rows in place of the table's partitions, and
    remove the partition folders ``drops``."""
    stage = f"{staging}/rows"
    moves = files.partition_folders(spark, stage)
    if not moves and not drops:  # nothing touched
        files.delete(spark, staging)
        return
    swap = {"staging": staging, "stage": stage, "partition_by": partition_by, "moves": moves, "drops": drops or []}
    whole = f"{_marker(path)}-{uuid.uuid4().hex}"
    files.write_text(spark, whole, json.dumps(swap), replace=False)
    files.move(spark, whole, _marker(path))
    finish_swap(spark, path)


def _staged(spark: SparkSession, rows: DataFrame, staging: str, name: str, partition_by: list[str], order: list[str]) -> None:
    # sorted files give tight row-group min/max stats on the lookup key
    rows = rows.sortWithinPartitions(*order) if order else rows
    try:
        rows.write.partitionBy(*partition_by).parquet(f"{staging}/{name}")
    except PySparkException as e:
        files.delete(spark, staging)
        if _CONFLICT in str(e):
            raise ConflictingRows(_CONFLICT + str(e).split(_CONFLICT, 1)[1].splitlines()[0]) from None
        raise


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                 partition_by: list[str] | None = None, staging_root: str | None = None,
                 sort_within: list[str] | None = None, unique: bool = False) -> None:
    """S3 on a stored Parquet table.

    ``source`` is computed once: its rows of equal key are counted once (rows
    that differ are an error, ``ConflictingRows``), unless the caller knows
    them ``unique``.  With ``partition_by`` (columns of both target and source)
    it is stored by partition first; only the partitions it then has are read
    from the target, by their folders, and rewritten.
    """
    partition_by = partition_by or []
    order = [*partition_by, *(sort_within or [])]
    source = source if unique else unique_by_key(source, keys)
    with lease(spark, path):
        finish_swap(spark, path)
        target = read_if_present(spark, path)
        stage = _staging(spark, staging_root)
        if target is not None and partition_by:
            _staged(spark, source, stage, "source", partition_by, [])
            touched = files.partition_folders(spark, f"{stage}/source")
            source = _read_folders(spark, f"{stage}/source", touched)
            if source is None:
                files.delete(spark, stage)
            else:
                there = set(files.partition_folders(spark, path))
                hit = _read_folders(spark, path, [f for f in touched if f in there])
                target = (hit if hit is not None else spark.createDataFrame([], target.schema)).select(*target.columns)
                _staged(spark, upsert_partial(target, source, keys), stage, "rows", partition_by, order)
                _swap(spark, path, stage, partition_by)
            return
        _staged(spark, source if target is None else upsert_partial(target, source, keys), stage, "rows", partition_by, order)
        _swap(spark, path, stage, partition_by)


def delete_rows(spark: SparkSession, path: str, predicate: Column, partition_by: list[str] | None = None,
                staging_root: str | None = None, sort_within: list[str] | None = None) -> None:
    """S4 on a stored table: rows where ``predicate`` is TRUE go (a NULL
    predicate keeps the row).

    A first pass reads the predicate's columns -- of the partitions and row
    groups it can hit, by pruning and pushed filters -- and names the folders
    that hold such rows.  Only those are rewritten; a folder that keeps no row
    is removed.
    """
    partition_by = partition_by or []
    order = [*partition_by, *(sort_within or [])]
    with lease(spark, path):
        finish_swap(spark, path)
        table = read_if_present(spark, path)
        if table is None:
            return
        stage = _staging(spark, staging_root)
        if not partition_by:
            _staged(spark, delete_where(table, predicate), stage, "rows", [], order)
            _swap(spark, path, stage, [])
            return
        # one row per partition folder (years, days): a bounded set
        hit = table.filter(predicate).select(
            F.regexp_replace(F.col("_metadata.file_path"), "[^/]*$", "x").alias("f")).distinct().collect()
        folders = sorted(files.relative_folder(spark, path, r["f"]) for r in hit)
        if not folders:
            return
        kept = delete_where(_read_folders(spark, path, folders), predicate)
        _staged(spark, kept, stage, "rows", partition_by, order)
        left = set(files.partition_folders(spark, f"{stage}/rows"))
        _swap(spark, path, stage, partition_by, drops=[f for f in folders if f not in left])


def replace_partitions(spark: SparkSession, path: str, new_rows: DataFrame, partition_by: list[str],
                       staging_root: str | None = None) -> None:
    """S5 on a stored table: the partitions present in ``new_rows`` are
    replaced wholesale, others untouched."""
    with lease(spark, path):
        finish_swap(spark, path)
        stage = _staging(spark, staging_root)
        _staged(spark, new_rows, stage, "rows", partition_by, [])
        _swap(spark, path, stage, partition_by)
