"""What the operators of this subpackage share: the cluster's shared folder,
stored intermediate tables and files that tasks read or write themselves.

Every intermediate lives under ``spark.checkpoint.dir`` (read from the
session by :func:`equiframe.session.checkpoint_dir`), so a lost executor costs
only its own tasks.
"""

from __future__ import annotations

import gc
import mmap
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.session import checkpoint_dir

#: Rows without an id sort after every other row.
NO_ID = (1 << 63) - 1


_SHIPPED: set[str] = set()
BATCH_ROWS = "2500"    # texts in an Arrow batch, unless the session says otherwise; Spark ends one at 64 MiB too


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers of the session's executors, once
    an application (as ``--py-files`` does for a submitted job), and keep
    Arrow batches of texts small, for the workers' memory."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows, None) is None:
        spark.conf.set(rows, BATCH_ROWS)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        made = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(made, "w") as out:
            for f in sorted(package.rglob("*.py")):
                out.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(made))
        _SHIPPED.add(app)


def shared_path(spark: SparkSession, name: str) -> str:
    """A folder of its own for each call, in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/equiframe-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here
    and nothing above is computed twice.  ``release``: its shuffles were large;
    collect the driver's garbage, so that Spark's cleaner deletes their files
    now and not when the driver next runs short of memory."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    if release:
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def or_last(col: Column) -> Column:
    """An integer id as long, NULL as the largest long."""
    return F.coalesce(col.cast("long"), F.lit(NO_ID))


def not_last(col: Column) -> Column:
    """Inverse of :func:`or_last`."""
    return F.nullif(col, F.lit(NO_ID))


def filesystem(uri: str):
    """(pyarrow file system, path in it) of a folder or file of the shared
    folder, usable in tasks and on the driver."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """Write one file; parents are made as needed."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        out.write(data)


def map_file(uri: str, dtype, count: int = -1, offset: int = 0) -> np.ndarray:
    """The numbers of a binary file: memory-mapped where the shared folder is
    a mounted one, else read by one range request."""
    from pyarrow import fs as pafs

    fs, path = filesystem(uri)
    size = np.dtype(dtype).itemsize
    if isinstance(fs, pafs.LocalFileSystem):
        with open(path, "rb") as f:
            f.seek(0, 2)
            if f.tell() == 0 or count == 0:
                return np.empty(0, dtype)
            whole = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        return np.frombuffer(whole, dtype, count, offset)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        return np.frombuffer(f.read(count * size if count >= 0 else None), dtype)
