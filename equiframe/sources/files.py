"""Files and folders of stored tables, by the cluster's Hadoop file systems."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename within a file system; ``False`` if ``source`` is not there (any more)."""
    at, fs = _at(spark, source)
    to, _ = _at(spark, target)
    fs.mkdirs(to.getParent())
    try:
        return fs.rename(at, to)
    except Exception as e:
        if "FileNotFoundException" in str(e):
            return False
        raise


def same_system(spark: SparkSession, a: str, b: str) -> bool:
    return _at(spark, a)[1].getUri().equals(_at(spark, b)[1].getUri())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, ``None`` without one."""
    at, fs = _at(spark, path)
    try:
        stream = fs.open(at)
    except Exception as e:
        if "FileNotFoundException" in str(e):
            return None
        raise
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool) -> bool:
    """Write a small file; ``False`` if it exists and ``replace`` is not set."""
    at, fs = _at(spark, path)
    try:
        stream = fs.create(at, replace)
    except Exception as e:
        if "already exists" in str(e) or "FileAlreadyExists" in str(e):
            return False
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """Partition folders below ``path`` that hold files, relative to it (``year=2001``);
    ``[""]`` for a folder whose files lie in it directly."""
    at, fs = _at(spark, path)
    if not fs.exists(at):
        return []
    found = []

    def look(folder, name: str) -> None:
        files, folders = False, []
        for s in fs.listStatus(folder):
            child = s.getPath().getName()
            if s.isDirectory() and "=" in child:
                folders.append((s.getPath(), f"{name}/{child}" if name else child))
            elif s.isFile() and not child.startswith(("_", ".")):
                files = True
        if files:
            found.append(name)
        for f in folders:
            look(*f)

    look(at, "")
    return sorted(found)


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of the files directly in a folder, by name;
    those of writers still at work (``_`` or ``.`` first) are not listed."""
    at, fs = _at(spark, path)
    if not fs.exists(at):
        return []
    listed = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(at) if s.isFile()]
    return sorted(one for one in listed if not one[0].startswith(("_", ".")))


def size(spark: SparkSession, path: str) -> int:
    """Bytes below a folder."""
    at, fs = _at(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def relative_folder(spark: SparkSession, root: str, file_uri: str) -> str:
    """The partition folder, relative to ``root``, of a file's URI (as in ``_metadata.file_path``)."""
    base, fs = _at(spark, root)
    top = fs.makeQualified(base).toUri().getPath().rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(unquote(file_uri)).getParent().toUri().getPath()
    return path[len(top):].strip("/")
