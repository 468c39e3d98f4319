"""Small files beside a table, through the file system that Spark itself uses for the path."""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import SparkSession

_MOVING = threading.Lock()


def _system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def listing(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, where = _system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def modified(spark: SparkSession, path: str) -> int:
    """Milliseconds since 1970 of the last change."""
    fs, where = _system(spark, path)
    return fs.getFileStatus(where).getModificationTime()


def file_sizes(spark: SparkSession, folder: str) -> list[int]:
    """Bytes of the data files of a folder."""
    fs, where = _system(spark, folder)
    return [s.getLen() for s in fs.listStatus(where) if s.isFile() and not s.getPath().getName().startswith(("_", "."))] if fs.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A file's text; None if there is no such file (any more)."""
    fs, where = _system(spark, path)
    try:
        stream = fs.open(where)
    except Exception as err:
        if "FileNotFound" in str(err):
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Add a file that must not be there yet; False if it is.

    The text is written under another name and moved, so the file appears
    whole.  The move fails if the name is taken; that is atomic in the file
    systems of clusters, and the lock makes it so within this process for local ones.
    """
    jvm = spark.sparkContext._jvm
    folder, _, name = path.rpartition("/")
    fs, aside = _system(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(aside)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    where = jvm.org.apache.hadoop.fs.Path(path)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        with _MOVING:
            context.rename(fs.makeQualified(aside), fs.makeQualified(where), options)
        return True
    except Exception as err:
        if "AlreadyExists" not in str(err):
            raise
        return False
    finally:
        fs.delete(aside, False)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _system(spark, path)
    fs.delete(where, True)
