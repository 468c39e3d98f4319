"""Bronze files whose types have drifted from the declared schema, or that are no Parquet files.

A scan with one declared schema fails as a whole where a collector wrote a
column in another type, or a file broke off.  Here the files are sorted into
groups that Spark can merge into one schema.  ``mergeSchema`` reads the
footers of a group in a job of its own, so a clean folder costs one such job;
a group that does not merge is halved, and the halves that merge are joined
again, so k odd files among n cost about k log n jobs and nothing is looked at on the driver but names.  Each group is read
with its own types and cast to the declared ones; a value that does not fit
becomes null.  Files without a readable footer are listed.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StructType

from tessera.functions.paths import app_from_path, segment_from_path, source_path
from tessera.schemas import BRONZE_SCHEMA
from tessera.sources.bronze import empty_reviews, is_missing_path, segment_paths

log = logging.getLogger(__name__)

UNREADABLE_SCHEMA = "path string, error string"


@dataclass(frozen=True)
class FileGroup:
    """Files that merge into one schema; ``schema`` is None for one that is not readable."""
    files: tuple[str, ...]
    schema: StructType | None
    error: str = ""


def list_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Names of the files under the paths, from listings alone; none if a path does not exist."""
    out: list[str] = []
    for p in [path] if isinstance(path, str) else path:
        try:
            out += spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(p).inputFiles()
        except PySparkException as err:
            if not is_missing_path(err):
                raise
    return sorted(out)


def _merged(spark: SparkSession, files: list[str]) -> tuple[StructType | None, str]:
    try:
        return spark.read.option("mergeSchema", "true").parquet(*files).schema, ""
    except Exception as err:  # types that do not merge, or a footer that cannot be read; a single file tells which
        causes = [x.split("Caused by: ", 1)[1] for x in str(err).splitlines() if "Caused by: " in x]
        return None, (causes[-1] if causes else str(err).splitlines()[0])[:500]


def file_groups(spark: SparkSession, files: list[str]) -> list[FileGroup]:
    """The files in as few groups of one schema as their order allows, unreadable ones each for itself."""
    if not files:
        return []
    schema, error = _merged(spark, files)
    if schema is not None:
        return [FileGroup(tuple(files), schema)]
    if len(files) == 1:
        return [FileGroup(tuple(files), None, error)]
    half = len(files) // 2
    return _joined([*file_groups(spark, files[:half]), *file_groups(spark, files[half:])])


def _types(schema: StructType) -> frozenset:
    return frozenset((f.name, f.dataType.simpleString()) for f in schema.fields)


def _joined(groups: list[FileGroup]) -> list[FileGroup]:
    """Readable groups of equal columns and types as one."""
    out: dict[object, FileGroup] = {}
    for g in groups:
        key = _types(g.schema) if g.schema is not None else g.files
        out[key] = FileGroup((*out[key].files, *g.files), g.schema) if key in out else g
    return list(out.values())


def _as_declared(df: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns; plain values cast where they can be, all else that is not of the declared type null."""
    held = {f.name: f.dataType for f in df.schema.fields}

    def column(f):
        have = held.get(f.name)
        if have == f.dataType:
            return F.col(f.name)
        if isinstance(have, AtomicType) and isinstance(f.dataType, AtomicType):
            return F.col(f.name).try_cast(f.dataType).alias(f.name)
        return F.lit(None).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields], source_path().alias("_path"))


def read_segments_drifting(spark: SparkSession, bronze_base: str, run_date: str, schema: StructType = BRONZE_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(rows, unreadable) of all segments of one day; a typed empty frame if there are no rows."""
    rows, unreadable = read_drifting(spark, segment_paths(bronze_base, run_date), schema)
    return (rows if rows is not None else empty_reviews(spark, schema)), unreadable


def read_drifting(spark: SparkSession, path: str | list[str], schema: StructType = BRONZE_SCHEMA) -> tuple[DataFrame | None, DataFrame]:
    """(rows, unreadable): bronze rows as ``read_reviews`` gives them, whatever types the files have, and (path, error) of files that are not readable.

    Absent columns read as null.  The rows are None if no file is readable or none holds a row.
    """
    groups = file_groups(spark, list_files(spark, path))
    lost = [(f, g.error) for g in groups if g.schema is None for f in g.files]
    for name, error in lost:
        log.warning("unreadable bronze file %s: %s", name, error)
    unreadable = spark.createDataFrame(lost, UNREADABLE_SCHEMA)
    rows = None
    for g in groups:
        if g.schema is not None:
            part = _as_declared(spark.read.schema(g.schema).parquet(*g.files), schema)
            rows = part if rows is None else rows.unionByName(part)
    if rows is None or rows.isEmpty():
        return None, unreadable
    out = rows.drop("response").withColumns({"app": app_from_path(F.col("_path")), "segmento": segment_from_path(F.col("_path"))})
    return out.drop("_path"), unreadable
