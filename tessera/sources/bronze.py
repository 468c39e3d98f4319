"""Bronze review sources: schema-on-read Parquet with path lineage."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tessera.functions.paths import app_from_path, segment_from_path, source_path
from tessera.schemas import BRONZE_SCHEMA

log = logging.getLogger(__name__)

# --- fixed values: bronze layout, one glob per customer segment
SEGMENT_GLOBS = ("*_pf", "*_pj")


def is_missing_path(err: AnalysisException) -> bool:
    """True for 'path does not exist' (also raised for a glob without match)."""
    cond = getattr(err, "getCondition", None) or getattr(err, "getErrorClass", None)
    name = cond() if cond else None
    return name == "PATH_NOT_FOUND"


def read_reviews(spark: SparkSession, path: str | list[str],
                 schema: StructType = BRONZE_SCHEMA) -> DataFrame | None:
    """Read bronze Parquet with a declared schema (absent columns read as null).

    Adds ``app`` / ``segmento`` from the file path and drops ``response``.
    Returns ``None`` when the path is missing or holds no rows; any other
    error is raised.  The emptiness probe is a ``LIMIT 1`` job.
    """
    try:
        df = spark.read.schema(schema).parquet(*([path] if isinstance(path, str) else path))
    except AnalysisException as err:
        if is_missing_path(err):
            log.warning("no bronze data at %s", path)
            return None
        raise
    if df.isEmpty():
        log.warning("bronze path %s holds no rows", path)
        return None
    p = source_path()
    return (df.withColumn("app", app_from_path(p))
              .drop("response")
              .withColumn("segmento", segment_from_path(p)))


def empty_reviews(spark: SparkSession, schema: StructType = BRONZE_SCHEMA) -> DataFrame:
    """Typed empty bronze frame, including the path-derived columns."""
    fields = [f for f in schema.fields if f.name != "response"]
    fields += [StructField("app", StringType(), True), StructField("segmento", StringType(), True)]
    return spark.createDataFrame([], StructType(fields))


def segment_paths(bronze_base: str, run_date: str) -> list[str]:
    base = bronze_base.rstrip("/")
    return [f"{base}/{g}/odate={run_date}/" for g in SEGMENT_GLOBS]


def read_segments(spark: SparkSession, bronze_base: str, run_date: str,
                  schema: StructType = BRONZE_SCHEMA) -> DataFrame:
    """Union by name of the per-segment sources for one day.

    A missing segment is skipped; when both are missing a typed empty frame
    is returned (same columns), so downstream plans stay valid.
    """
    frames = [df for df in (read_reviews(spark, p, schema) for p in segment_paths(bronze_base, run_date))
              if df is not None]
    if not frames:
        return empty_reviews(spark, schema)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

