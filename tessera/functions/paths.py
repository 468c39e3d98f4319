"""Lineage columns derived from the path of the file a row was read from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: bronze layout is <base>/googlePlay/<app>_<pf|pj>/odate=<yyyyMMdd>/
APP_PATTERN = r"/googlePlay/(.*?)/odate="
SEGMENT_PATTERN = r"/googlePlay/[^/_]+_([pfj]+)/odate="


def source_path() -> Column:
    """Full path of the file each row comes from (hidden metadata column)."""
    return F.col("_metadata.file_path")


def app_from_path(path: Column) -> Column:
    """App folder name including its segment suffix; '' when not matched."""
    return F.regexp_extract(path, APP_PATTERN, 1)


def segment_from_path(path: Column) -> Column:
    """Customer segment (pf / pj) from the folder name; '' when not matched
    (including app names that contain an underscore)."""
    return F.regexp_extract(path, SEGMENT_PATTERN, 1)
