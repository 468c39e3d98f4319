"""Earlier silver partitions read back as history."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from tessera.schemas import HISTORY_READ_SCHEMA, PARTITION_COLUMN
from tessera.sinks.publish import current, plain_partitions, read_table

log = logging.getLogger(__name__)

# Columns the merge needs from history: the change history stored in earlier
# partitions is rebuilt every day, so it is never read (column pruning).
HISTORY_COLUMNS = ["id", "app", "segmento", "rating", "iso_date", "title", "snippet", PARTITION_COLUMN]


def empty_history(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], HISTORY_READ_SCHEMA).select(*HISTORY_COLUMNS)


def read_history(spark: SparkSession, silver_path: str, run_date: str | None = None) -> DataFrame:
    """All ``odate`` partitions of the silver table strictly before ``run_date``.

    Published partitions come from the newest commit, plain ones by partition
    discovery (``odate`` stays a string column, as declared in the schema).
    The cut-off compares the partition string (yyyyMMdd sorts as text), so
    later partitions are never read.  A missing table gives a typed empty frame.
    """
    df = read_table(spark, silver_path, HISTORY_READ_SCHEMA, before=run_date)
    if df is None:
        log.warning("no history at %s", silver_path)
        return empty_history(spark)
    return df.select(*HISTORY_COLUMNS)


def history_exists(spark: SparkSession, silver_path: str) -> bool:
    """Does the silver table exist and have at least one ``odate`` partition?  Names alone are looked at."""
    return bool(current(spark, silver_path).partitions or plain_partitions(spark, silver_path))
