"""Date-partitioned Parquet sink that replaces one partition per run."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from tessera.schemas import PARTITION_COLUMN

log = logging.getLogger(__name__)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast integer and string fields to the schema, pass others through, and
    select the schema's columns in its order (one projection)."""
    cols = []
    for f in schema.fields:
        if isinstance(f.dataType, (IntegerType, StringType)):
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def save_partitioned(
    df: DataFrame,
    path: str,
    run_date: str,
    label: str = "data",
    schema: StructType | None = None,
    partition_column: str = PARTITION_COLUMN,
    compression: str = "snappy",
) -> int:
    """Write ``df`` under ``path/<partition_column>=<run_date>/``.

    The run's partition folder is overwritten as a whole, so other days
    survive and a rerun of the same day is idempotent: an empty frame leaves
    an empty partition (a file with the schema and no rows), never the rows of
    an earlier run.  The count comes from the written files' footers, which a
    task that ran twice cannot distort.  Errors are raised, not swallowed.
    """
    if not isinstance(df, DataFrame):
        raise TypeError(f"expected a DataFrame, got {type(df).__name__}")
    if not path:
        raise ValueError("destination path must not be empty")
    if schema is not None:
        df = conform(df, schema)
    if partition_column in df.columns:
        df = df.drop(partition_column)
    folder = f"{path.rstrip('/')}/{partition_column}={run_date}"
    df.write.option("compression", compression).mode("overwrite").parquet(folder)
    rows = df.sparkSession.read.schema(df.schema).parquet(folder).count()
    log.info("wrote %d %s rows to %s", rows, label, folder)
    return rows
