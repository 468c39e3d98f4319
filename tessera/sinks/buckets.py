"""Files in buckets by a column, written and read without a lasting catalog entry.

Spark knows buckets by a table's definition alone, so a table of a passing name is
defined over the folder, for the write and again for a read, and dropped at once;
it is an external one, whose files stay.  A scan of such files is partitioned by
the column: a grouping or a join on it needs no exchange, nor does one on the union
of several folders with the same number of buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tessera.session import settings


def _name() -> str:
    return f"tessera_{uuid.uuid4().hex}"


def write_buckets(df: DataFrame, folder: str, buckets: int, by: str, compression: str = "snappy") -> None:
    """One file for each bucket, sorted by the column.

    Rows out of as many buckets need no exchange; their scan must then be one of
    buckets, which Spark by itself gives up where nothing but the write asks for it.
    """
    name = _name()
    try:
        with settings(df.sparkSession, spark__sql__sources__bucketing__autoBucketedScan__enabled="false"):
            (df.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by).option("path", folder).option("compression", compression)
               .format("parquet").saveAsTable(name))
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def read_buckets(spark: SparkSession, folder: str, schema: StructType, buckets: int, by: str) -> DataFrame:
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    where = folder.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{where}'")
    try:
        df = spark.table(name)
        df.schema  # resolved now, so that the definition may go
        return df
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
