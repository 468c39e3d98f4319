"""Scans with too few partitions for the work that follows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes, by the planner's own estimate, up to which a scan is not worth dealing out, and the times an even share that one task may read.
LEAST_BYTES, MOST_SHARES = 8 << 20, 2


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt out over the cores if it has some size, its scan no more partitions than there are cores, and one of them far more rows than its share.

    A file is cut into splits by its bytes, but a row group is read by one
    task: a table in one row group gives one task with rows and others
    without.  Text folding costs far more than moving the text once, so such a
    scan is dealt out round robin.  A large table has more splits than cores, a
    tiny one nothing to share, and a table of several files or row groups is
    dealt out as it lies; all are left as they are, without a shuffle.  The
    rows of each partition are counted without reading a column.
    """
    if df.rdd.getNumPartitions() > (cores := df.sparkSession.sparkContext.defaultParallelism):  # planning only, no job
        return df
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= LEAST_BYTES:
        return df
    most, rows = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count"), F.sum("count")).first()
    return df.repartition(cores) if most and most * cores > MOST_SHARES * rows else df
