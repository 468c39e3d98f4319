"""Session helpers: local sessions for tests / bench, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """A local session with AQE on and the UI off (tests and bench only).

    On a cluster the caller supplies its own session; nothing in the library
    creates one.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local-mode session (tests, the bench) may
    fall back to a folder under the machine's temp dir when the setting is
    unset; on a cluster that would be executor-local, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-ckpt-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}tessera-scratch/{name}-{uuid.uuid4().hex[:12]}"



@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """The session with other settings (``__`` stands for a point) for as long as the block runs."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """Queries that run in the block leave no shuffle files; otherwise these lie on the executors' disks until the driver happens to collect its garbage."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")
