"""Where intermediate tables live: always the folder shared by the whole cluster."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where the setting is absent, a local-mode session (tests) gets its own temporary folder; a
    cluster session is refused, because a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="ratewright-")
        context.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; no two calls return the same one."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/ratewright/{app}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return a scan of it.

    Cuts the lineage and, unlike a cache, survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialise`` has written and that nothing reads any more."""
    spark = df.sparkSession
    own = f"/ratewright/{spark.sparkContext.applicationId}/"
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        if own not in folder:
            raise ValueError(f"not an intermediate table: {folder}")
        delete(spark, folder)


def delete(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query go when it ends, not when the driver happens to collect its garbage. For
    jobs that store what they go on with."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Re-split a stored table that has fewer scan partitions than the cluster has cores, before
    work that is heavy per row (model fits, attributions). Larger tables come back unchanged.

    Meant for plain scans, whose partition count is known from the file listing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
