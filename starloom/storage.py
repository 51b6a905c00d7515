"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where none is set, a local master (tests) gets a temporary folder; on a cluster
    that is an error, as executors would not see the driver's folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            found = known.get()
        elif not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        else:
            found = tempfile.mkdtemp(prefix="spark-starloom-")
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """A folder under the shared one for files of its own, deleted when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/starloom-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors.

    The table is deleted when the driver's JVM ends. As the table replaces them, the shuffle files of the job that
    writes it are removed at its end."""
    spark = df.sparkSession
    path = new_folder(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that durable() returned, once everything that reads them has been written; others are left alone."""
    for table in tables:
        if not hasattr(table, "_written_at"):
            continue
        hadoop = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table._written_at)
        hadoop.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)
