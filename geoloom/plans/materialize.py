"""Lineage cuts that survive the loss of an executor.

A table written to the shared folder named by ``spark.checkpoint.dir`` can be read again by every
executor; nothing here uses executor-local copies.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``, or of setCheckpointDir(); a temporary one only in a single process (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if not _OWN:
        _OWN.append(tempfile.mkdtemp(prefix="geoloom-"))
        atexit.register(shutil.rmtree, _OWN[0], ignore_errors=True)
    return "file://" + _OWN[0]


def materialize(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, with the same schema."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/geoloom-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._geoloom_path = path  # lets release() find the folder
    return out


def release(df: DataFrame) -> None:
    """Delete the files behind a frame that materialize() returned and nothing reads any more."""
    path = getattr(df, "_geoloom_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
