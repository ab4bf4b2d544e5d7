"""Shared-storage helpers on the Hadoop file system that Spark itself uses."""

from __future__ import annotations

import tempfile
import time
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="fleetspark-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate tables.

    Only a local session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")


def landed(df: DataFrame, name: str = "table") -> DataFrame:
    """The same rows as a table written to the shared folder.

    Cuts lineage before work that reads its input several times: parsing or deduplication then
    happens once, column pruning works again, and a lost executor re-reads files.
    """
    path = f"{shared_dir(df.sparkSession)}/fleetspark/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _filesystem(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of a directory, sorted."""
    fs, target = _filesystem(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _filesystem(spark, path)
    fs.delete(target, True)


def deliver(spark: SparkSession, folder: str, target: str, prefix: str, after: int = 0) -> int:
    """Move the files of a table in partition folders into a folder that a stream reads.

    A stream takes files by their times, so all get one time, later than `after`, which is
    returned. Names get the prefix, which tells files of several deliveries apart.
    """
    at = max(int(time.time() * 1000), after + 1)
    path = spark._jvm.org.apache.hadoop.fs.Path
    _filesystem(spark, target)[0].mkdirs(path(target))
    for child in child_names(spark, folder):
        fs, inside = _filesystem(spark, f"{target}/{child}")
        fs.mkdirs(inside)
        for status in fs.listStatus(path(f"{folder}/{child}")):
            if status.isFile() and not status.getPath().getName().startswith(("_", ".")):
                fs.setTimes(status.getPath(), at, -1)
                fs.rename(status.getPath(), path(inside, f"{prefix}-{status.getPath().getName()}"))
    return at


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file and rename it into place in one step."""
    jvm = spark._jvm
    fs, temporary = _filesystem(spark, path + ".tmp")
    stream = fs.create(temporary, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        temporary.toUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(temporary, jvm.org.apache.hadoop.fs.Path(path), options)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Contents of a small file, or None when it does not exist."""
    fs, target = _filesystem(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
