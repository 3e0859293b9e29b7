"""Metadata calls on the Hadoop FileSystem of the session, so they work on
whatever store Spark itself writes to (local, HDFS, object stores). Nothing
here moves or copies a file."""
from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; one that is gone already is no error."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def folder_names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names of the folders directly under ``path`` that match ``pattern``,
    sorted: one listing of one folder."""
    fs, _ = _fs(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{pattern}")) or []
    return sorted(str(s.getPath().getName()) for s in found if s.isDirectory())


def from_uri(spark: SparkSession, uri: str) -> str:
    """Path string of a file URI as in ``_metadata.file_path`` or
    ``inputFiles`` (which are URL-encoded)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return str(fs.makeQualified(p).toString())
