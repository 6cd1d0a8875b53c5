"""Small files and folders through the Hadoop file system (HDFS, object stores, local folders alike)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def fs_of(spark: SparkSession, path: str):
    """The path's file system and its Hadoop path."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_of(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str, folders: bool) -> dict[str, int]:
    """Names of a folder's files (or folders) and when they changed (milliseconds); nothing if there is no such folder."""
    fs, p = fs_of(spark, path)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p) if s.isDirectory() == folders}


def size(spark: SparkSession, path: str) -> int:
    """Bytes under a folder."""
    fs, p = fs_of(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = fs_of(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = fs_of(spark, path)
    if not fs.exists(p):
        return None
    io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
    stream = fs.open(p)
    try:
        return io.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = True) -> bool:
    """Write a small file: a temporary one of a name of its own, then one rename. With ``replace`` it replaces the target,
    which is never missing in between; without, a target that exists stays, and the result is False."""
    jvm = spark.sparkContext._jvm
    fs, p = fs_of(spark, path)
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    option = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(option, 1)
    how[0] = option.OVERWRITE if replace else option.NONE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(tmp, p, how)
    except Exception:
        fs.delete(tmp, False)
        if not replace and fs.exists(p):
            return False
        raise
    return True
