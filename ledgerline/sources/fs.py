"""File-system calls through the session's Hadoop configuration.

Listing, deleting and the small pointer files go through the same Hadoop
``FileSystem`` the Parquet reader and writer use, so the store works on HDFS,
object stores and local disks alike. These are metadata calls on the driver; no
data passes through them, and nothing is renamed. They need a session with a
JVM (not Spark Connect).
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext  # Spark Connect raises here
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _names(spark: SparkSession, path: str, dirs: bool) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if bool(st.isDirectory()) == dirs)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    return _names(spark, path, True)


def list_files(spark: SparkSession, path: str) -> list[str]:
    return _names(spark, path, False)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small new file; False if another writer has created it already."""
    fs, p = _fs(spark, path)
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Exception as e:
        if "AlreadyExists" in str(e) or fs.exists(p):
            return False
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True
