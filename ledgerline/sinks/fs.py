"""Small file-system operations through the cluster's Hadoop FileSystem.

Only metadata calls (list, exists, delete a directory); data never passes
through the driver. Works for any URI scheme the cluster is configured for.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(conf), jpath


def is_local(spark: SparkSession, path: str) -> bool:
    return _fs_and_path(spark, path)[0].getUri().getScheme() == "file"


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.exists(p))


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return bool(fs.delete(p, True))


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct sub-directories of ``path`` (empty if missing)."""
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isFile()]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small marker file (overwrites)."""
    fs, p = _fs_and_path(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs_and_path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, src: str, dst: str) -> bool:
    fs, p = _fs_and_path(spark, src)
    return bool(fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(dst)))


def glob_dirs(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths of the folders that match ``pattern`` (none: empty)."""
    fs, p = _fs_and_path(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(p) or [] if s.isDirectory()]
