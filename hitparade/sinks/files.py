"""Folders of a lake, through the file system that holds them."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _located(spark, path)
    return fs.exists(p)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder with what it holds; False where there was none. A deletion
    that the file system refuses is an error, not a success."""
    p, fs = _located(spark, path)
    if not fs.exists(p):
        return False
    if not fs.delete(p, True) and fs.exists(p):
        raise OSError(f"could not delete {path}")
    return True


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern, sorted."""
    p, fs = _located(spark, pattern)
    return sorted(str(s.getPath()) for s in fs.globStatus(p) or [])
