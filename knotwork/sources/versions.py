"""Folders that may lie in any store that Spark reads: what is there, and which version is the newest."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def _found(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [s.getPath().toString() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def exists(spark: SparkSession, folder: str) -> bool:
    return bool(_found(spark, folder))


def newest(spark: SparkSession, root: str, part: str) -> int:
    """The greatest n for which ``root/v<n>/part`` was written to its end; 0 without one."""
    names = [re.search(rf"/v(\d+)/{re.escape(part)}/_SUCCESS$", f) for f in _found(spark, f"{root}/v*/{part}/_SUCCESS")]
    return max((int(m[1]) for m in names if m), default=0)


def drop_version(spark: SparkSession, root: str, n: int) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/v{n}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
