"""Cutting lineage in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


T = TypeVar("T")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where it is unset in local mode."""
    sc = spark.sparkContext
    if found := spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir"):
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(found)
        return found
    if found := sc.getCheckpointDir():
        return found
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="knotwork-"))
    return sc.getCheckpointDir()


#: Frees a query's shuffle files once it has ended.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def freed(run: Callable[[], T], spark: SparkSession) -> T:
    """What ``run`` gives, with its shuffle files freed at its end. The plan must be made within ``run``; the session's setting is as before afterwards."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        return run()
    finally:
        if before is None:
            spark.conf.unset(FREED)
        else:
            spark.conf.set(FREED, before)


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, so that a lost executor costs no recomputation.

    Its shuffle files are not needed after that and are freed at once; Spark would keep them until the driver's garbage is
    collected."""
    shared_dir(df.sparkSession)
    return freed(lambda: df.select("*").checkpoint(eager=True), df.sparkSession)  # a plan made under the setting


def counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
    """``df`` cut, and what was counted while it was written: ``rows``, and an aggregate for each of ``metrics``. No job of its own counts."""
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("rows"), *(m.alias(k) for k, m in metrics.items())))
    return out, {k: int(v or 0) for k, v in seen.get.items()}


#: Rows of a task that takes them in by a key, about.
ROWS = 500_000


def dealt(df: DataFrame, *keys: str, rows: int = ROWS) -> DataFrame:
    """``df`` dealt by the key columns to as many tasks as its rows need, so that a task's share stays the same as tables grow. Meant for tables as they are read, which Parquet counts by its footers."""
    return df.repartition(-(-df.count() // rows) or 1, *keys)


#: Spark's sizes for what a task reads of a shuffle and for a batch of Python workers, and the smaller ones used here.
SMALLER = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": (64 << 20, "16m"), "spark.sql.execution.arrow.maxBytesPerBatch": (64 << 20, "8m")}


def in_small_tasks(spark: SparkSession) -> None:
    """Bounds what a task takes in at once, packed shuffle files above all, where the session has Spark's own bounds. Other settings stay."""
    for name, (own, less) in SMALLER.items():
        if spark.conf.get(name).rstrip("b") == str(own):
            spark.conf.set(name, less)


#: Spark's bound for a side of a shuffled join that is hashed in place of sorting both sides; 0, as Spark has it, is never.
HASHED = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"


def hashed_where_small(spark: SparkSession) -> None:
    """Joins hash a side of which no shuffled part is larger than a task of ``in_small_tasks`` takes in, rather than sort both. Larger sides are sorted as before. A session's own bound stays."""
    in_small_tasks(spark)
    if spark.conf.get(HASHED).rstrip("b") == "0":
        spark.conf.set(HASHED, SMALLER["spark.sql.adaptive.advisoryPartitionSizeInBytes"][1])
