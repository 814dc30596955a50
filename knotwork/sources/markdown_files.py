"""Folders of markdown files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions.text import unix_lines


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """file_path (below ``folder``), content, modified: a row for each ``.md`` file at any depth. Sort by file_path where order matters.

    A folder that is missing raises when it is read. Lines end with a line feed, whatever the file has."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    path = F.url_decode(F.replace(F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/"), F.lit("+"), F.lit("%2B")))
    root = "/" + folder.removeprefix("file:").strip("/") + "/" if not folder.split(":")[0].isalpha() or folder.startswith("file:") else folder.rstrip("/") + "/"
    below = F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 20)).otherwise(path)
    return files.select(below.alias("file_path"), unix_lines(F.col("value")).alias("content"), F.col("_metadata.file_modification_time").alias("modified"))
