"""Lists that may be longer than a row should be, in ordered segments.

What belongs to a key lies in rows (key, segment) of a bounded number of values. A key with no more of them than a segment
holds is one segment, and dealt as such. The rows of others are dealt by ranges of key and order, so those of one key may lie
in many tasks; a segment never crosses from one to the next. A key's list is put together only where it is asked for."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from knotwork.operators.normalization import small
from knotwork.plans.lineage import cut

#: Values of a segment.
SIZE = 10_000


class Crowds(NamedTuple):
    """The hashes of crowded keys, as a table in a list that is empty without any, and how many rows and keys the others are."""

    hashes: list[DataFrame]
    rows: int
    keys: int


def crowded(rows: DataFrame, key: list[str], size: int = SIZE) -> Crowds:
    """Which keys have more than ``size`` rows."""
    few, seen = F.col("n") <= size, Observation()
    counts = rows.select(F.xxhash64(*key).alias("__hash")).groupBy("__hash").agg(F.count("*").alias("n"))
    counts = counts.observe(seen, F.sum(F.when(few, F.col("n"))).alias("rows"), F.count_if(few).alias("keys"), F.count_if(~few).alias("many"))
    many = cut(counts.where(~few).select("__hash"))
    return Crowds([small(many)] if seen.get["many"] else [], seen.get["rows"] or 0, seen.get["keys"] or 0)


def divided(rows: DataFrame, key: list[str], crowds: Crowds) -> list[DataFrame]:
    """Rows of other keys than the ``crowded`` ones and, if there are such, theirs."""
    keyed = rows.withColumn("__hash", F.xxhash64(*key))
    return [reduce(lambda df, c: df.join(c, "__hash", "left_anti"), crowds.hashes, keyed), *(keyed.join(c, "__hash", "left_semi") for c in crowds.hashes)]


def union(some: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, some)


def segments(rows: DataFrame, key: list[str], order: list[Column], value: Column, size: int = SIZE) -> DataFrame:
    """The key columns, segment, n and ``items`` of ``rows``: all values of each key, in the order of ``order`` and ``segment``.

    ``segment`` tells the order of a key's segments, and has gaps. Values that are equal in ``order`` go by themselves. A row's
    number is that of the ranges of one run: cut the result before two runs over it have to agree on ``segment``."""
    crowds = crowded(rows, key, size)
    return union(parts(divided(rows, key, crowds), {k: F.col(k) for k in key}, order, value, size))


def parts(rows: list[DataFrame], key: dict[str, Column], order: list[Column], value: Column, size: int) -> list[DataFrame]:
    """``segments`` of ``divided`` rows, apart: keys that are one segment, dealt by their key, and the segments of crowded ones.

    The key columns are made of what is dealt, so the rows need not carry what is longer than that."""
    few, *many = [df.withColumns({"__order": F.struct(*order), "__value": value}) for df in rows]
    named = [c.alias(k) for k, c in key.items()]
    short = few.repartition(*key.values()).select(*named, F.struct("__order", "__value").alias("x"))
    whole = short.groupBy(*key).agg(F.array_sort(F.collect_list("x")).alias("all")).withColumn("segment", F.lit(0).cast("long"))
    by = [*key, "__order", "__value"]
    placed = [df.select(*named, "__order", "__value").repartitionByRange(*by).sortWithinPartitions(*by).select(*key, "__value", F.monotonically_increasing_id().alias("__at")) for df in many]
    held = [df.groupBy(*key, F.floor(F.col("__at") / size).alias("segment")).agg(F.array_sort(F.collect_list(F.struct("__at", "__value"))).alias("all")) for df in placed]
    return [df.select(*key, "segment", F.size("all").cast("long").alias("n"), F.transform("all", lambda x: x["__value"]).alias("items")) for df in [whole, *held]]


def assembled(held: DataFrame | list[DataFrame], key: list[str]) -> DataFrame:
    """The key columns, n and ``items`` of each key as one list. Only for keys whose lists a row can hold: filter first.

    Of ``parts``, only the segments of crowded keys are dealt again, so that all rows are dealt by their key in the end."""
    whole, long = (held[:1], held[1:]) if isinstance(held, list) else ([], [held])
    put = [df.groupBy(*key).agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("segment", "items"))).alias("all")) for df in long]
    return union([*(df.select(*key, "n", "items") for df in whole), *(df.select(*key, "n", F.flatten(F.transform("all", lambda x: x["items"])).alias("items")) for df in put)])


def lengths(held: DataFrame, key: list[str]) -> DataFrame:
    """The key columns and the number of values, without reading them."""
    return held.groupBy(*key).agg(F.sum("n").alias("n"))
