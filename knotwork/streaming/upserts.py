"""A stream of triples into a stored table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from knotwork.operators import store
from knotwork.operators.merging import with_fingerprint

TRIPLE = "seq long, subject string, subject_type string, relation string, object string, object_type string, evidence string, inferred boolean, source string, confidence double, section string, url string, timestamp string"


def read_triples(spark: SparkSession, folder: str, per_trigger: int = 1000) -> DataFrame:
    """Triples of Parquet files as they arrive in ``folder``."""
    return spark.readStream.schema(TRIPLE).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def upsert_batches(folder: str, run_ts: str | None = None, writer: str = "") -> Callable[[DataFrame, int], None]:
    """A batch function that brings the store in ``folder`` up to date, after its newest version.

    A batch of the same ``writer`` and number that runs again changes nothing, so a triple's evidence counts once; another
    writer's batches are added to what is there."""

    def apply(batch: DataFrame, number: int) -> None:
        store.commit(batch, folder, run_ts, writer, number)

    return apply


def start(triples: DataFrame, folder: str, checkpoint: str, run_ts: str | None = None) -> StreamingQuery:
    """The running upsert; every batch there is, then an end. A stream goes by its checkpoint's name: a new one on an old folder adds to it."""
    return triples.writeStream.foreachBatch(upsert_batches(folder, run_ts, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


_CHANGE = "fingerprint string, status string, n long, update_count long, first_seen string, last_seen string"


def changes(triples: DataFrame, run_ts: str | None = None) -> DataFrame:
    """A stateful stream: for each fingerprint of a micro-batch whether it is ``new`` or ``updated``, and its counts and times so far.

    The state of a fingerprint is three values in the stream's own checkpoint, dealt by fingerprint; the store itself is not
    read."""

    def change(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = state.get if state.exists else None
        n, first, last = 0, None, None
        for part in parts:
            for seq, at in zip(part["seq"], part["at"]):
                n += 1
                first = (seq, at) if first is None or seq < first[0] else first
                last = (seq, at) if last is None or seq >= last[0] else last
        count, begun = (old[0] + n, old[1]) if old else (n, first[1])
        state.update((count, begun, last[1]))
        yield pd.DataFrame({"fingerprint": [key[0]], "status": ["updated" if old else "new"], "n": [n], "update_count": [count], "first_seen": [begun], "last_seen": [last[1]]})

    told = with_fingerprint(triples).select("fingerprint", "seq", F.coalesce("timestamp", F.lit(run_ts)).alias("at"))
    return told.groupBy("fingerprint").applyInPandasWithState(change, _CHANGE, "n long, first_seen string, last_seen string", "update", GroupStateTimeout.NoTimeout)


def relation_counts(triples: DataFrame, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """relation, window, n of a stream with timestamps; rows later than ``late`` are left out."""
    at = triples.withColumn("at", F.to_timestamp("timestamp")).withWatermark("at", late)
    return at.groupBy("relation", F.window("at", window)).agg(F.count("*").alias("n"))
