"""Texts put to a client from the tasks: retried, kept, and never lost.

A client is a function that is called once in each task and gives a function from a list of texts to a list of answers."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.plans.lineage import cut
from knotwork.sources.versions import exists

Client = Callable[[], Callable[[list[str]], list]]
#: Attempts for a list of texts and for each text alone, and seconds before the second one, doubled before each next.
TRIES, WAIT = 3, 1.0
_ARROW = {"string": pa.string(), "array<double>": pa.list_(pa.float64())}


def _patient(ask: Callable[[list[str]], list], texts: list[str], tries: int, wait: float) -> tuple[list | None, str | None]:
    """(answers, None), or (None, what was amiss the last time)."""
    reason = None
    for k in range(tries):
        if k:
            time.sleep(wait * 2 ** (k - 1))
        try:
            got = list(ask(texts))
            if len(got) != len(texts):
                raise ValueError(f"{len(got)} answers to {len(texts)} texts")
            return got, None
        except Exception as e:  # noqa: BLE001  whatever a client raises is the row's to tell
            reason = f"{type(e).__name__}: {e}"
    return None, reason


def _answered(ask: Callable[[list[str]], list], texts: list[str], tries: int, wait: float) -> tuple[list, list[str | None]]:
    """(answers, reasons), one of each text; a list that fails as a whole is asked text by text."""
    got, reason = _patient(ask, texts, tries, wait)
    if got is not None:
        return got, [None] * len(texts)
    if len(texts) == 1:
        return [None], [reason]
    each = [_patient(ask, [t], tries, wait) for t in texts]
    return [a[0] if a else None for a, _ in each], [r for _, r in each]


def ask_rows(rows: DataFrame, client: Client, column: str, out: str = "payload", kind: str = "string", tries: int = TRIES, wait: float = WAIT) -> DataFrame:
    """``rows`` with ``out``, the answer to ``column``, and ``failure``, why there is none; null texts are not asked. Nothing is shuffled or kept."""
    arrow = _ARROW[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ask = None
        for batch in batches:
            texts = batch.column(column).to_pylist()
            at = [i for i, t in enumerate(texts) if t is not None]
            answers, reasons = [None] * len(texts), [None] * len(texts)
            if at:
                ask = ask or client()
                for i, a, r in zip(at, *_answered(ask, [texts[i] for i in at], tries, wait)):
                    answers[i], reasons[i] = a, r
            yield batch.append_column(out, pa.array(answers, arrow)).append_column("failure", pa.array(reasons, pa.string()))

    return rows.mapInArrow(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, `{out}` {kind}, failure string")


def ask_once(rows: DataFrame, client: Client, column: str, folder: str, out: str = "payload", kind: str = "string", tries: int = TRIES, wait: float = WAIT) -> DataFrame:
    """As ``ask_rows``, but equal texts are asked once, and answers are kept in ``folder`` and not asked for again, in this run or a later one.

    Answers go by a digest of the text. What fails is not kept, so a later run asks it again. Other runs may read the folder
    meanwhile; two that write to it at once may both ask a text, and one of the equal answers is then taken."""
    spark = rows.sparkSession
    keyed = rows.withColumn("__key", F.sha2(F.col(column).cast("binary"), 256))
    kept = spark.createDataFrame([], f"key string, `{out}` {kind}")
    if exists(spark, folder):
        kept = spark.read.schema(kept.schema).parquet(folder).dropDuplicates(["key"])
    new = keyed.where(F.col("__key").isNotNull()).groupBy(F.col("__key").alias("key")).agg(F.min(column).alias("__text"))
    asked = cut(ask_rows(new.join(kept.select("key"), "key", "left_anti"), client, "__text", out, kind, tries, wait).drop("__text"))
    asked.where("failure is null").select("key", out).write.mode("append").parquet(folder)
    known = kept.withColumn("failure", F.lit(None).cast("string")).unionByName(asked)
    met = keyed.join(known.withColumnRenamed("key", "__key"), "__key", "left")
    return met.select(*rows.columns, out, "failure")


def ready(client: Client, text: str = "ping") -> str | None:
    """Null if the client answers ``text`` here, else why not: to be asked before a long run."""
    return _patient(lambda t: client()(t), [text], 1, 0.0)[1]
