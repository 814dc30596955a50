"""Bounded samples of labelled texts, outside a held-out fold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm.language import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, most: dict[int, int], folds: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, text and y (0 or 1) of about ``most[y]`` documents of each class, picked by a hash of doc_id.

    Labels of the held-out fold are not read. Several labels of a document are averaged, null ones and those of a null
    doc_id are left out, and so are labels without a document. Of several texts under one doc_id the least is taken."""
    y = (F.avg(F.col(column).cast("double")) >= 0.5).cast("int")
    known = labels.where(F.col(column).isNotNull() & ~held_out(F.col("doc_id"), folds, fold)).groupBy("doc_id").agg(y.alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = F.lit(0.0)
    for k, n in counts.items():
        share = F.when(F.col("y") == k, F.lit(min(1.0, most.get(k, 0) / n))).otherwise(share)
    picked = known.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
