"""Triples merged by what they say, with all their evidence.

Triples come with ``seq``, the order of processing; first and last mean that order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions.text import digest, fingerprint, said
from knotwork.operators import segments
from knotwork.operators.normalization import small

_OWN = ["subject", "subject_type", "relation", "object", "object_type"]
#: What is kept of each piece of evidence.
FIELDS = ("source", "section", "score", "timestamp", "url", "evidence")


def with_fingerprint(triples: DataFrame) -> DataFrame:
    return triples.withColumn("fingerprint", fingerprint(F.col("subject"), F.col("relation"), F.col("object")))


def substitute_clusters(triples: DataFrame, clusters: DataFrame, canonical: DataFrame) -> DataFrame:
    """Subjects and objects that are in a cluster of their type under its canonical name."""
    names = clusters.join(canonical, "cluster_id").select("entity_type", "name", "canonical")
    out = triples
    for side in ("subject", "object"):
        out = out.join(small(names.select(F.col("entity_type").alias(f"{side}_type"), F.col("name").alias(side), F.col("canonical").alias(f"__{side}"))), [side, f"{side}_type"], "left")
    return out.select(*(F.coalesce(f"__{c}", c).alias(c) if c in ("subject", "object") else F.col(c) for c in triples.columns))


def _told(triples: DataFrame, run_ts: str | None) -> DataFrame:
    """Triples with ``said``, by which they are dealt: unlike a digest it packs well beside the names that it is made of."""
    return triples.withColumns({"said": said(F.col("subject"), F.col("relation"), F.col("object")), "at": F.coalesce("timestamp", F.lit(run_ts)), "inferred": F.coalesce("inferred", F.lit(False))})


def _evidence(fields: Sequence[str]) -> list[Column]:
    known = {"source": F.coalesce("source", F.lit("unknown")), "section": F.col("section"), "score": F.coalesce("confidence", F.lit(1.0)), "timestamp": F.col("at"), "url": F.col("url"), "evidence": F.col("evidence")}
    return [known[f].alias(f) for f in fields]


def _sums() -> list[Column]:
    """The first row's spelling and both timestamps as two structs with ``seq``, and the counts."""
    return [F.min(F.struct("seq", *_OWN, "at")).alias("first"), F.max(F.struct("seq", "at")).alias("last"), F.count_if("inferred").alias("inferred_count"), F.count("*").alias("total_count")]


_SUMMED = ["inferred_count", "total_count", "first.at as first_seen", "last.at as last_seen"]


def merge_triples(triples: DataFrame, run_ts: str | None = None, fields: Sequence[str] = FIELDS) -> DataFrame:
    """fingerprint, the first row's spelling and types, evidence_sources in order, inferred_count, total_count, first_seen, last_seen.

    A null source is ``unknown``; a null timestamp is ``run_ts``. ``fields`` are those of the evidence that are wanted. Rows are
    dealt as they are and merged where they arrive: all evidence has to be there in any case, and what a task would have
    combined before is mostly a row of its own, in a wider form."""
    told = _told(triples, run_ts).select("said", "seq", *_OWN, "at", "inferred", F.struct("seq", *_evidence(fields)).alias("e"))
    merged = told.repartition("said").groupBy("said").agg(*_sums(), F.array_sort(F.collect_list("e")).alias("all"))
    return merged.select(digest(F.col("said")).alias("fingerprint"), *(f"first.{c}" for c in _OWN), F.transform("all", lambda e: e.dropFields("seq")).alias("evidence_sources"), *map(F.expr, _SUMMED))


def crowded(triples: DataFrame, size: int) -> segments.Crowds:
    """What more than ``size`` triples say, for ``merge_summary`` and ``evidence_segments``."""
    return segments.crowded(_told(triples, None), ["said"], size)


def merge_summary(triples: DataFrame, run_ts: str | None = None, crowds: segments.Crowds | None = None) -> DataFrame:
    """What ``merge_triples`` gives but for the evidence: a row of bounded size for each fingerprint, combined before the shuffle.

    With ``crowds`` (``crowded``) only crowded triples are, if others come at most twice on average: these go as they are, in
    half the room of a combined row and without being sorted first, and the fingerprint is made of them where they arrive."""
    parts = [told := _told(triples, run_ts)]
    if crowds is not None and crowds.rows <= 2 * crowds.keys:
        text = said(F.col("subject"), F.col("relation"), F.col("object"))
        few, *many = segments.divided(told, ["said"], crowds)
        parts = [few.drop("said").repartition(digest(text)).withColumn("said", text), *many]
    merged = segments.union([df.groupBy(digest(F.col("said")).alias("fingerprint")).agg(*_sums()) for df in parts])
    return merged.select("fingerprint", *(f"first.{c}" for c in _OWN), *map(F.expr, _SUMMED))


def evidence_segments(triples: DataFrame, run_ts: str | None = None, size: int = segments.SIZE, fields: Sequence[str] = FIELDS, crowds: segments.Crowds | None = None) -> DataFrame | list[DataFrame]:
    """fingerprint, segment, n, items: the evidence of ``merge_triples`` in ordered segments, for fingerprints with more of it than a row should hold.

    With ``crowds`` (``crowded`` of the same size) they are apart, as ``segments.parts`` gives them, for ``segments.assembled``."""
    told = _told(triples, run_ts)
    rows = segments.divided(told, ["said"], crowded(triples, size) if crowds is None else crowds)
    parts = segments.parts(rows, {"fingerprint": digest(F.col("said"))}, [F.col("seq")], F.struct(*_evidence(fields)), size)
    return segments.union(parts) if crowds is None else parts


def merge_conflicts(merged: DataFrame) -> DataFrame:
    """Merged triples with both inferred and explicit evidence, as ``mixed_inference``."""
    return merged.where("inferred_count > 0 and total_count > inferred_count").select("fingerprint", "subject", "relation", "object", F.lit("mixed_inference").alias("conflict"), "inferred_count", (F.col("total_count") - F.col("inferred_count")).alias("explicit_count"))


def merge_stats(merged: DataFrame) -> DataFrame:
    """total_triples, total_evidence, avg_evidence (0 without triples), conflicts: one row."""
    mixed = (F.col("inferred_count") > 0) & (F.col("total_count") > F.col("inferred_count"))
    return merged.agg(F.count("*").alias("total_triples"), F.coalesce(F.sum("total_count"), F.lit(0)).alias("total_evidence"), F.coalesce(F.avg("total_count"), F.lit(0.0)).alias("avg_evidence"), F.count_if(mixed).alias("conflicts"))
