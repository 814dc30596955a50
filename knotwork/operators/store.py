"""A stored table of triples, and what a batch changes in it.

The store has a row for each fingerprint: fingerprint, the first spelling and types, evidence_sources (evidence, source,
section, timestamp, url), first_seen, last_seen, update_count.

On disk it is a folder of versions ``v1``, ``v2``, …. A version has ``data``, Parquet by bucket (the first two digits of the
fingerprint), only of the buckets that its batch touched, and ``manifest``, a small table that tells for each bucket which
version has it last. The manifest is written at the end, and a version without one is as if it were not there; so a batch
that breaks off leaves the store as it was, and every version stays readable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from knotwork.operators.merging import with_fingerprint
from knotwork.plans.lineage import cut
from knotwork.sources import versions

_OWN = ["subject", "subject_type", "relation", "object", "object_type"]


def new_entries(triples: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The store of a batch on its own."""
    told = with_fingerprint(triples).withColumn("at", F.coalesce("timestamp", F.lit(run_ts)))
    e = F.struct("seq", "evidence", F.coalesce("source", F.lit("unknown")).alias("source"), "section", F.col("at").alias("timestamp"), "url")
    kept = told.groupBy("fingerprint").agg(F.min_by(F.struct(*_OWN), "seq").alias("t"), F.array_sort(F.collect_list(e)).alias("evidence_sources"), F.min_by("at", "seq").alias("first_seen"), F.max_by("at", "seq").alias("last_seen"))
    evidence = F.transform("evidence_sources", lambda x: x.dropFields("seq"))
    return kept.select("fingerprint", "t.*", evidence.alias("evidence_sources"), "first_seen", "last_seen", F.size("evidence_sources").cast("long").alias("update_count"))


def empty_store(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "fingerprint string, subject string, subject_type string, relation string, object string, object_type string, evidence_sources array<struct<evidence string, source string, section string, timestamp string, url string>>, first_seen string, last_seen string, update_count long")


def upsert(store: DataFrame, triples: DataFrame, run_ts: str | None = None) -> DataFrame:
    """The store after a batch: known triples get its evidence at the end, others are added."""
    return added(store, new_entries(triples, run_ts))


def added(store: DataFrame, new: DataFrame) -> DataFrame:
    """One store after another: of entries of both, the first's spelling and beginning, the evidence of both in order."""
    s, n = store.alias("s"), new.alias("n")
    met = s.join(n, "fingerprint", "full_outer")
    none = F.array().cast(new.schema["evidence_sources"].dataType)
    evidence = F.concat(F.coalesce("s.evidence_sources", none), F.coalesce("n.evidence_sources", none))
    first = [F.coalesce(f"s.{c}", f"n.{c}").alias(c) for c in [*_OWN]]
    return met.select("fingerprint", *first, evidence.alias("evidence_sources"), F.coalesce("s.first_seen", "n.first_seen").alias("first_seen"), F.coalesce("n.last_seen", "s.last_seen").alias("last_seen"), (F.coalesce("s.update_count", F.lit(0)) + F.coalesce("n.update_count", F.lit(0))).alias("update_count"))


def diff(store: DataFrame, triples: DataFrame) -> DataFrame:
    """``triples`` with fingerprint and status: ``updated`` for what the store has, ``new`` otherwise, and ``first``, whether it is the batch's first of its fingerprint."""
    known = store.select("fingerprint").withColumn("__known", F.lit(True))
    first = F.row_number().over(Window.partitionBy("fingerprint").orderBy("seq")) == 1
    met = with_fingerprint(triples).join(known, "fingerprint", "left")
    return met.select(*triples.columns, "fingerprint", F.when(F.col("__known").isNull(), "new").otherwise("updated").alias("status"), first.alias("first"))


def diff_metrics() -> dict[str, Column]:
    """The aggregates of ``diff_stats``, by name."""
    new, old = F.col("status") == "new", F.col("status") == "updated"
    return {"new_triples": F.count_if(new), "added": F.count_if(new & F.col("first")), "updated": F.count_if(old), "unchanged": F.count_if(old), "conflicts": F.count_if(F.lit(False))}


def diff_stats(diffed: DataFrame) -> DataFrame:
    """new_triples, added (fingerprints among them), updated, unchanged (the same number), conflicts (none): one row."""
    return diffed.agg(*(m.alias(k) for k, m in diff_metrics().items()))


def diff_report(diffed: DataFrame, shown: int = 10) -> str:
    stats = diff_stats(diffed).first()
    new = diffed.where("status = 'new'").orderBy("seq").limit(shown).collect()
    out = [f"new {stats['new_triples']}, updated {stats['updated']}, conflicts 0, unchanged {stats['unchanged']}", *(f"{r['subject']} {r['relation']} {r['object']}" for r in new)]
    return "\n".join(out + ([f"and {stats['new_triples'] - shown} more"] if stats["new_triples"] > shown else []))


def get(store: DataFrame, fingerprint: str) -> DataFrame:
    return store.where(F.col("fingerprint") == fingerprint)


def find(store: DataFrame, subject: str, relation: str, obj: str) -> DataFrame:
    """The entry of a triple, whatever its case."""
    key = with_fingerprint(store.sparkSession.createDataFrame([(subject, relation, obj)], "subject string, relation string, object string"))
    return store.join(F.broadcast(key.select("fingerprint")), "fingerprint", "left_semi")


def store_stats(store: DataFrame) -> DataFrame:
    """total_triples, total_evidence, avg_evidence, conflicts (of types under one fingerprint there are none): one row."""
    return store.agg(F.count("*").alias("total_triples"), F.coalesce(F.sum("update_count"), F.lit(0)).alias("total_evidence"), F.coalesce(F.avg("update_count"), F.lit(0.0)).alias("avg_evidence"))


_BUCKET = "substring(fingerprint, 1, 2)"
_MANIFEST = "kind string, name string, value string"


def _write_buckets(entries: DataFrame, folder: str) -> None:
    dealt = entries.withColumn("bucket", F.expr(_BUCKET)).repartition("bucket", F.pmod(F.hash("fingerprint"), F.lit(8)))
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/data")


def _write_manifest(spark: SparkSession, rows: list[tuple[str, str, str]], folder: str) -> None:
    spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{folder}/manifest")


def _manifest(spark: SparkSession, folder: str) -> tuple[dict[str, str], dict[str, int]]:
    """(bucket to the version that has it, writer to the number of its last batch) of a version; at most 256 buckets."""
    rows = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest").collect()
    return {r["name"]: r["value"] for r in rows if r["kind"] == "bucket"}, {r["name"]: int(r["value"]) for r in rows if r["kind"] == "writer"}


def _load(spark: SparkSession, root: str, buckets: dict[str, str]) -> DataFrame:
    if not buckets:
        return empty_store(spark)
    return spark.read.schema(empty_store(spark).schema).parquet(*(f"{root}/{version}/data/bucket={b}" for b, version in sorted(buckets.items())))


def write(store: DataFrame, folder: str) -> None:
    """The whole store as one version at ``folder``."""
    spark = store.sparkSession
    _write_buckets(store, folder)
    name = folder.rstrip("/").rpartition("/")[2]
    found = [r[0] for r in store.select(F.expr(_BUCKET).alias("b")).distinct().collect()]  # 256 at most
    _write_manifest(spark, [("bucket", b, name) for b in found], folder)


def read(spark: SparkSession, folder: str, fingerprint: str | None = None) -> DataFrame:
    """The store as of the version at ``folder``; with a fingerprint, only the bucket that has it is read."""
    buckets, _ = _manifest(spark, folder)
    if fingerprint is not None:
        buckets = {b: v for b, v in buckets.items() if fingerprint.startswith(b)}
    return _load(spark, folder.rstrip("/").rpartition("/")[0], buckets)


def newest(spark: SparkSession, root: str) -> int:
    """The number of the last whole version under ``root``; 0 without one."""
    return versions.newest(spark, root, "manifest")


def current(spark: SparkSession, root: str, fingerprint: str | None = None) -> DataFrame:
    """The store as of the last whole version under ``root``; empty without one."""
    n = newest(spark, root)
    return read(spark, f"{root}/v{n}", fingerprint) if n else empty_store(spark)


def commit(triples: DataFrame, root: str, run_ts: str | None = None, writer: str = "", number: int | None = None) -> int:
    """Brings the store under ``root`` up to date with a batch; the number of the version that has it.

    Only the buckets of the batch's fingerprints are read and written. A batch may have a ``number`` of its ``writer``, which
    numbers its batches upwards: one that is already in the store is passed over, so its evidence counts once. One writer at a time."""
    spark = triples.sparkSession
    n = newest(spark, root)
    buckets, writers = _manifest(spark, f"{root}/v{n}") if n else ({}, {})
    if number is not None and writers.get(writer, -1) >= number:
        return n
    new = cut(new_entries(triples, run_ts))
    touched = {r[0] for r in new.select(F.expr(_BUCKET).alias("b")).distinct().collect()}
    folder = f"{root}/v{n + 1}"
    if touched:
        _write_buckets(added(_load(spark, root, {b: v for b, v in buckets.items() if b in touched}), new), folder)
    if number is not None:
        writers[writer] = number
    kept = {**buckets, **dict.fromkeys(touched, f"v{n + 1}")}
    _write_manifest(spark, [*(("bucket", b, v) for b, v in kept.items()), *(("writer", w, str(k)) for w, k in writers.items())], folder)
    return n + 1
