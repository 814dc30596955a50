"""From raw documents to training shards, each stage over all that its predecessor kept.

Stages: documents in a known language; one document of each component of near copies; documents without benchmark
passages; the rows as often as a mix of sources takes them, in training order; shards of whole groups of equal texts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from knotwork.llm import decontamination, jaccard, language, mixing, sharding
from knotwork.plans.lineage import shared_dir
from knotwork.sources.tables import table


#: Words of a shingle, and the per cent of Jaccard similarity from which on documents are near copies.
SHINGLE, SIMILAR = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter, null ones, and those no learned language codes in 12 bits a byte.

    Rows that are repeated stay or go together; a null doc_id is never learned from. Very long texts are coded whole. Columns
    of any name are kept. An empty table stays empty."""
    return language.identified_documents(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the least doc_id of each component of the n-gram Jaccard join of 5-word shingles at 0.8.

    Of rows repeated in full one stays, of equal doc_ids the least text hash, and null doc_ids come last. Texts without words
    all stay, but for rows repeated in full. Very long texts are compared whole. An empty table stays empty."""
    return jaccard.distinct_documents(docs, n=SHINGLE, threshold=SIMILAR)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark.

    Null and wordless texts stay, rows that are repeated stay or go together, very long texts are searched whole. Without
    documents or benchmark nothing is dropped."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the mix takes them, in training order.

    A document taken in part is one row. Null texts are never taken; a null source is a source. Rows at one position are
    ordered by doc_id. An empty table stays empty."""
    return mixing.mixed_documents(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row; slots keep the training order.

    Null texts are empty ones; rows that are repeated, as the mix repeats them, are a group and share a shard. Equal sizes go
    by hash. An empty table gives an empty one."""
    return sharding.pack(docs, shards=16, order=sharding.stored_order(docs))


STAGES = [
    ("language_id", known_language),
    ("ngram_jaccard_join", one_of_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed),
    ("sharding", sharded),
]

#: Language models, similarity joins and retrieval have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage is written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
