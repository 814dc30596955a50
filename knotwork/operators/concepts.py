"""Concepts that texts mention, and relations between them.

Input texts are (file_path, content); vocabularies are (category, name, term, ordinal), read in the order of ``ordinal``."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knotwork.functions.text import context, occurrences, quoted, strip
from knotwork.plans.lineage import cut, in_small_tasks

#: Rows of a vocabulary that are sought in one pass over the texts. A larger one takes a pass for each so many.
TERMS = 200_000
#: Texts that a task has as Python strings at once.
TEXTS = 500
_HITS = "file_path string, category string, name string, term string, ordinal int, description string"
_machines: dict[str, tuple] = {}


def term_hits(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """file_path, category, name, term, ordinal, description: each term that a text has as a whole word, whatever its case.

    A machine of all terms passes over a text once, whatever their number; it is sent to the tasks, ``TERMS`` rows of the
    vocabulary at a time. Null and empty terms are in no text. Nothing is shuffled."""
    spark, rows = docs.sparkSession, []
    out = spark.createDataFrame([], _HITS)
    texts = docs.select("file_path", "content").where("content is not null")
    for row in vocabulary.where("term <> ''").select("category", "name", "term", F.col("ordinal").cast("int")).toLocalIterator():
        rows.append(tuple(row))
        if len(rows) == TERMS:
            out, rows = out.unionByName(_sought(texts, rows)), []
    return out.unionByName(_sought(texts, rows)) if rows else out


def _sought(texts: DataFrame, rows: list[tuple]) -> DataFrame:
    in_small_tasks(texts.sparkSession)
    sent, key = texts.sparkSession.sparkContext.broadcast(rows), uuid.uuid4().hex
    kind = texts.schema["file_path"].dataType.simpleString()

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from knotwork.functions.automaton import Terms, around

        if key not in _machines:  # a worker keeps the machine for its next task
            _machines.clear()
            _machines[key] = (Terms([r[2] for r in sent.value]), sent.value)
        machine, known = _machines[key]
        for batch in (b.slice(k, TEXTS) for b in batches for k in range(0, b.num_rows, TEXTS)):
            at, found, texts_around = [], [], []
            for i, text in enumerate(batch.column("content").to_pylist()):
                for k, place, length in machine.find(text):
                    at.append(i)
                    found.append(known[k])
                    texts_around.append(around(text, place, length))
            columns = list(zip(*found)) if found else [[], [], [], []]
            kinds = [pa.string(), pa.string(), pa.string(), pa.int32()]
            named = {n: pa.array(c, t) for n, c, t in zip(["category", "name", "term", "ordinal"], columns, kinds)}
            yield pa.record_batch({"file_path": batch.column("file_path").take(pa.array(at, pa.int64())), **named, "description": pa.array(texts_around, pa.string())})

    return texts.mapInArrow(search, _HITS.replace("file_path string", f"file_path {kind}"))


def pattern_hits(docs: DataFrame, patterns: list[str], category: str = "concept") -> DataFrame:
    """file_path, category, name, term, ordinal, description: every match of the patterns, named as it is written."""
    if not patterns:
        return docs.sparkSession.createDataFrame([], _HITS)
    found = F.array(*(F.struct(F.lit(k).alias("ordinal"), occurrences(F.col("content"), F.lit(p)).alias("names")) for k, p in enumerate(patterns)))
    each = docs.select("file_path", "content", F.explode(found).alias("f")).select("file_path", "content", "f.ordinal", F.posexplode("f.names").alias("pos", "name"))
    return each.select("file_path", F.lit(category).alias("category"), "name", F.col("name").alias("term"), (F.col("ordinal") * 1_000_000 + F.col("pos")).cast("int").alias("ordinal"), context(F.col("content"), F.col("name")).alias("description"))


def concepts(docs: DataFrame, services: DataFrame, technologies: DataFrame, patterns: list[str]) -> DataFrame:
    """file_path, seq, name, type, description, canonical: services, then technologies, then pattern matches; of each lower-cased name the first."""
    steps = [term_hits(docs, services), term_hits(docs, technologies), pattern_hits(docs, patterns)]
    hits = steps[0].withColumn("step", F.lit(0))
    for k, s in enumerate(steps[1:], 1):
        hits = hits.unionByName(s.withColumn("step", F.lit(k)))
    hits = hits.withColumn("canonical", F.lower("name"))
    first = Window.partitionBy("file_path", "canonical").orderBy("step", "ordinal")
    kept = hits.withColumn("n", F.row_number().over(first)).where("n = 1")
    seq = F.row_number().over(Window.partitionBy("file_path").orderBy("step", "ordinal"))
    return kept.select("file_path", seq.alias("seq"), "name", F.col("category").alias("type"), "description", "canonical")


def concept_relations(docs: DataFrame, found: DataFrame, verbs: dict[str, str]) -> DataFrame:
    """file_path, src, rel_type, dst, seq: runs of words of which a verb's last occurrence parts two names of ``found`` (file_path, name).

    A text is cut into runs of letters, digits, underscores and white space, each of which a verb can part once; so the
    work follows the length of the text. Names compare without case and differ; repeats stay.

    Far more names are found than a verb parts. So what it parts is written once, and only names with the hash of a part are
    kept: these are looked up in a table of hashes as they come, and neither sorted nor merged before."""
    runs = docs.select("file_path", F.posexplode(F.regexp_extract_all("content", F.lit(r"(?U)[\w\s]+"), F.lit(0))).alias("pos", "run"))
    each = None
    for k, (verb, rel_type) in enumerate(verbs.items()):
        pattern = rf"(?isuU)^(.*\w)\s+{quoted(verb)}\s+(\w.*)$"
        part = runs.where(F.col("run").rlike(pattern)).select("file_path", "pos", F.lit(k).alias("k"), F.lit(rel_type).alias("rel_type"), F.lower(strip(F.regexp_extract("run", pattern, 1))).alias("a"), F.lower(strip(F.regexp_extract("run", pattern, 2))).alias("b"))
        each = part if each is None else each.unionByName(part)
    each = cut(each)
    key = lambda name: F.xxhash64(F.col("file_path").cast("string"), name)
    parts = each.select(F.explode(F.array(key(F.col("a")), key(F.col("b")))).alias("part")).distinct()
    asked = found.join(parts.hint("shuffle_hash"), key(F.lower("name")) == F.col("part"), "left_semi")
    names = asked.groupBy("file_path", F.lower("name").alias("low")).agg(F.max_by("name", "seq").alias("name") if "seq" in found.columns else F.max("name").alias("name"))
    a = names.select("file_path", F.col("low").alias("a"), F.col("name").alias("src"))
    b = names.select("file_path", F.col("low").alias("b"), F.col("name").alias("dst"))
    met = each.join(a, ["file_path", "a"]).join(b, ["file_path", "b"]).where("src <> dst")
    return met.select("file_path", "src", "rel_type", "dst", F.row_number().over(Window.partitionBy("file_path").orderBy("k", "pos")).alias("seq"))


def section_mentions(sections: DataFrame, found: DataFrame) -> DataFrame:
    """file_path, section_idx, heading, name: names of a text's concepts that a section's text has, whatever their case, within words too."""
    near = sections.join(found.select("file_path", "name").distinct(), "file_path")
    return near.where(F.lower("content").contains(F.lower("name"))).select("file_path", "section_idx", "heading", "name")
