"""Triples out of model output, and the boundary to a model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions.text import strip
from knotwork.functions.vocabulary import ENTITY_TYPES, PLAIN_ENTITY_TYPES, PLAIN_RELATIONS, RELATIONS
from knotwork.operators import asking

#: Names under which a payload may lie, the first that is there counts.
PAYLOAD_FIELDS = ["text", "response", "output", "result", "data", "content"]

_SCHEMA = "array<struct<subject string, subject_type string, relation string, object string, object_type string, evidence string, inferred string, source string>>"


def extract(chunks: DataFrame, client: asking.Client, prompt: str = "prompt", cache: str | None = None, tries: int = asking.TRIES, wait: float = asking.WAIT) -> DataFrame:
    """``chunks`` with ``payload``, what a model says to the column ``prompt``, and ``failure``, why it says nothing.

    ``client`` is called once for each task and answers lists of prompts; it is asked again where it fails. With a ``cache``,
    a folder, a prompt that was answered once is not asked again."""
    if cache is None:
        return asking.ask_rows(chunks, client, prompt, tries=tries, wait=wait)
    return asking.ask_once(chunks, client, prompt, cache, tries=tries, wait=wait)


def failures(asked: DataFrame) -> DataFrame:
    """The rows that a model did not answer, with their reasons, to be asked again."""
    return asked.where("failure is not null").drop("payload")


def payload(*candidates: Column) -> Column:
    return F.coalesce(*candidates)


def json_array(text: Column, require_objects: bool = False) -> Column:
    """The first bracketed span that is JSON, else the whole text without code fences if it is JSON, else null.

    A span ends at its first closing bracket. With ``require_objects`` spans without an object in them are passed over."""
    spans = F.regexp_extract_all(text, F.lit(r"\[[\s\S]*?\]"), F.lit(0))
    good = F.filter(spans, lambda s: F.try_parse_json(s).isNotNull() & (s.contains("{") if require_objects else F.lit(True)))
    bare = strip(F.regexp_replace(F.regexp_replace(text, r"```json\s*", ""), r"```\s*", ""))
    return F.coalesce(F.try_element_at(good, F.lit(1)), F.when(F.try_parse_json(bare).isNotNull(), bare))


def parse_triples(chunks: DataFrame, require_objects: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Triples of (source, section, url, timestamp, payload): a row for each object of the payload, with ``pos``, ``status`` and the triple's columns.

    ``status`` is null for a triple and tells what is amiss otherwise. Missing types are Service, a missing relation is
    ``uses``, missing evidence repeats the triple; a relation may be written with spaces and capitals. Columns in ``keep`` stay."""
    found = chunks.withColumn("__json", json_array(F.col("payload"), require_objects))
    rows = found.select(*(keep or []), "source", "section", "url", "timestamp", F.posexplode(F.from_json("__json", _SCHEMA)).alias("pos", "t"))
    text = {f: strip(F.coalesce(F.col(f"t.{f}"), F.lit(""))) for f in ("subject", "object", "evidence")}
    types = [*ENTITY_TYPES, *PLAIN_ENTITY_TYPES]
    raw = F.coalesce("t.relation", F.lit("uses"))
    lower = F.replace(F.lower(raw), F.lit(" "), F.lit("_"))
    relations = [*RELATIONS, *PLAIN_RELATIONS]
    relation = F.when(raw.isin(relations), raw).when(lower.isin(relations), lower)
    subject_type, object_type = (F.coalesce(F.col(f"t.{f}"), F.lit("Service")) for f in ("subject_type", "object_type"))
    status = (
        F.when(F.col("t").isNull() | (text["subject"] == "") | (text["object"] == ""), "missing name")
        .when(~subject_type.isin(types) | ~object_type.isin(types), "unknown type")
        .when(relation.isNull(), "unknown relation")
    )
    evidence = F.when(text["evidence"] == "", F.concat_ws(" ", text["subject"], relation, text["object"])).otherwise(text["evidence"])
    return rows.select(
        *(keep or []), "pos", status.alias("status"), text["subject"].alias("subject"), subject_type.alias("subject_type"), relation.alias("relation"), text["object"].alias("object"), object_type.alias("object_type"),
        evidence.alias("evidence"), F.coalesce(F.col("t.inferred") == "true", F.lit(False)).alias("inferred"), "source", "section", "url", "timestamp", F.lit(1.0).alias("confidence"),
    )


def parse_entities(rows: DataFrame) -> DataFrame:
    """source, name, type, description of (source, entities), a JSON array of names or of objects; a missing type is Concept."""
    items = rows.select("source", F.explode(F.from_json("entities", "array<string>")).alias("item"))
    parsed = items.select("source", "item", F.from_json("item", "struct<name string, type string, description string>").alias("o"))
    name = strip(F.when(F.col("item").startswith("{"), F.col("o.name")).otherwise(F.col("item")))
    return parsed.select("source", name.alias("name"), F.coalesce("o.type", F.lit("Concept")).alias("type"), F.col("o.description").alias("description")).where("name <> ''")


def parse_relations(rows: DataFrame) -> DataFrame:
    """source, src, rel_type, dst of (source, relations), a JSON array of arrays of two or three names; two have the type RELATES_TO."""
    items = rows.select("source", F.explode(F.from_json("relations", "array<array<string>>")).alias("r")).where(F.size("r").isin(2, 3))
    two = F.size("r") == 2
    return items.select("source", F.col("r")[0].alias("src"), F.when(two, "RELATES_TO").otherwise(F.col("r")[1]).alias("rel_type"), F.when(two, F.col("r")[1]).otherwise(F.try_element_at("r", F.lit(3))).alias("dst"))


def to_json(triples: DataFrame) -> DataFrame:
    """seq and ``json``, a triple as one object."""
    kept = [c for c in triples.columns if c != "seq"]
    return triples.select("seq", F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("json"))


def from_json(rows: DataFrame) -> DataFrame:
    """The inverse of ``to_json``; absent fields get their defaults."""
    schema = "struct<subject string, subject_type string, relation string, object string, object_type string, evidence string, inferred boolean, source string, confidence double, section string, url string, timestamp string>"
    t = rows.select("seq", F.from_json("json", schema).alias("t"))
    return t.select("seq", "t.subject", "t.subject_type", "t.relation", "t.object", "t.object_type", F.coalesce("t.evidence", F.lit("")).alias("evidence"), F.coalesce("t.inferred", F.lit(False)).alias("inferred"), "t.source", F.coalesce("t.confidence", F.lit(1.0)).alias("confidence"), "t.section", "t.url", "t.timestamp")
