"""Which triples are valid, and why others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions.text import strip, word_count
from knotwork.functions.vocabulary import ENTITY_TYPES, PLAIN_ENTITY_TYPES, PLAIN_RELATIONS, RELATIONS


def validate(triples: DataFrame, rules: DataFrame, min_evidence_words: int = 3) -> DataFrame:
    """``triples`` with ``error_type`` and ``reason``, null where a triple is valid. The first error counts: a blank part, an
    unknown type, types that a relation's rules do not allow, short evidence of what is not inferred, and what the two strict
    relations ask beyond a rule table. A relation without rules allows all types."""
    rules = rules.select("subject_type", "relation", "object_type").distinct()
    ruled = F.broadcast(rules.select("relation").distinct().withColumn("__ruled", F.lit(True)))
    allowed = F.broadcast(rules.withColumn("__allowed", F.lit(True)))
    told = triples.join(ruled, "relation", "left").join(allowed, ["subject_type", "relation", "object_type"], "left")
    types = [*ENTITY_TYPES, *PLAIN_ENTITY_TYPES]
    blank = lambda c: F.coalesce(strip(F.col(c)), F.lit("")) == ""
    words = word_count(F.coalesce("evidence", F.lit("")))
    known = F.coalesce(F.col("subject_type").isin(types) & F.col("object_type").isin(types) & F.col("relation").isin([*RELATIONS, *PLAIN_RELATIONS]), F.lit(False))
    strict = (F.col("relation") == "recommended_by") & ((F.col("subject_type") != "BestPractice") | (F.col("object_type") != "Pillar"))
    strict = strict | (F.col("relation") == "addresses") & (~F.col("subject_type").isin("Mitigation", "BestPractice") | (F.col("object_type") != "Risk"))
    checks: list[tuple[Column, str, Column]] = [
        (blank("subject"), "required_field", F.lit("Subject is empty")),
        (blank("object"), "required_field", F.lit("Object is empty")),
        (blank("evidence"), "required_field", F.lit("Evidence is empty")),
        (~known, "schema", F.lit("Unknown type or relation")),
        (F.col("__ruled").isNotNull() & F.col("__allowed").isNull(), "schema", F.concat_ws(" ", F.col("subject_type"), F.col("relation"), F.col("object_type"), F.lit("is not allowed"))),
        ((words < min_evidence_words) & ~F.coalesce("inferred", F.lit(False)), "evidence", F.concat(F.lit("Evidence has "), words.cast("string"), F.lit(f" words of {min_evidence_words}"))),
        (strict, "business_rule", F.concat_ws(" ", F.col("subject_type"), F.col("relation"), F.col("object_type"), F.lit("is against a rule"))),
    ]
    kind = reason = None
    for bad, name, why in checks:
        kind = F.when(bad, name) if kind is None else kind.when(bad, name)
        reason = F.when(bad, why) if reason is None else reason.when(bad, why)
    return told.select(*(F.col(c) for c in triples.columns), kind.alias("error_type"), reason.alias("reason"))


def valid(validated: DataFrame) -> DataFrame:
    return validated.where("error_type is null").drop("error_type", "reason")


def errors(validated: DataFrame) -> DataFrame:
    return validated.where("error_type is not null")


def validation_summary(validated: DataFrame) -> DataFrame:
    """error_type, n: the valid ones as ``valid``."""
    return validated.groupBy(F.coalesce("error_type", F.lit("valid")).alias("error_type")).agg(F.count("*").alias("n"))


def compatible(rules: DataFrame, triples: DataFrame) -> DataFrame:
    """``triples`` whose types their relation allows, or whose relation has no rules."""
    ruled = F.broadcast(rules.select("relation").distinct())
    return triples.join(F.broadcast(rules), ["subject_type", "relation", "object_type"], "left_semi").select(triples.columns).unionByName(triples.join(ruled, "relation", "left_anti").select(triples.columns))


def allowed_objects(rules: DataFrame, relation: str, subject_type: str) -> DataFrame:
    return rules.where((F.col("relation") == relation) & (F.col("subject_type") == subject_type)).select("object_type").distinct()


def allowed_subjects(rules: DataFrame, relation: str, object_type: str) -> DataFrame:
    return rules.where((F.col("relation") == relation) & (F.col("object_type") == object_type)).select("subject_type").distinct()


def report(validated: DataFrame, shown: int = 20) -> str:
    """The counts by error and the first errors, as text."""
    counts = {r["error_type"]: r["n"] for r in validation_summary(validated).orderBy("error_type").collect()}
    bad = {k: n for k, n in counts.items() if k != "valid"}
    total = sum(counts.values())
    out = [f"triples {total}, valid {total - sum(bad.values())}, invalid {sum(bad.values())}", *(f"{k}: {n}" for k, n in bad.items())]
    found = errors(validated)
    order = ["seq"] if "seq" in validated.columns else ["subject", "relation", "object"]
    out += [f"{r['error_type']}: {r['reason']} ({r['subject']} {r['relation']} {r['object']})" for r in found.orderBy(*order).limit(shown).collect()]
    return "\n".join(out + ([f"and {sum(bad.values()) - shown} more"] if sum(bad.values()) > shown else []))
