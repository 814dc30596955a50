"""Names and relations in canonical form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.functions.text import closest_ratio, strip
from knotwork.functions.vocabulary import NAME_PREFIX, NAME_SUFFIX, PLAIN_RELATIONS, RELATIONS, SERVICE_SUFFIXES
from knotwork.operators.asking import Client, ask_once, ask_rows
from knotwork.plans.lineage import cut

#: Rows of a table that goes to every task. A larger one is joined by a shuffle.
SMALL = 200_000


def small(df: DataFrame, rows: int = SMALL) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def variants(registry: DataFrame) -> DataFrame:
    """variant, canonical, entity_type of a registry (name, entity_type, synonyms, priority): of a variant's entities that of the greatest priority."""
    each = registry.select("name", "entity_type", "priority", F.explode(F.array_distinct(F.transform(F.concat(F.array("name"), F.coalesce("synonyms", F.array().cast("array<string>"))), lambda s: F.lower(strip(s))))).alias("variant"))
    best = F.max_by(F.struct("name", "entity_type"), F.struct("priority", "name"))
    return each.groupBy("variant").agg(best.alias("e")).select("variant", F.col("e.name").alias("canonical"), F.col("e.entity_type").alias("entity_type"))


def find_canonical(names: DataFrame, registry: DataFrame, typed: bool = True) -> DataFrame:
    """``names`` (name, entity_type, …) with ``canonical``: that of the variant, null without one or, if ``typed``, with another type."""
    v = small(variants(registry).withColumnRenamed("entity_type", "found_type"))
    met = names.join(v, F.lower(strip(F.col("name"))) == F.col("variant"), "left")
    canonical = F.when(F.col("found_type") == F.col("entity_type"), F.col("canonical")) if typed else F.col("canonical")
    return met.select(*(names[c] for c in names.columns), canonical.alias("canonical"))


def add_entities(registry: DataFrame, more: DataFrame) -> DataFrame:
    """A registry with the entities of ``more``, which replace those of the same name and type."""
    return registry.join(more.select("name", "entity_type"), ["name", "entity_type"], "left_anti").select(registry.columns).unionByName(more)


def get_entity(registry: DataFrame, name: str, entity_type: str) -> DataFrame:
    return registry.where((F.col("name") == name) & (F.col("entity_type") == entity_type))


def bare_name(name: Column) -> Column:
    """Lower-cased, without a maker's name before it and without one or the word service after it."""
    return F.regexp_replace(F.regexp_replace(F.lower(strip(name)), NAME_PREFIX, ""), NAME_SUFFIX, "")


def normalize_names(names: DataFrame, registry: DataFrame, try_raw_first: bool = False) -> DataFrame:
    """Distinct name, entity_type with canonical, confidence and method ("exact" or "none").

    Looked up: the bare name and, of services, the bare name without one word for a part of them; before both, with
    ``try_raw_first``, the name itself. The first variant of the right type counts."""
    distinct = names.select("name", "entity_type").distinct()
    bare = bare_name(F.col("name"))
    shorter = [F.when((F.col("entity_type") == "Service") & bare.endswith(s), strip(F.substring(bare, F.lit(1), F.length(bare) - len(s)))) for s in SERVICE_SUFFIXES]
    tried = F.array(*([F.lower(strip(F.col("name")))] if try_raw_first else []), bare, *shorter)
    each = distinct.select("name", "entity_type", F.posexplode(tried).alias("rank", "variant"))
    met = each.join(small(variants(registry)), ["variant", "entity_type"], "left")
    out = met.groupBy("name", "entity_type").agg(F.min_by("canonical", F.when(F.col("canonical").isNotNull(), F.col("rank"))).alias("canonical"))
    return out.select("name", "entity_type", "canonical", F.when(F.col("canonical").isNotNull(), 1.0).otherwise(0.0).alias("confidence"), F.when(F.col("canonical").isNotNull(), "exact").otherwise("none").alias("method"))


def nearest_canonical(names: DataFrame, canonical: DataFrame, threshold: float = 0.75, report: dict | None = None) -> DataFrame:
    """name, entity_type, canonical, confidence of ``names`` (name, entity_type, embedding): the entity of the same type, in
    ``canonical`` (name, entity_type, embedding), of the greatest cosine similarity, if that reaches ``threshold``; the first name among equals.

    The search is exact; many canonical entities lie in cells, of which a name meets those that may hold the nearest."""
    from knotwork.operators.nearest import nearest

    return nearest(names, canonical, threshold, report)


def embed(names: DataFrame, client: Client, cache: str | None = None) -> DataFrame:
    """name, entity_type, embedding of distinct ``names`` (name, entity_type), by a client from lists of names to lists of vectors.

    The client is called once in each task. With a ``cache``, a folder, a name that has its vector is not asked for again. Names that fail have none."""
    distinct = names.select("name", "entity_type").where("name is not null").distinct()
    asked = ask_rows(distinct, client, "name", "embedding", "array<double>") if cache is None else ask_once(distinct, client, "name", cache, "embedding", "array<double>")
    return asked.where("embedding is not null").select("name", "entity_type", "embedding")


def normalize_semantic(names: DataFrame, registry: DataFrame, client: Client, threshold: float = 0.75, cache: str | None = None) -> DataFrame:
    """As ``normalize_names``, and names that no rule knows by the nearest entity of their type, with its similarity and the method "semantic"."""
    ruled = cut(normalize_names(names, registry))
    known = embed(registry, client, cache)
    left = embed(ruled.where("method = 'none'"), client, cache)
    return with_semantic(ruled, nearest_canonical(left, known, threshold))


def with_semantic(rules: DataFrame, nearest: DataFrame) -> DataFrame:
    """Rule results, and where they are "none" the nearest entity, with its similarity as confidence and the method "semantic"."""
    met = rules.alias("r").join(nearest.alias("n"), (F.col("r.name") == F.col("n.name")) & (F.col("r.entity_type") == F.col("n.entity_type")), "left")
    semantic = (F.col("r.method") == "none") & F.col("n.canonical").isNotNull()
    return met.select("r.name", "r.entity_type", F.when(semantic, F.col("n.canonical")).otherwise(F.col("r.canonical")).alias("canonical"), F.when(semantic, F.col("n.confidence")).otherwise(F.col("r.confidence")).alias("confidence"), F.when(semantic, "semantic").otherwise(F.col("r.method")).alias("method"))


def normalize_triples(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """Triples with canonical subjects and objects where ``mapping`` (name, entity_type, canonical, confidence) has them.

    The confidence is the lesser of the two where both are found, else 0."""
    out = triples
    for side in ("subject", "object"):
        m = small(mapping.where("canonical is not null").select(F.col("name").alias(side), F.col("entity_type").alias(f"{side}_type"), F.col("canonical").alias(f"__{side}"), F.col("confidence").alias(f"__{side}_confidence")))
        out = out.join(m, [side, f"{side}_type"], "left")
    both = F.col("__subject").isNotNull() & F.col("__object").isNotNull()
    changed = {"subject": F.coalesce("__subject", "subject"), "object": F.coalesce("__object", "object"), "confidence": F.when(both, F.least("__subject_confidence", "__object_confidence")).otherwise(0.0)}
    return out.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in triples.columns), *([] if "confidence" in triples.columns else [changed["confidence"].alias("confidence")]))


def mapping_conflicts(old: DataFrame, new: DataFrame) -> DataFrame:
    """name, entity_type, existing_canonical, new_canonical where two mappings differ."""
    met = old.where("canonical is not null").alias("o").join(new.where("canonical is not null").alias("n"), ["name", "entity_type"])
    return met.where("o.canonical <> n.canonical").select("name", "entity_type", F.col("o.canonical").alias("existing_canonical"), F.col("n.canonical").alias("new_canonical"))


def relation_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(strip(name)), r"(?U)[_\s]+", "_")


def normalize_relations(relations: DataFrame, paraphrases: DataFrame, keys_too: bool = True, fuzzy: float = 0.8) -> DataFrame:
    """Distinct ``relation`` with ``canonical``: by paraphrase, exactly, by a ratio of matching characters of at least
    ``fuzzy``, or as the first name that is within it or that it is within; null otherwise. Paraphrases are keyed like relations unless ``keys_too`` is false."""
    names = [*RELATIONS, *PLAIN_RELATIONS]
    key = relation_key(F.col("relation"))
    distinct = relations.select("relation").distinct().withColumn("__key", F.when(key != "", key))
    table = small(paraphrases.select((relation_key(F.col("paraphrase")) if keys_too else F.col("paraphrase")).alias("__key"), F.col("relation").alias("__of")))
    met = distinct.join(table, "__key", "left")
    close = closest_ratio(names, fuzzy)(F.col("__key"))
    part = F.coalesce(*(F.when(F.col("__key").contains(n.lower()) | F.lit(n.lower()).contains(F.col("__key")), n) for n in names))
    return met.select("relation", F.coalesce("__of", F.when(F.col("__key").isin(names), F.col("__key")), close, part).alias("canonical"))


def first_mappings(triples: DataFrame, mapping: DataFrame) -> DataFrame:
    """The mapping rows that triples (with ``seq``) use, once each, with ``first_seq`` and ``role`` (0 subject, 1 object) of their first use."""
    used = triples.select("seq", F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("subject").alias("name"), F.col("subject_type").alias("entity_type")), F.struct(F.lit(1).alias("k"), F.col("object").alias("name"), F.col("object_type").alias("entity_type")))).alias("e"))
    first = used.groupBy("e.name", "e.entity_type").agg(F.min(F.struct("seq", "e.k")).alias("at"))
    kept = first.join(mapping.where("canonical is not null"), ["name", "entity_type"])
    return kept.select("name", "entity_type", "canonical", "confidence", "method", F.col("at.seq").alias("first_seq"), F.col("at.k").alias("role"))
