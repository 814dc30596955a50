"""From documents to a graph: by vocabularies, or by a model's triples."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.functions import vocabulary
from knotwork.operators import chunking, clustering, concepts, extraction, graph, markdown, merging, normalization, store, validation
from knotwork.operators.asking import Client
from knotwork.plans.lineage import counted, cut
from knotwork.plans.settings import Settings, Templates


@dataclass
class Imported:
    """What an import gives: the graph, the tables on the way, and one row of counts."""

    nodes: DataFrame
    edges: DataFrame
    tables: dict[str, DataFrame]
    stats: dict[str, int]


def import_documents(files: DataFrame, settings: Settings = Settings(), services: DataFrame | None = None, technologies: DataFrame | None = None, patterns: list[str] | None = None, client: Client | None = None, answers: str | None = None) -> Imported:
    """The graph of (file_path, content) by vocabularies. With a ``client`` the first line of each document goes to a model, whose
    payload is {"entities": [...], "relations": [...]}; what it says is kept in the folder ``answers``, if there is one. Counts are made as the
    tables are written."""
    spark = files.sparkSession
    services = services if services is not None else vocabulary.service_vocabulary(spark)
    technologies = technologies if technologies is not None else vocabulary.technology_vocabulary(spark)
    (docs, n_docs), stats = counted(markdown.documents(files)), {}
    sections, n_sections = counted(markdown.sections(docs, settings.compat_levels))
    found, n_found = counted(concepts.concepts(docs, services, technologies, patterns if patterns is not None else vocabulary.ARCHITECTURE_TERMS))
    relations, n_relations = counted(concepts.concept_relations(docs, found, vocabulary.CONCEPT_VERBS))
    stats |= {"documents": n_docs["rows"], "sections": n_sections["rows"], "concepts": n_found["rows"], "relations": n_relations["rows"]}
    mentioned = concepts.section_mentions(sections, found)
    nodes, edges = graph.document_graph(docs, sections, found, relations, mentioned, markdown.references(docs))
    tables = {"documents": docs, "sections": sections, "concepts": found, "relations": relations}
    if client is not None:
        asked = extraction.extract(docs.where("first_line is not null").select(F.col("file_path").alias("source"), F.col("first_line").alias("prompt")), client, cache=answers)
        parts, n_parts = counted(asked.select("source", F.get_json_object("payload", "$.entities").alias("entities"), F.get_json_object("payload", "$.relations").alias("relations"), "failure"), failed=F.count("failure"))
        entities, n_entities = counted(extraction.parse_entities(parts))
        entity_relations, n_entity_relations = counted(extraction.parse_relations(parts))
        tables |= {"entities": entities, "entity_relations": entity_relations, "failures": parts.where("failure is not null").select("source", "failure")}
        stats |= {"entities": n_entities["rows"], "entity_relations": n_entity_relations["rows"], "failures": n_parts["failed"]}
        more_nodes, more_edges = graph.entity_graph(entities, entity_relations)
        nodes, edges = nodes.unionByName(more_nodes), edges.unionByName(more_edges)
    return Imported(nodes, edges, tables, stats)


def import_triples(files: DataFrame, client: Client, settings: Settings = Settings(strict=True), templates: Templates | None = None, registry: DataFrame | None = None, rules: DataFrame | None = None, embeddings: DataFrame | None = None, stored: DataFrame | None = None, embedder: Client | None = None, answers: str | None = None) -> Imported:
    """The graph of a model's triples: chunks, payloads, triples, names and relations in canonical form, validation, clusters, merging, and the store of what was there before.

    ``embeddings`` (name, entity_type, embedding) allow nearest names and clusters, and so does an ``embedder`` of names; without
    either these steps pass. Chunks without an answer are in the table ``failures``. With a folder ``answers`` a prompt that was
    answered once is not asked again, by a later run either. Counts are made as the tables are written."""
    spark = files.sparkSession
    registry = registry if registry is not None else vocabulary.registry_table(spark)
    rules = rules if rules is not None else vocabulary.rule_table(spark)
    chunks, n_chunks = counted(chunking.chunk_documents(markdown.documents(files), settings.min_tokens, settings.max_tokens, settings.url_base, settings.lossless))
    made = chunks.withColumn("prompt", chunking.prompt((templates or Templates()).get(), F.col("text"), F.col("source"), F.col("section"), F.col("url")))
    asked, n_asked = counted(extraction.extract(made.select("source", "section", "url", "chunk_idx", F.lit(settings.run_ts).alias("timestamp"), "prompt"), client, cache=answers), failed=F.count("failure"))
    parsed = extraction.parse_triples(asked, keep=["chunk_idx"])
    # the order of processing: documents by path, chunks within them, triples within a payload; as text, so that no row waits for others to be numbered
    digits = lambda c: F.lpad(F.col(c).cast("string"), 10, "0")
    triples, n_triples = counted(parsed.where("status is null").withColumn("seq", F.concat_ws("\u0000", "source", digits("chunk_idx"), digits("pos"))).drop("status", "pos", "chunk_idx"))
    if settings.normalize:
        names = triples.select(F.col("subject").alias("name"), F.col("subject_type").alias("entity_type")).unionByName(triples.select("object", "object_type").toDF("name", "entity_type"))
        if embeddings is None and embedder is not None:
            embeddings = cut(normalization.embed(names.unionByName(registry.select("name", "entity_type")), embedder))
        mapping = normalization.normalize_names(names, registry)
        if embeddings is not None:
            known = registry.select("name", "entity_type").join(embeddings, ["name", "entity_type"])
            mapping = normalization.with_semantic(mapping, normalization.nearest_canonical(embeddings.join(names.distinct(), ["name", "entity_type"], "left_semi"), known, settings.similarity))
        mapping = cut(mapping)
        triples = cut(normalization.normalize_triples(triples, mapping))
    checked = validation.validate(triples, rules, settings.min_evidence_words) if settings.validate else triples.withColumns({"error_type": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")})
    good = validation.valid(checked)
    if settings.cluster and embeddings is not None:
        entities = good.select(F.col("subject").alias("name"), F.col("subject_type").alias("entity_type")).unionByName(good.select("object", "object_type").toDF("name", "entity_type")).distinct()
        clusters = cut(clustering.cluster_entities(entities.join(embeddings, ["name", "entity_type"]), settings.similarity, settings.min_cluster_size))
        good = merging.substitute_clusters(good, clusters, clustering.cluster_canonical(clusters))
    good, n_good = counted(good)
    merged, n_merged = counted(merging.merge_triples(good, settings.run_ts))
    before = stored if stored is not None else store.empty_store(spark)
    diffed, n_diff = counted(store.diff(before, good), **store.diff_metrics())
    nodes, edges = graph.triple_graph(good)
    tables = {"chunks": chunks, "triples": triples, "checked": checked, "merged": merged, "diff": diffed, "store": store.upsert(before, good, settings.run_ts), "failures": extraction.failures(asked)}
    stats = {"chunks": n_chunks["rows"], "failures": n_asked["failed"], "triples": n_triples["rows"], "valid": n_good["rows"], "merged": n_merged["rows"]}
    return Imported(nodes, edges, tables, stats | {k: n_diff[k] for k in store.diff_metrics()})
