"""The queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.llm import codes, decontamination, jaccard, language, maxent, media, mixing, quality, rules, runs, sharding, sql, tokens, toxicity
from knotwork.sources.tables import table


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    """Where the vocabulary ``name`` lies: the public tokenizers' own ``path``."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    first = F.try_element_at("takes.position", F.lit(1))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", F.round(first, 9).alias("first_position")).orderBy("first_position", "doc_id")


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent.score_texts(table(spark, sf_dir, "documents"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.pack(table(spark, sf_dir, "documents"), shards=16)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(table(spark, sf_dir, "documents"))


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digests(runs.text_runs(table(spark, sf_dir, "documents"), seed="crc32(CAST(CAST(doc_id AS STRING) AS BINARY))"))


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES = {"op1_quality": op1_quality, "op2_mixing": op2_mixing, "op3_language": op3_language, "op4_lm": op4_lm, "op5_jaccard": op5_jaccard, "op6_toxicity": op6_toxicity, "op7_decontamination": op7_decontamination, "op10_sharding": op10_sharding, "op8_media": op8_media, "op9_tokens": op9_tokens, "op11_rules": op11_rules, "op12_runs": op12_runs, "op13_codes": op13_codes}
ORACLE: dict[str, str] = {
    "op11_rules": sql.op11_rules(),
    "op13_codes": sql.op13_codes(),
    "op2_mixing": r"""
WITH d AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS key
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS k
    FROM d GROUP BY source),
w AS (
    SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
        CASE k WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
        CASE k WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS slope
    FROM s),
l AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w),
o AS (SELECT min_by(level, cap / weight) AS level FROM l WHERE cap / weight > level),
t AS (
    SELECT l.source, source_size, least(cap, coalesce(o.level * weight, cap)) AS target, slope
    FROM l CROSS JOIN o),
b AS (
    SELECT doc_id, size, source_size, target, slope, CAST(floor(target + 0.5) AS BIGINT) AS goal,
        coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
    SELECT *, greatest(0, least(size, goal - before)) AS p0, greatest(0, least(size, goal - source_size - before)) AS p1,
        CASE WHEN goal > before AND size > 0 THEN before::DOUBLE / goal END AS u
    FROM b)
SELECT doc_id, size, source_size, target, CAST(p0 + p1 AS BIGINT) AS taken,
    round(2 * u / ((1 - slope) + sqrt((1 - slope) * (1 - slope) + 4 * slope * u)), 9) AS first_position
FROM p"""
}
