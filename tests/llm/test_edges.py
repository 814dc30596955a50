"""Every operator over nulls, empty and long texts, ties, repeated rows, empty tables and columns of clashing names."""

import public_tokenizers
import pytest

from knotwork.llm import decontamination, jaccard, language, maxent, media, mixing, quality, rules, runs, sharding, tokens, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BENCHMARK = "item_id long, text string"


def operators(spark, labels):
    bench = spark.createDataFrame([(1, "a row without a number"), (2, None), (3, "")], BENCHMARK)
    return {
        "quality": lambda d: quality.score_quality(d, labels),
        "mixing": lambda d: mixing.mix(d),
        "mixed": lambda d: mixing.mixed_documents(d),
        "language": lambda d: language.identify(d),
        "identified": lambda d: language.identified_documents(d),
        "lm": lambda d: maxent.score_texts(d),
        "jaccard": lambda d: jaccard.join_components(d),
        "distinct": lambda d: jaccard.distinct_documents(d),
        "toxicity": lambda d: toxicity.score_toxicity(d, labels),
        "contaminated": lambda d: decontamination.contaminated(d, bench),
        "clean": lambda d: decontamination.clean_documents(d, bench),
        "media": lambda d: media.media_features(d),
        "tokens": lambda d: tokens.count_tokens(d, MODEL),
        "sharding": lambda d: sharding.pack(d),
        "rules": lambda d: rules.apply_rules(d, labels),
        "runs": lambda d: runs.run_digests(runs.text_runs(d)),
    }


WHOLE = ["quality", "mixing", "language", "lm", "jaccard", "toxicity", "media", "tokens", "sharding", "rules", "runs"]
FILTERS = ["mixed", "identified", "distinct", "clean"]


def test_empty_tables(spark, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, op in operators(spark, none).items():
        assert op(nothing).count() == 0, name
    assert decontamination.contaminated(nothing, spark.createDataFrame([], BENCHMARK)).count() == 0


def numbered(r):
    return tuple(round(x, 9) if isinstance(x, float) else str(x) for x in r)


@pytest.mark.parametrize("name", WHOLE)
def test_a_row_for_each_row_whatever_the_columns(spark, docs, clashing, labels, name):
    op = operators(spark, labels)[name]
    plain, clash = op(docs), op(clashing)
    assert plain.columns == clash.columns
    a, b = sorted(map(numbered, plain.collect())), sorted(map(numbered, clash.collect()))
    assert len(a) == docs.count()
    assert a == b


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_all_columns(spark, docs, clashing, labels, name):
    op = operators(spark, labels)[name]
    got = op(clashing)
    assert got.columns == clashing.columns
    assert sorted(map(str, got.select(docs.columns).collect())) == sorted(map(str, op(docs).collect()))


def test_links_with_the_benchmark_whatever_the_columns(spark, docs, clashing, labels):
    op = operators(spark, labels)["contaminated"]
    planted = " ".join(f"planted{i}" for i in range(30))
    bench = spark.createDataFrame([(1, planted), (2, planted), (3, None), (4, "")], "item_id long, text string")
    assert sorted(map(numbered, op(docs).collect())) == sorted(map(numbered, op(clashing).collect()))
    texts = [(5, planted), (5, planted), (6, "word " * 200_000 + planted), (None, planted), (7, None), (8, ""), (9, "word " * 100)]
    got = decontamination.contaminated(spark.createDataFrame(texts, "doc_id long, text string"), bench).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["common_words"]) for r in got) == sorted((str(d), i, 30) for d in (5, 5, 6, None) for i in (1, 2))


def test_without_labels_or_training_texts(spark, docs, labels):
    none = labels.where("false")
    assert {r["score"] for r in quality.score_quality(docs, none).select("score").distinct().collect()} == {0.5}
    assert {r["score"] for r in toxicity.score_toxicity(docs, none).select("score").distinct().collect()} == {0.0}
    unlabelled = docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r["lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}
    untrained = docs.where("doc_id IS NULL")
    assert {(r["base_score"], r["train_tokens"]) for r in maxent.score_texts(untrained).collect()} == {(0.0, 0)}
