import random

import pytest

WORDS = {
    "en": "the of and a to in is that for it with as was on be at by this have from or one had not but what all were when we there can an your which".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei".split(),
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au pour pas vous par sur faire plus dire me on mon lui nous".split(),
}
#: Names of columns that the operators use themselves.
CLASHES = ["score", "held_out", "shard", "size", "tk", "a", "b", "row", "key", "part", "h", "n", "rid", "own", "k", "y", "takes", "before", "__tk"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, lang="en", n=60):
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "", "s", "x" + str(rng.randrange(50))]) for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """300 texts in three languages, with copies, near copies, nulls and repeated rows."""
    rng = random.Random(5)
    rows = []
    for i in range(280):
        lang = rng.choice(list(WORDS))
        rows.append((i, prose(rng, lang, rng.randrange(1, 120)), lang, f"src{i % 7 if i % 3 else 0}", 1))
    for i in range(280, 290):
        rows.append((i, rows[i - 280][1], "en", "src0", 1))
    for i in range(290, 296):
        rows.append((i, rows[i - 200][1] + " tail", "en", None, 1))
    rows += [(296, None, "en", "src1", 1), (297, "", None, "src1", 0), (298, "123 \t !!", "en", None, 9), (None, "a row without a number", "en", "src2", 1), (None, None, None, None, None), (3, rows[3][1], rows[3][2], rows[3][3], 1), (299, prose(rng, "en", 30_000), "en", "src3", 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *(F.lit("clash").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark, docs):
    rows = [(r["doc_id"], int(r["doc_id"] % 4 > 0), int(r["doc_id"] % 5 == 0)) for r in docs.collect() if r["doc_id"] is not None]
    rows += [(None, 1, 1), (1, None, None), (10_000, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
