from knotwork.operators import chunking, markdown
from pyspark.sql import functions as F


def docs(spark, *contents, path="a/My_doc-s.md"):
    return spark.createDataFrame([(path.replace(".md", f"{i}.md") if i else path, c) for i, c in enumerate(contents)], "file_path string, content string")


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_sections_have_their_lines_and_levels(spark):
    df = docs(spark, "# T\nintro\n### S\nbody\n## U\nend")
    assert rows(markdown.sections(df).orderBy("section_idx"), "heading", "level", "start_line", "end_line", "content") == [("T", 1, 0, 1, "intro"), ("S", 3, 2, 3, "body"), ("U", 2, 4, 5, "end")]
    assert [r[0] for r in rows(markdown.sections(df, compat_levels=True).orderBy("section_idx"), "level")] == [3, 3, 2]


def test_sections_skip_what_stands_before_and_see_fences(spark):
    assert rows(markdown.sections(docs(spark, "pre\n# T")), "heading", "start_line", "end_line", "content") == [("T", 1, 1, "")]
    assert markdown.sections(docs(spark, "no heading", "", None)).count() == 0
    assert [r[0] for r in rows(markdown.sections(docs(spark, "```\n# in\n```")), "heading")] == ["in"]


def test_titles(spark):
    df = docs(spark, "x\n#  A b \n", "none", "")
    assert [r[0] for r in rows(df.select("file_path", markdown.title(F.col("content"), F.col("file_path")).alias("t")).orderBy("file_path"), "t")] == ["A b", "My Doc-S1", "My Doc-S2"]


def test_references(spark):
    text = "[a](./AWS_X.md) [b](../images/p.png) [c](https://h.example/a) [d](#top) [e](y.md) [f](./y.md)"
    assert rows(markdown.references(docs(spark, text)).orderBy("pos"), "ref") == [("AWS_X",), (".images/p.png",), ("https://h.example/a",), ("y",)]


def test_first_line_and_clean(spark):
    text = "\n# H\n```\ncode\n```\n---\nTable of Contents here\n\n[x](y)\n  kept \n\nlast\n"
    got = docs(spark, text).select(markdown.first_line(F.col("content")), markdown.clean(F.col("content"))).first()
    assert got[0] == "code" and got[1] == "# H\n\n  kept \n\nlast"
    assert rows(markdown.clean_lines(docs(spark, text)), "content") == [(got[1],)]
    more = ["```\nopen", "a\n```x\n```\n```\nin\n\t``` \nb", "``` one line ```\nstill in\n```\nout", "", "\n\n", "a\n" + "```\nc\n```\n" * 3000 + "b", "x ``` y\nz", None]
    df = docs(spark, *more)
    both = df.select("file_path", markdown.clean(F.col("content")).alias("a")).join(markdown.clean_lines(df), "file_path").where("NOT (coalesce(a, '') <=> content)")
    assert both.collect() == []


def test_section_url(spark):
    df = docs(spark, "x", path="p/q/Guide.v2.md")
    assert rows(df.select(markdown.section_url(F.col("file_path"), F.array(F.lit("A B"), F.lit("C")), "http://b").alias("u"), markdown.section_url(F.col("file_path"), F.array(F.lit("A")), None).alias("n")), "u", "n") == [("http://b/Guide.v2#a-b#c", None)]


def chunks(text, lossless=False):
    return [(c["section"], c["heading_path"], c["start_line"], c["end_line"], c["token_count"]) for c in chunking.fold_lines(text, "T", 10, 30, lossless)]


def test_chunks_carry_the_next_heading_and_lose_small_rests():
    a, b = "a" * 40, "b" * 40
    assert chunks(f"# A\n{a}\n## B\n{b}") == [("B", ["A", "B"], 0, 1, 11), ("B", ["A", "B"], 2, 3, 11)]
    assert chunks(f"# A\naaaa\n{'x' * 200}\ntail") == [("A", ["A"], 0, 3, 3)]
    assert chunks(f"# A\n{a}\n## B\nbb") == [("B", ["A", "B"], 0, 1, 11)]
    assert chunks("") == [("T", [], 0, 0, 0)]
    lines = "\n".join(f"l{i:02d} " + "y" * 36 for i in range(6))
    assert [x[2:] for x in chunks(f"# A\n{lines}")] == [(0, 2, 21), (3, 5, 30), (6, 6, 10)]


def test_lossless_chunks_keep_every_line():
    for text in (f"# A\naaaa\n{'x' * 200}\ntail", f"# A\n{'a' * 40}\n## B\nbb"):
        got = "\n".join(c["text"] for c in chunking.fold_lines(text, "T", 10, 30, lossless=True))
        assert got == text


def test_chunk_table(spark):
    df = docs(spark, "# A\n" + "a" * 60 + "\n## B\n" + "b" * 60, "").withColumn("title", F.lit("T"))
    got = chunking.chunk_documents(df, 10, 30, "http://b").orderBy("source", "chunk_idx").collect()
    assert [(r["chunk_idx"], r["url"], r["level"]) for r in got[:2]] == [(0, "http://b/My_doc-s#a#b", 2), (1, "http://b/My_doc-s#a#b", None)]
    assert got[2]["token_count"] == 0
