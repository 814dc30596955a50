"""Markdown documents as tables of titles, sections, references and clean text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.functions.text import strip, title_case

HEADING = r"(?d)^(#{1,6})\s+(.+)$"
LINK = r"\[([^\]]+)\]\(([^)]+)\)"
FENCE = "```"
#: From a line that begins with a fence to the next such line, or to the end.
FENCED = r"(?msdU)^[^\S\n]*```.*?(?:\n[^\S\n]*```[^\n]*(?:\n|\z)|\z)"
#: Lines of page furniture, whatever their case.
FURNITURE = r"(?id)^---$|^\[.*\]\(.*\)$|^Table of Contents.*|^Navigation.*"


def file_stem(path: Column) -> Column:
    """The last part of a path without its last suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]+$", "")


def title(content: Column, path: Column) -> Column:
    """The first heading of level 1; without one the file's stem, with spaces for underscores, in title case."""
    found = strip(F.regexp_extract(content, r"(?md)^#\s+(.+)$", 1))
    return F.when(content.rlike(r"(?md)^#\s+(.+)$"), found).otherwise(title_case(F.replace(file_stem(path), F.lit("_"), F.lit(" "))))


def lines(docs: DataFrame, column: str = "content") -> DataFrame:
    """file_path, pos, line."""
    return docs.select("file_path", F.posexplode(F.split(F.col(column), "\n", -1)).alias("pos", "line"))


def sections(docs: DataFrame, compat_levels: bool = False) -> DataFrame:
    """file_path, section_idx, heading, level, content, start_line, end_line from (file_path, content).

    Text before the first heading belongs to no section; a heading inside a code fence begins one. With ``compat_levels``
    the first section has the level of the second, or 1 if it is alone."""
    content = F.split("content", "\n", -1)
    headed = F.filter(F.transform(content, lambda line, i: F.struct(i.alias("at"), line.alias("line"))), lambda x: x["line"].rlike(HEADING))
    heads = docs.select("file_path", content.alias("all"), headed.alias("heads")).where(F.size("heads") > 0)
    each = heads.select("file_path", "all", "heads", F.posexplode("heads").alias("section_idx", "head"))
    end = F.coalesce(F.try_element_at("heads", F.col("section_idx") + 2)["at"] - 1, F.size("all") - 1)
    level = lambda x: F.length(F.regexp_extract(x, HEADING, 1))
    own = level(F.col("head.line"))
    if compat_levels:
        own = F.when(F.col("section_idx") == 0, F.coalesce(level(F.try_element_at("heads", F.lit(2))["line"]), F.lit(1))).otherwise(own)
    body = F.array_join(F.slice("all", F.col("head.at") + 2, end - F.col("head.at")), "\n")
    return each.select("file_path", "section_idx", strip(F.regexp_extract("head.line", HEADING, 2)).alias("heading"), own.alias("level"), strip(body).alias("content"), F.col("head.at").alias("start_line"), end.alias("end_line"))


def reference_list(content: Column) -> Column:
    """Links to documents, in order, each once: those that end with ``.md``, begin with ``./`` or have a slash, without any ``./`` and ``.md``."""
    links = F.filter(F.regexp_extract_all(content, F.lit(LINK), F.lit(2)), lambda x: x.endswith(".md") | x.startswith("./") | x.contains("/"))
    return F.array_distinct(F.transform(links, lambda x: F.replace(F.replace(x, F.lit("./"), F.lit("")), F.lit(".md"), F.lit(""))))


def references(docs: DataFrame) -> DataFrame:
    """file_path, pos, ref."""
    return docs.select("file_path", F.posexplode(reference_list(F.col("content"))).alias("pos", "ref"))


def first_line(content: Column) -> Column:
    """The first line that is neither blank nor a heading nor a fence; null without one."""
    trimmed = F.transform(F.split(content, "\n", -1), strip)
    return F.try_element_at(F.filter(trimmed, lambda x: (x != "") & ~x.startswith("#") & ~x.startswith(FENCE)), F.lit(1))


def clean(content: Column) -> Column:
    """Without fenced code, page furniture and outer blank lines. Inner blank lines stay, as empty ones."""
    lines_left = F.split(F.regexp_replace(content, FENCED, ""), "\n", -1)
    kept = F.filter(lines_left, lambda line: ~strip(line).rlike(FURNITURE))
    return strip(F.array_join(F.transform(kept, lambda line: F.when(strip(line) == "", "").otherwise(line)), "\n"))


def clean_lines(docs: DataFrame) -> DataFrame:
    """file_path, content: ``clean`` by windows over the table of lines, for texts of many lines."""
    order = Window.partitionBy("file_path").orderBy("pos")
    bare = strip(F.col("line"))
    fences = F.sum(bare.startswith(FENCE).cast("int")).over(order)
    told = lines(docs).withColumns({"bare": bare, "open": fences % 2 == 1})
    kept = told.where(~F.col("bare").startswith(FENCE) & ~F.col("open") & ((F.col("bare") == "") | ~F.col("bare").rlike(FURNITURE)))
    joined = kept.groupBy("file_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("bare") == "", "").otherwise(F.col("line")).alias("line")))), lambda x: x["line"]), "\n").alias("content"))
    return docs.select("file_path").join(joined, "file_path", "left").select("file_path", strip(F.coalesce("content", F.lit(""))).alias("content"))


def section_url(path: Column, headings: Column, base: str | None) -> Column:
    """``base``/stem and the headings from the outermost, each after a hash, lower-cased with hyphens for spaces; null without a base."""
    if not base:
        return F.lit(None).cast("string")
    anchors = F.transform(headings, lambda h: F.replace(F.lower(h), F.lit(" "), F.lit("-")))
    return F.concat(F.lit(f"{base}/"), file_stem(path), F.lit("#"), F.array_join(anchors, "#"))


def documents(docs: DataFrame) -> DataFrame:
    """file_path, title, content, refs, first_line from (file_path, content)."""
    return docs.select("file_path", title(F.col("content"), F.col("file_path")).alias("title"), "content", reference_list(F.col("content")).alias("refs"), first_line(F.col("content")).alias("first_line"))
