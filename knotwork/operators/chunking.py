"""Documents in chunks of a bounded number of estimated tokens."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.operators.markdown import clean, section_url

_HEADING = re.compile(r"(#{1,6})\s+(.+)$")
_CHUNK = "array<struct<chunk_idx int, text string, section string, heading_path array<string>, level int, start_line int, end_line int, token_count int>>"


def fold_lines(text: str, title: str, least: int, most: int, lossless: bool = False) -> Iterator[dict]:
    """Chunks of a clean text, by one pass over its lines with the open headings and the open chunk as state.

    A heading closes the open chunk if that has ``least`` tokens; the chunk then carries the new heading's path. A line
    that takes the chunk over ``most`` tokens begins the next one. Where what remains has not ``least`` tokens that line
    is lost, and so is a last chunk that small, if there are others; ``lossless`` keeps both: the line stays, and the last
    chunk is given out. Line numbers are those of the clean text."""
    headings: list[tuple[int, str]] = []
    held: list[str] = []
    size = start = given = 0
    section, path = title, []

    def tokens() -> int:
        # the joined text without outer white space; its length is kept up, and stripped only when it decides
        return max(0, size - 1) // 4

    def chunk(end: int, level: int | None) -> dict:
        body = "\n".join(held).strip()
        return {"chunk_idx": given, "text": body, "section": section, "heading_path": list(path), "level": level, "start_line": start, "end_line": end, "token_count": len(body) // 4}

    rows = text.split("\n")
    for i, line in enumerate(rows):
        found = _HEADING.match(line)
        if found:
            level, name = len(found[1]), found[2].strip()
            headings = [h for h in headings if h[0] < level] + [(level, name)]
            section, path = name, [h[1] for h in headings]
            if held and tokens() >= least and (c := chunk(i - 1, level))["token_count"] >= least:
                yield c
                given, held, size, start = given + 1, [], 0, i
            held.append(line)
            size += len(line) + 1
            continue
        held.append(line)
        size += len(line) + 1
        if tokens() > most and len(held) > 1 and len("\n".join(held).strip()) // 4 > most:
            held.pop()
            size -= len(line) + 1
            if (c := chunk(i - 1, None))["token_count"] >= least:
                yield c
                given, held, size, start = given + 1, [line], len(line) + 1, i
            elif lossless:
                held.append(line)
                size += len(line) + 1
    if held and ((c := chunk(len(rows) - 1, None))["token_count"] >= least or not given or lossless):
        yield c


def chunk_documents(docs: DataFrame, min_tokens: int = 1000, max_tokens: int = 3000, url_base: str | None = None, lossless: bool = False) -> DataFrame:
    """source, chunk_idx, text, section, heading_path, level, url, title, start_line, end_line, token_count from (file_path, title, content).

    ``level`` is that of the heading that closed the chunk, null for others."""

    def fold(text: pa.Array, title: pa.Array) -> pa.Array:
        out = [None if x is None else list(fold_lines(x, t, min_tokens, max_tokens, lossless)) for x, t in zip(text.to_pylist(), title.to_pylist())]
        names = [("chunk_idx", pa.int32()), ("text", pa.string()), ("section", pa.string()), ("heading_path", pa.list_(pa.string())), ("level", pa.int32()), ("start_line", pa.int32()), ("end_line", pa.int32()), ("token_count", pa.int32())]
        return pa.array(out, pa.list_(pa.struct(names)))

    chunks = docs.select("file_path", "title", F.explode(F.arrow_udf(fold, _CHUNK)(clean(F.col("content")), F.col("title"))).alias("c"))
    return chunks.select(F.col("file_path").alias("source"), "c.chunk_idx", "c.text", "c.section", "c.heading_path", "c.level", section_url(F.col("file_path"), F.col("c.heading_path"), url_base).alias("url"), "title", "c.start_line", "c.end_line", "c.token_count")


def format_chunk(source: Column, section: Column, heading_path: Column, url: Column, created_at: Column, text: Column) -> Column:
    """A chunk under a header of its source, section, address and date; the last two where they are known."""
    where = F.when(F.size(heading_path) > 0, F.array_join(heading_path, " > ")).otherwise(section)
    return F.concat_ws(
        "\n", F.concat(F.lit("---SOURCE: "), source, F.lit("---")), F.concat(F.lit("Section: "), where), F.when(url != "", F.concat(F.lit("URL: "), url)),
        F.concat(F.lit("Date: "), created_at), F.lit(""), F.lit("Text:"), F.lit(""), text, F.lit(""), F.lit("---"),
    )


def chunk_metadata(source: Column, section: Column, heading_path: Column, url: Column, start_line: Column, end_line: Column, token_count: Column) -> Column:
    return F.struct(source.alias("source"), section.alias("section"), heading_path.alias("heading_path"), url.alias("url"), start_line.alias("start_line"), end_line.alias("end_line"), token_count.alias("token_count"))


def prompt(template: str, text: Column, source: Column | None = None, section: Column | None = None, url: Column | None = None) -> Column:
    """The template, what is known of where the text is from, and the text."""
    known = [F.concat(F.lit(f"{name}: "), c) for name, c in (("Source", source), ("Section", section)) if c is not None]
    if url is not None:
        known.append(F.when(url != "", F.concat(F.lit("URL: "), url)))
    where = F.concat_ws("\n", *known) if known else F.lit("")
    return F.concat(F.lit(template), F.when(where != "", F.concat(where, F.lit("\n\n"))).otherwise(""), text)
