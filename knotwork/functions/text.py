"""Text expressions. All are built in but ``title_case`` and ``closest_ratio``, which are meant for few distinct values."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(text: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def unix_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\r\n?", "\n")


def quoted(literal: str) -> str:
    """A pattern for ``literal`` itself."""
    return r"\Q" + literal.replace(r"\E", r"\E\\E\Q") + r"\E"


def quoted_column(literal: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(literal, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def mentions(text: Column, term: Column) -> Column:
    """Whether ``term`` occurs as a whole word, whatever its case."""
    return F.regexp_like(text, F.concat(F.lit(r"(?iuU)\b"), quoted_column(term), F.lit(r"\b")))


def occurrences(text: Column, pattern: Column) -> Column:
    """All matches of a pattern, whatever their case, as they are written."""
    return F.regexp_extract_all(text, F.concat(F.lit("(?iuU)"), pattern), F.lit(0))


def context(text: Column, term: Column, window: int = 120) -> Column:
    """``window`` characters on both sides of the first occurrence of ``term``, white space collapsed; null without one."""
    at = F.regexp_instr(text, F.concat(F.lit("(?iuU)"), quoted_column(term)))
    begin = F.greatest(at - window, F.lit(1))
    around = F.substring(text, begin, at + F.length(term) + window - begin)
    return F.when(at > 0, strip(F.regexp_replace(around, r"(?U)\s+", " ")))


def token_estimate(text: Column) -> Column:
    """A token is about four characters."""
    return F.floor(F.length(text) / 4).cast("int")


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""))


def said(subject: Column, relation: Column, obj: Column) -> Column:
    """A triple's lower-cased parts, with a bar between them."""
    return F.concat_ws("|", F.lower(subject), F.lower(relation), F.lower(obj))


def digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def fingerprint(subject: Column, relation: Column, obj: Column) -> Column:
    """The md5 of what a triple says."""
    return digest(said(subject, relation, obj))


def relation_type(name: Column) -> Column:
    """Upper case with underscores, or null where other characters than letters, digits and underscores remain or nothing else does."""
    upper = F.upper(F.replace(name, F.lit(" "), F.lit("_")))
    return F.when(upper.rlike(r"(?U)^[\p{L}\p{N}_]+$") & upper.rlike(r"(?U)[\p{L}\p{N}]"), upper)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of doubles; null where a norm is 0."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


@F.arrow_udf(T.StringType())
def title_case(text: pa.Array) -> pa.Array:
    return pa.array([x if x is None else x.title() for x in text.to_pylist()], pa.string())


def closest_ratio(names: list[str], least: float):
    """A column function: the first of ``names`` with the greatest ratio of matching characters to ``text``, at ``least``; else null."""
    lower = [n.lower() for n in names]

    def closest(text: pa.Array) -> pa.Array:
        from difflib import SequenceMatcher

        out = []
        for x in text.to_pylist():
            ratios = [SequenceMatcher(None, x, n).ratio() for n in lower] if x is not None else [0.0]
            best = max(ratios, default=0.0)
            out.append(names[ratios.index(best)] if x is not None and best >= least else None)
        return pa.array(out, pa.string())

    return F.arrow_udf(closest, "string")
