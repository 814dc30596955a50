"""Exact token counts at every prefix by dynamic programming (operator 9).

The pieces of a byte-pair model are determined from the left: a prefix's last piece is the one that ends there, follows a
prefix whose last piece it may stand beside, and there is exactly one. Two pieces may stand beside each other if merging
their characters gives these two again, which is remembered for each pair. So ``count(prefix) = count(prefix without its
last piece) + 1`` gives the count at every character, and the table answers what a budget or a truncation asks without
encoding anything again.

A piece of the model begins with its white space or has none, so the table of a text is that of independent units, a run
of spaces and the characters up to the next space, each on top of the count before it. Units' tables are remembered; the
library encodes each new unit once, and where its count differs from the table's last entry it counts that unit's prefixes.

Null texts are empty and have 0 tokens. Only tables of units are kept between texts, in bounded number."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.llm.text import in_small_batches

#: Units, and pairs of pieces, remembered by a task. Beyond it the memory begins anew, which costs time only.
REMEMBERED = 800_000
#: Longer units are counted each time and not remembered. Up to this length every count is below 256.
LONG_UNIT = 60

_UNIT = re.compile("▁+[^▁]*")


@lru_cache(maxsize=2)
def _library(model: str):
    from sentencepiece import SentencePieceProcessor

    found = SentencePieceProcessor(model_file=model)
    pieces = (found.id_to_piece(i) for i in range(found.get_piece_size()))
    if any("▁" in p.lstrip("▁") for p in pieces):
        raise ValueError(f"{model}: pieces reach over white space, so units are not independent")
    return found


class PrefixCounter:
    """Tables of units, and the prefix table of a text."""

    def __init__(self, model: str):
        self.library = lib = _library(model)
        normal = (i for i in range(lib.get_piece_size()) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)))
        self.score = {lib.id_to_piece(i): lib.get_score(i) for i in normal}
        #: True for pieces, False for what only ends one
        self.ends = {p[i:]: False for p in self.score for i in range(1, len(p))} | dict.fromkeys(self.score, True)
        self.beside: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: of all neighbours that make a piece the ones of the best score are merged, the leftmost first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _may_follow(self, last: str, piece: str) -> bool:
        key = (last, piece)
        if (found := self.beside.get(key)) is None:
            if len(self.beside) >= REMEMBERED:
                self.beside = {}
            found = self.beside[key] = self.merged(last + piece) == ([last, piece] if last else [piece])
        return found

    def counts(self, unit: str, count: list[int] | None = None, last: list[str] | None = None) -> list[int]:
        """Tokens of the unit's prefixes of 1, 2, ... characters; white space is written as in pieces.

        ``count`` and ``last`` are tokens and last pieces of the prefixes that are known, from the empty one, and are added to."""
        ends, beside = self.ends, self.beside
        count, last = (count, last) if count else ([0], [""])
        for k in range(len(count), len(unit) + 1):
            begins, begin = [], k - 1
            while begin >= 0 and (whole := ends.get(unit[begin:k])) is not None:
                if whole:
                    begins.append(begin)
                begin -= 1
            tokens = 1
            if not begins or begins[0] != k - 1:  # a character that is no piece is as many as its bytes
                begins, tokens = [k - 1], len(unit[k - 1].encode())
            for begin in reversed(begins):
                key = (last[begin], unit[begin:k])
                if beside[key] if key in beside else self._may_follow(*key):
                    count.append(count[begin] + tokens)
                    last.append(key[1])
                    break
            else:
                raise ValueError(f"no last piece: {unit[:k]!r}")
        return count[1:]

    def _tabled(self, units: list[str]) -> list[list[int]]:
        """The tables of units in ascending order, each from where it parts from the one before, held against the library."""
        whole = self.library.encode([u[1:] for u in units], num_threads=1)
        out, before, count, last = [], "", [0], [""]
        for unit, pieces in zip(units, whole):
            same, most = 0, min(len(unit), len(before))
            while same < most and unit[same] == before[same]:
                same += 1
            del count[same + 1 :], last[same + 1 :]
            try:
                table = self.counts(unit, count, last)
                before = unit
            except ValueError:
                table, before, count, last = [], "", [0], [""]
            if not table or table[-1] != len(pieces):
                table = [len(self.library.encode(unit[1:k])) if k > 1 else 1 for k in range(1, len(unit) + 1)]
            out.append(table)
        return out

    def learn(self, units: set[str]) -> None:
        """Remembers the tables of short units."""
        if len(self.known) + len(units) > REMEMBERED:
            self.known = {}
        new = sorted(u for u in units if u not in self.known)
        self.known.update(zip(new, map(bytes, self._tabled(new))))

    @staticmethod
    def units(text: str) -> list[str]:
        """The units of a text with white space as in pieces, after the one space that the library puts before it."""
        whole = "▁" + text.replace(" ", "▁")
        return ["▁" + u for u in whole[1:].split("▁")] if "▁▁" not in whole and whole[-1] != "▁" else _UNIT.findall(whole)

    def _tables(self, text: str) -> list[bytes | np.ndarray]:
        units, known = self.units(text), self.known
        try:
            return [known[u] for u in units]
        except KeyError:
            self.learn({u for u in units if len(u) <= LONG_UNIT})
            return [self.known[u] if len(u) <= LONG_UNIT else np.array(self._tabled([u])[0], np.int32) for u in units]

    def table(self, text: str) -> list[int]:
        """Tokens of the prefixes of 1, 2, ... characters, one entry for each."""
        return self.entries(text).tolist()

    def entries(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        tables = self._tables(text)
        before = [0, *accumulate([int(t[-1]) for t in tables])]
        if all(type(t) is bytes for t in tables):
            within = np.frombuffer(b"".join(tables), np.uint8).astype(np.int32)
        else:
            within = np.concatenate([np.frombuffer(t, np.uint8).astype(np.int32) if type(t) is bytes else t for t in tables])
        within += np.repeat(np.array(before[:-1], np.int32), [len(t) for t in tables])
        return within[1:]  # the space that the library puts before a text is no prefix of it

    def total(self, text: str) -> int:
        table = self.entries(text)
        return int(table[-1]) if len(table) else 0

    @staticmethod
    def at(text: str, table: list[int] | np.ndarray, n_chars: int) -> int:
        """Tokens of ``text[:n_chars]``, off the table."""
        return int(table[min(n_chars, len(table)) - 1]) if n_chars > 0 and len(table) else 0

    @staticmethod
    def fit(text: str, table: list[int] | np.ndarray, budget: int) -> int:
        """The most characters of a prefix that has at most ``budget`` tokens, off the table."""
        within = np.flatnonzero(np.asarray(table) <= budget)
        return int(within[-1]) + 1 if len(within) else 0


@lru_cache(maxsize=2)
def _counter(model: str) -> PrefixCounter:
    return PrefixCounter(model)


def _texts(counter: PrefixCounter, column: pa.Array) -> Iterator[str]:
    """The texts, in runs of about 2 MB whose units are asked of the library together."""
    run, size = [], 0

    def learned():
        units = {u for text in run for u in counter.units(text) if len(u) <= LONG_UNIT}
        counter.learn(units)
        return run

    for text in column.to_pylist():
        run.append(text or "")
        size += len(run[-1])
        if size > 2_000_000:
            yield from learned()
            run, size = [], 0
    yield from learned()


def token_counts(text: Column, model: str, limit: int) -> Column:
    """A struct of n_tokens, the last entry of a text's prefix table, and ``fit_chars``, the characters of its longest prefix within ``limit`` tokens; a null text has 0."""

    def count(column: pa.Array) -> pa.Array:
        counter, n, fit = _counter(model), [], []
        for t in _texts(counter, column):
            table = counter.entries(t)
            n.append(int(table[-1]) if len(table) else 0)
            # no prefix has more tokens than bytes, so that most texts need no search
            fit.append(len(t) if n[-1] <= limit else counter.fit(t, table, limit))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(fit, pa.int64())], ["n_tokens", "fit_chars"])

    return F.arrow_udf(count, "n_tokens long, fit_chars long")(text)


def prefix_counts(text: Column, model: str) -> Column:
    """The prefix table: for each character of the text, in order, the tokens of the prefix that ends with it."""

    def count(column: pa.Array) -> pa.Array:
        counter = _counter(model)
        return pa.array([counter.entries(t) for t in _texts(counter, column)], pa.list_(pa.int32()))

    return F.arrow_udf(count, "array<int>")(text)


def truncation(table: Column, budget: int) -> Column:
    """Characters of the longest prefix within ``budget`` tokens, read off a stored prefix table."""
    return F.coalesce(F.array_max(F.transform(table, lambda n, i: F.when(n <= budget, i + 1))), F.lit(0)).cast("long")


def tokens_at(table: Column, n_chars: int) -> Column:
    """Tokens of the first ``n_chars`` characters, read off a stored prefix table."""
    return F.when((F.size(table) == 0) | F.lit(n_chars <= 0), 0).otherwise(F.element_at(table, F.least(F.size(table), F.lit(max(1, n_chars)))))


def count_tokens(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), fit_chars: a row for each row of ``docs``, repeated rows included.

    ``fit_chars`` is the length of the longest prefix within ``limit`` tokens. A null text is empty: 0 bytes and tokens. A
    null doc_id stays null. A very long text has a table of four bytes a character while it is counted. Other columns of
    ``docs`` are not read. An empty table gives an empty table. Nothing is shuffled."""
    n = in_small_batches(docs).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), token_counts(F.col("text"), model, limit).alias("t"))
    return n.select("doc_id", "n_bytes", "t.n_tokens", (F.col("t.n_tokens") > limit).alias("over_limit"), "t.fit_chars")
