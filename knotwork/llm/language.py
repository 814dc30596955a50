"""Language identification by prediction by partial matching (operator 3).

Each language has a tree of byte contexts of up to three bytes with the counts of the bytes that followed. Under these
frozen counts a byte is coded in the longest context seen: a byte seen there costs ``-log2(n / (t + d))``, with n its
count, t the context's total and d its number of distinct bytes; any other byte costs the escape ``-log2(d / (t + d))``
and its code in the next shorter context, at last 8 bits. The language with the shortest code for the whole text wins,
the first by code point among equals. A text is coded as if three line feeds stood before it.

The counts come from a bounded sample of labelled texts, whole ones: about ``SAMPLE`` for each language, picked by a hash
of doc_id, so that the sample does not grow with the table. Every value of ``lang`` in the training texts is learned, and
every context of the sample is kept. The tables have a column for each language, so memory follows the languages times the
contexts of the sample, and time the languages times the bytes of text."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.llm import text as tx

#: Expected training texts of a language.
SAMPLE = 3000
ORDER = 3
STEP = 1 << 19
UNKNOWN = "und"
#: A text that costs more bits a byte in every language is in none of them: bytes never seen in training cost as much, while keys and numbers among words cost less.
FOREIGN = 12.0


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of doc_id as text leaves ``fold`` modulo ``folds``; true for a null doc_id, which is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(True))


def _windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with three line feeds before each, and the place of each byte there."""
    n = len(offsets) - 1
    of = np.repeat(np.arange(1, n + 1), np.diff(offsets))
    at = np.arange(len(data)) + ORDER * of
    out = np.full(len(data) + ORDER * n, 10, np.uint8)
    out[at] = data
    return out, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column, lang = batch.column("text"), batch.column("k").to_numpy().astype(np.uint64)
        for a, b, data, offsets in tx.groups(column):
            x, at = _windows(data, offsets)
            x = x.astype(np.uint64)
            code = np.repeat(lang[a:b], np.diff(offsets)) << np.uint64(32)
            for i in range(ORDER + 1):
                code |= x[at - ORDER + i] << np.uint64(8 * (ORDER - i))
            code, n = np.unique(code, return_counts=True)
            yield pa.record_batch({"code": pa.array(code.astype(np.int64)), "n": pa.array(n.astype(np.int64))})


class Slots:
    """The numbers, from 1, of sorted (context, byte) pairs: a bit for each byte of a context, and how many pairs come before each 64 of them."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, contexts: int, size: int):
        self.wide = -(-size // 64)
        word = context * self.wide + (byte >> 6)
        self.bits = np.zeros(contexts * self.wide, np.uint64)
        np.bitwise_or.at(self.bits, word, np.uint64(1) << (byte & 63).astype(np.uint64))
        self.before = np.searchsorted(word, np.arange(contexts * self.wide)).astype(np.int32)

    def find(self, context: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The pair's number, or 0."""
        word = context * self.wide + (byte >> 6)
        bits, at = self.bits[word], (byte & 63).astype(np.uint64)
        lower = np.bitwise_count(bits & ((np.uint64(1) << at) - np.uint64(1)))
        return np.where((bits >> at) & np.uint64(1), self.before[word] + lower + 1, 0)


class Model:
    """The context trees of all languages as tables. Row 0 of a table stands for what was not seen."""

    def __init__(self, languages: list[str], code: np.ndarray, n: np.ndarray):
        self.languages = languages
        many = len(languages)
        lang = (code >> 32).astype(np.int64)
        used = np.zeros(256, bool)
        quads = np.stack([(code >> (8 * (ORDER - i))) & 255 for i in range(ORDER + 1)])
        used[quads] = True
        self.symbol = np.zeros(256, np.int32)
        self.symbol[used] = np.arange(1, used.sum() + 1)
        self.size = size = int(used.sum()) + 1
        quads = self.symbol[quads].astype(np.int64)
        self.levels = []
        # below order 0: eight bits for any byte
        lower = lambda context, byte: np.full((len(byte), many), 8.0, np.float32)
        for order in range(ORDER + 1):
            context = np.zeros(len(code), np.int64)
            for i in range(ORDER - order, ORDER):
                context = context * size + quads[i]
            keys, inverse = np.unique(context, return_inverse=True)
            byte = quads[ORDER]
            ids = np.zeros(size**order, np.int32)
            ids[keys] = np.arange(1, len(keys) + 1)
            pair, where = np.unique((inverse + 1) * size + byte, return_inverse=True)
            slots = Slots(pair // size, pair % size, len(keys) + 1, size)
            seen = np.zeros((len(pair) + 1, many))
            np.add.at(seen, (where + 1, lang), n)
            total, kinds = np.zeros((len(keys) + 1, many)), np.zeros((len(keys) + 1, many))
            np.add.at(total, pair // size, seen[1:])
            np.add.at(kinds, pair // size, seen[1:] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(kinds / (total + kinds)), 0.0).astype(np.float32)
                own = -np.log2(seen[1:] / (total + kinds)[pair // size])
            full = np.concatenate([[0], keys])[pair // size]
            shorter = lower(full % size ** max(0, order - 1), pair % size)
            cost = np.zeros((len(pair) + 1, many), np.float32)
            cost[1:] = np.where(seen[1:] > 0, own, escape[pair // size] + shorter)
            self.levels.append((ids, slots, cost, escape))
            lower = lambda context, byte, order=order: self.bits(order, context, byte)

    def bits(self, order: int, context: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Code lengths under each language of bytes in contexts of ``order`` symbols."""
        if order < 0:
            return np.full((len(byte), len(self.languages)), 8.0, np.float32)
        ids, slots, cost, escape = self.levels[order]
        known = ids[context]
        found = slots.find(known, byte)
        out = cost[found]
        missing = np.flatnonzero(found == 0)
        if len(missing):
            out[missing] = escape[known[missing]] + self.bits(order - 1, context[missing] % self.size ** max(0, order - 1), byte[missing])
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text under each language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        padded, at = _windows(data, offsets)
        padded = self.symbol[padded]
        for i in range(0, len(at), STEP):
            p = at[i : i + STEP]
            context = (padded[p - 3] * self.size + padded[p - 2]) * self.size + padded[p - 1]
            bits = self.bits(ORDER, context, padded[p])
            first, last = np.searchsorted(offsets, i, "right") - 1, np.searchsorted(offsets, i + len(p), "left")
            texts = np.arange(first, last)
            texts = texts[offsets[texts + 1] > offsets[texts]]
            out[texts] += np.add.reduceat(bits, np.maximum(offsets[texts] - i, 0), axis=0, dtype=np.float64)
        return out

    def predict(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the language, confidence, bits for each byte) of each text."""
        best, score, rate = (np.zeros(len(column), t) for t in (np.int64, float, float))
        for a, b, data, offsets in tx.groups(column):
            bits = self.code_lengths(data, offsets)
            best[a:b] = bits.argmin(axis=1)
            least = bits.min(axis=1)
            score[a:b] = 1 / np.exp2(least[:, None] - bits).sum(axis=1)
            rate[a:b] = least / np.maximum(1, np.diff(offsets))
        return best, score, rate


_models: dict[str, Model] = {}


def _loaded(key: str, shared) -> Model:
    """The tables, built once in each Python worker from the broadcast counts."""
    if key not in _models:
        _models.clear()
        _models[key] = Model(*shared.value)
    return _models[key]


def train(docs: DataFrame, folds: int = 4, fold: int = 2, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, codes, counts): the four-byte windows of the sampled texts of all folds but ``fold``."""
    known = tx.in_small_batches(docs).where(~held_out(F.col("doc_id"), folds, fold) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = sorted((r["lang"], r["n"]) for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect())  # one row for each language
    spark = docs.sparkSession
    if not counts:
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    share = spark.createDataFrame([(k, lang, min(1.0, sample / n)) for k, (lang, n) in enumerate(counts)], "k long, lang string, share double")
    picked = known.select("doc_id", "lang", "text").join(F.broadcast(share), "lang").where(F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 20)) < F.col("share") * (1 << 20))
    table = picked.select("k", "text").mapInArrow(_count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    return [lang for lang, _ in counts], table["code"].to_numpy(), table["n"].to_numpy()


def predictions(text: Column, spark, trained: tuple[list[str], np.ndarray, np.ndarray]) -> Column:
    """A struct of lang_pred, score and bits_per_byte. A null text or one without a letter is ``und`` with score 0."""
    kind = "lang_pred string, score double, bits_per_byte double"
    letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(8.0).alias("bits_per_byte"))
    if not trained[0]:
        return none
    shared, name = spark.sparkContext.broadcast(trained), uuid.uuid4().hex

    def run(column: pa.Array) -> pa.Array:
        model = _loaded(name, shared)
        best, score, rate = model.predict(column)
        names = pa.DictionaryArray.from_arrays(pa.array(best, pa.int32()), pa.array(model.languages, pa.string())).dictionary_decode()
        return pa.StructArray.from_arrays([names, pa.array(score), pa.array(rate)], ["lang_pred", "score", "bits_per_byte"])

    return F.when(letter, F.arrow_udf(run, kind)(text)).otherwise(none)


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte for each row of ``docs``, repeated rows included.

    Learns from text and non-null lang outside the held-out fold. Null and empty texts are ``und``. The score is the share
    that the language has of all languages' probabilities of the text; of equal ones the first by code point counts. A very
    long text is coded whole, ``STEP`` bytes at a time. Without any training text all rows are ``und``. Columns of other
    names are not read. An empty table gives an empty table."""
    p = predictions(F.col("text"), docs.sparkSession, train(docs, folds, fold))
    out = docs.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), p.alias("p"))
    return out.select("doc_id", "held_out", "p.*")


def identified_documents(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """The rows of ``docs`` in one of the learned languages: a text that is ``und``, or that its best language codes in more than ``FOREIGN`` bits a byte, goes."""
    p = predictions(F.col("text"), docs.sparkSession, train(docs, folds, fold))
    return docs.where((p["lang_pred"] != UNKNOWN) & (p["bits_per_byte"] <= FOREIGN))
