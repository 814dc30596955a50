"""Whole texts of an Arrow column as numpy bytes and word hashes, without a Python object for each text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Bytes that part words: space and the controls from tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: ASCII letters and digits, and every byte of other characters.
LETTER = np.zeros(256, bool)
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

BLOCK = 1 << 21
_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20


def in_small_batches(docs: DataFrame, most: str = "8m") -> DataFrame:
    """``docs``, after bounding the bytes of the batches that Python workers get, where the session has Spark's own bound of 64 MB. A text larger than that is a batch of its own."""
    conf = docs.sparkSession.conf
    if conf.get(_BATCH).rstrip("b") == str(_BATCH_DEFAULT):
        conf.set(_BATCH, most)
    return docs


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def groups(column: pa.Array, most: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) for runs of texts of at most ``most`` bytes; a longer text is alone."""
    data, offsets = buffers(column)
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        a = b


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    if 0 not in _powers or len(_powers[0][0]) < n:
        size = 1 << max(10, (n - 1).bit_length())
        out = []
        for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _powers[0] = tuple(out)
    return _powers[0]


def _hash_piece(data: np.ndarray, starts_text: np.ndarray, lower: bool, prefixes: tuple[int, ...], core: bool) -> tuple[np.ndarray, ...]:
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros((1 + len(prefixes), 0), np.uint64), none, none
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | starts_text[1:]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | starts_text[1:]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if core and len(end):
        letter = np.maximum.accumulate(np.where(LETTER[data], np.arange(n), -1))
        end = np.where(letter[end - 1] >= start, letter[end - 1] + 1, end)
    up, down = _power(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_BYTES[LOWER] if lower else _BYTES)[data] * up[:n], out=sums[1:])
    base, back = sums[start], down[start]
    hashes = [mix((sums[e] - base) * back + (e - start).astype(np.uint64) + np.uint64(k << 40)) for k, e in enumerate([end, *(np.minimum(end, start + p) for p in prefixes)])]
    return np.stack(hashes), start, end


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, prefixes: tuple[int, ...] = (), core: bool = False, piece: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hashes, starts, ends, for each text the index of its first word and one past the last of all).

    Words are runs of bytes other than white space. The hashes are an array by word; with ``prefixes``, a row for the words
    and one for their first p bytes each; with ``core``, a word ends with its last letter or digit, if it has one. Long texts are hashed in pieces that end at white space, so that memory follows
    ``piece``."""
    parts, at, n = [], 0, len(data)
    begins = np.zeros(n, bool)
    begins[offsets[:-1][offsets[:-1] < n]] = True
    while at < n:
        to = min(n, at + piece)
        while to < n:
            gap = np.flatnonzero(SPACE[data[at:to]])
            if len(gap):
                to = at + int(gap[-1]) + 1
                break
            to = min(n, to + piece)
        h, s, e = _hash_piece(data[at:to], begins[at:to], lower, prefixes, core)
        parts.append((h, s + at, e + at))
        at = to
    if not parts:
        parts = [_hash_piece(data, begins, lower, prefixes, core)]
    h = np.concatenate([x[0] for x in parts], axis=1)
    s, e = (np.concatenate([x[i] for x in parts]) for i in (1, 2))
    return h if prefixes else h[0], s, e, np.searchsorted(s, offsets)
