"""Texts kept as images in a binary column (operator 8).

A payload becomes an 8-bit grey PNG, 64 pixels wide: chunks with checksums, rows filtered, the whole deflated. Reading
tests every checksum, undoes the filters with numpy and hashes the image by its low cosine frequencies.

Null texts are empty. The payload has zero bytes up to a positive multiple of 64, so an empty text is one row of zeros."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.llm.text import in_small_batches

WIDTH = 64
SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Most bytes of compressed data in one chunk.
CHUNK = 1 << 16
SIDE, LOW = 32, 8


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(data, zlib.crc32(kind)))


def padded(payload: bytes) -> bytes:
    return payload + bytes(-len(payload) % WIDTH if payload else WIDTH)


def encode(payload: bytes, level: int = 1) -> bytes:
    """A PNG of ``payload``, whose length is a positive multiple of 64. A row gets the filter (none, left or above) with the least sum of absolute differences."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    left, above = rows.copy(), rows.copy()
    left[:, 1:] -= rows[:, :-1]
    above[1:] -= rows[:-1]
    kinds = np.stack([rows, left, above])
    cost = np.abs(kinds.view(np.int8).astype(np.int16)).sum(axis=2)
    pick = cost.argmin(axis=0)
    lines = np.empty((len(rows), WIDTH + 1), np.uint8)
    lines[:, 0] = pick
    lines[:, 1:] = kinds[pick, np.arange(len(rows))]
    data = zlib.compress(lines.tobytes(), level)
    head = _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0))
    return SIGNATURE + head + b"".join(_chunk(b"IDAT", data[i : i + CHUNK]) for i in range(0, len(data), CHUNK)) + _chunk(b"IEND", b"")


def decode(png: bytes) -> np.ndarray:
    """The pixels of an 8-bit grey PNG. A wrong signature, checksum, kind or length raises ValueError."""
    if png[:8] != SIGNATURE:
        raise ValueError("not a PNG")
    at, head, data, ended = 8, None, [], False
    while at < len(png) and not ended:
        (n,) = struct.unpack_from(">I", png, at)
        kind, body = png[at + 4 : at + 8], png[at + 8 : at + 8 + n]
        if len(body) != n or struct.unpack_from(">I", png, at + 8 + n)[0] != zlib.crc32(body, zlib.crc32(kind)):
            raise ValueError(f"chunk {kind!r}: wrong checksum")
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            data.append(body)
        ended = kind == b"IEND"
        at += 12 + n
    if head is None or not ended or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit grey image, or cut short")
    width, height = head[:2]
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8)
    if len(lines) != height * (width + 1):
        raise ValueError("wrong number of samples")
    lines = lines.reshape(height, width + 1)
    return unfilter(lines[:, 0], lines[:, 1:])


def unfilter(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Undoes the filters of rows. Runs of rows that need no more than their left or their upper neighbour are summed at once."""
    out = rows.copy()
    left = kinds == 1
    out[left] = np.cumsum(rows[left], axis=1, dtype=np.uint8)
    if (kinds == 2).any() or (kinds > 2).any():
        cuts = np.flatnonzero(np.diff(kinds, prepend=255)) if len(kinds) else []
        for a, b in zip(cuts, [*cuts[1:], len(kinds)]):
            prior = out[a - 1] if a else np.zeros(rows.shape[1], np.uint8)
            if kinds[a] == 2:
                out[a:b] = np.cumsum(np.concatenate([prior[None], rows[a:b]]), axis=0, dtype=np.uint8)[1:]
            elif kinds[a] > 2:
                for r in range(a, b):
                    out[r] = _sequential(int(kinds[r]), rows[r], out[r - 1] if r else np.zeros(rows.shape[1], np.uint8))
    return out


def _sequential(kind: int, row: np.ndarray, above: np.ndarray) -> np.ndarray:
    if kind > 4:
        raise ValueError(f"no filter {kind}")
    up, out, a, c = above.tolist(), [], 0, 0
    for x, b in zip(row.tolist(), up):
        if kind == 3:
            guess = (a + b) // 2
        else:
            pa_, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if pa_ <= pb and pa_ <= pc else b if pb <= pc else c
        a, c = (x + guess) & 255, b
        out.append(a)
    return np.array(out, np.uint8)


def _cosines(n: int) -> np.ndarray:
    k, x = np.arange(n)[:, None], np.arange(n)[None]
    return np.cos(np.pi * k * (2 * x + 1) / (2 * n))


_LOW = _cosines(SIDE)[:LOW]


def low_frequency_hash(pixels: np.ndarray) -> str:
    """16 hex digits: of the 8 x 8 lowest cosine frequencies of the image at 32 x 32, which exceed their median."""
    h, w = pixels.shape
    rows = np.arange(SIDE + 1) * h // SIDE
    if h >= SIDE:
        small = np.add.reduceat(pixels, rows[:-1], axis=0, dtype=np.int64) / np.diff(rows)[:, None]
    else:
        small = pixels[rows[:-1]].astype(float)
    small = small.reshape(SIDE, SIDE, w // SIDE).mean(axis=2)
    low = np.round(_LOW @ small @ _LOW.T, 3).ravel()
    return np.packbits(low > np.median(low[1:])).tobytes().hex()


def to_png(text: Column) -> Column:
    """The binary column of a string column; equal texts give equal images."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([encode(padded(x.as_buffer().to_pybytes() if x.is_valid else b"")) for x in column.cast(pa.large_binary())], pa.binary())

    return F.arrow_udf(run, "binary")(text)


_FEATURES = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"


def png_features(media: Column) -> Column:
    """A struct of what the stored bytes hold: length, digest and last checksum of the payload, length and digest of the image, its hash. A null image gives nulls; a broken one raises."""

    def run(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            if not x.is_valid:
                out.append(None)
                continue
            png = x.as_buffer().to_pybytes()
            pixels = decode(png)
            payload = pixels.tobytes()
            out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(png), hashlib.sha256(png).hexdigest(), low_frequency_hash(pixels)))
        names = [x.split()[0] for x in _FEATURES.split(", ")]
        kinds = [pa.int64() if x.endswith("long") else pa.string() for x in _FEATURES.split(", ")]
        return pa.array([None if o is None else dict(zip(names, o)) for o in out], pa.struct(list(zip(names, kinds))))

    return F.arrow_udf(run, _FEATURES)(media)


def media_table(docs: DataFrame) -> DataFrame:
    """doc_id and the image of the whole text as ``media``."""
    return in_small_batches(docs).select("doc_id", to_png(F.col("text")).alias("media"))


def media_features(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature: a row for each row of ``docs``.

    Null texts are empty, a null doc_id stays null, other columns are not read, an empty table stays empty. Nothing is shuffled."""
    kept = in_small_batches(docs).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), to_png(F.col("text")).alias("media"))
    return kept.select("doc_id", "n_bytes", png_features(F.col("media")).alias("f")).select("doc_id", "n_bytes", "f.*")
