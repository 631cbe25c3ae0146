"""Fingerprints of texts and pictures, and their distance."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .text import bound, shingles

BITS = 64


def hex64(value: Column) -> Column:
    """A 64-bit number as 16 hex digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def from_hex64(text: Column) -> Column:
    """The signed 64-bit number of 16 hex digits; null where they aren't."""
    low, high = (F.conv(F.substring(text, i, 8), 16, 10).cast("bigint") for i in (9, 1))
    return F.when(text.rlike("^[0-9a-fA-F]{16}$"), F.shiftleft(high, 32).bitwiseOR(low))


def simhash_expression(text: Column, bits: int = BITS) -> Column:
    """SimHash in built-in functions alone: a bit is set where more than half of the shingles' hashes have it."""
    zero, unit = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")

    def vote(hashes: Column) -> Column:
        one = lambda i: F.size(F.filter(hashes, lambda h: F.call_function("shiftright", h, i).bitwiseAND(unit) == 1)) * 2 > F.size(hashes)
        return F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), zero, lambda acc, i: acc.bitwiseOR(F.when(one(i), F.call_function("shiftleft", unit, i)).otherwise(zero)))

    return bound(F.transform(shingles(text), lambda s: F.conv(F.substring(F.md5(s), 17, 16), 16, -10).cast("bigint")), vote)


_weights = (np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)).astype(np.uint64)


def simhash_of(parts: list[str], bits: int = BITS) -> int:
    """Of ready shingles, as a signed number."""
    if not parts:
        return 0
    digests = np.frombuffer(b"".join(hashlib.md5(p.encode("utf-8", "replace")).digest()[8:] for p in parts), np.uint8).reshape(len(parts), 8)
    votes = np.unpackbits(digests, axis=1).sum(0, dtype=np.int64) * 2 > len(parts)
    value = int(_weights[votes].sum(dtype=np.uint64)) & ((1 << bits) - 1)
    return value - (1 << 64) if value >> 63 else value


@F.pandas_udf(LongType())
def _simhash_udf(text: pd.Series) -> pd.Series:
    """Digests of all rows' shingles laid end to end; the votes of a row are sums over its stretch."""
    k, digests, sizes = 3, [], []
    for value in text:
        tokens = (value or "").lower().split()
        parts = tokens if len(tokens) < k else map(" ".join, zip(*(tokens[i:] for i in range(k))))
        before = len(digests)
        digests += [hashlib.md5(p.encode("utf-8", "replace")).digest()[8:] for p in parts]
        sizes.append(len(digests) - before)
    out, size = np.zeros(len(text), np.uint64), np.array(sizes, np.int64)
    if digests:
        full = np.flatnonzero(size)
        bits = np.unpackbits(np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 8), axis=1)
        votes = np.add.reduceat(bits, (np.cumsum(size) - size)[full], axis=0, dtype=np.int32) * 2 > size[full, None]
        out[full] = np.packbits(votes, axis=1).view(">u8").ravel()
    return pd.Series(out.view(np.int64))


def simhash(text: Column) -> Column:
    """SimHash over word shingles, votes in numpy; 0 for null and empty texts. The same values as simhash_expression."""
    return _simhash_udf(text)


@lru_cache(maxsize=8)
def _lanczos(size: int, out: int) -> np.ndarray:
    """Weights of a Lanczos-3 reduction from `size` to `out` samples, support widened by the scale."""
    scale = max(size / out, 1.0)
    centre = (np.arange(out) + 0.5) * size / out - 0.5
    x = (np.arange(size)[None, :] - centre[:, None]) / scale
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(1, keepdims=True)


@lru_cache(maxsize=8)
def _cosines(n: int) -> np.ndarray:
    k = np.arange(n)
    return 2 * np.cos(np.pi * k[:, None] * (2 * k[None, :] + 1) / (2 * n))


def _reduce(gray: np.ndarray, height: int, width: int) -> np.ndarray:
    out = _lanczos(gray.shape[0], height) @ gray @ _lanczos(gray.shape[1], width).T
    return np.clip(np.rint(out), 0, 255)


def _packed(bits: np.ndarray) -> int:
    value = int("".join("1" if b else "0" for b in bits.ravel()), 2)
    return value - (1 << 64) if value >> 63 else value


def phash_of(gray: np.ndarray, size: int = 8, factor: int = 4) -> int:
    """DCT hash: which of the size x size lowest frequencies exceed their median, row by row, high bit first."""
    n = size * factor
    c = _cosines(n)
    low = (c @ _reduce(gray.astype(float), n, n) @ c.T)[:size, :size]
    return _packed(low > np.median(low))


def dhash_of(gray: np.ndarray, size: int = 8) -> int:
    """Difference hash: where a pixel is lighter than its left neighbour."""
    small = _reduce(gray.astype(float), size, size + 1)
    return _packed(small[:, 1:] > small[:, :-1])


def _gray(height: int, width: int, channels: int, data: bytes) -> np.ndarray | None:
    """Grey levels of Spark's image rows (BGR bytes)."""
    if height is None or height <= 0 or width <= 0 or not data:
        return None
    pixels = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return pixels[:, :, 0]
    b, g, r = (pixels[:, :, i].astype(np.int64) for i in range(3))
    return (r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16


def image_hash(image: Column, method: str = "phash") -> Column:
    """phash or dhash of a column of Spark's image source; null where it could not be decoded."""
    if method not in ("phash", "dhash"):
        raise ValueError(f"unknown image method: {method}")
    of = phash_of if method == "phash" else dhash_of

    @F.pandas_udf(LongType())
    def run(height: pd.Series, width: pd.Series, channels: pd.Series, data: pd.Series) -> pd.Series:
        grays = (_gray(*row) for row in zip(height, width, channels, data))
        return pd.Series([None if g is None else of(g) for g in grays], dtype="Int64")

    return run(image["height"], image["width"], image["nChannels"], image["data"])
