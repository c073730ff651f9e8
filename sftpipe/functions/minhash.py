"""MinHash signatures and LSH band keys.

Shingles are hashed by their code points with a polynomial modulo 2^31-1, and
each permutation is a multiply-add-shift hash ``((a*h + b) mod 2^64) >> 32``.
The signature of a text needs no other row, so it is one Arrow-batched map with
no exploded shingle table and no shuffle; numpy works in blocks, so memory does
not grow with the length of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from sftpipe.functions.text import SHINGLE_SIZE, once

PRIME = (1 << 31) - 1
BASE = 1_000_003
_BLOCK = 1 << 16


def permutation_coefficients(num_perm: int) -> list[tuple[int, int]]:
    """(a, b) per permutation, derived from md5 so any engine can rebuild them."""

    def word(label: str) -> int:
        return int(hashlib.md5(label.encode()).hexdigest()[:16], 16)

    return [(word(f"a{i}") | 1, word(f"b{i}")) for i in range(num_perm)]


def band_shape(threshold: float, num_perm: int = 64) -> tuple[int, int]:
    """(bands, rows) with the least false-positive plus false-negative area."""
    grid = (np.arange(1000) + 0.5) / 1000
    best, shape = None, (1, num_perm)
    for bands in range(1, num_perm + 1):
        for rows in range(1, num_perm // bands + 1):
            miss = (1 - grid**rows) ** bands
            below = grid < threshold
            area = np.where(below, 1 - miss, miss).mean()
            if best is None or area < best:
                best, shape = area, (bands, rows)
    return shape


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4")


def _window_hashes(code_points: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k``-window; of the whole text when it is shorter."""
    code_points = code_points.astype(np.uint64)
    n = max(len(code_points) - k + 1, 1)
    prime, shift, base = np.uint64(PRIME), np.uint64(31), np.uint64(BASE)
    h = np.zeros(n, np.uint64)
    for j in range(min(k, len(code_points))):
        h *= base
        h += code_points[j : j + n]
        h = (h & prime) + (h >> shift)
    return h % prime


def _batches(lengths: list[int], k: int) -> Iterator[list[int]]:
    """Positions of texts with at least one window, in groups of about one block."""
    group, size = [], 0
    for i, n in enumerate(lengths):
        if k <= n <= _BLOCK:
            if size + n > _BLOCK:
                yield group
                group, size = [], 0
            group.append(i)
            size += n
    if group:
        yield group


def _signer(num_perm: int, k: int) -> Callable[[list[str]], np.ndarray]:
    """Function from texts to a (text, permutation) matrix of minima.

    Short texts are hashed together, a block of characters at a time; the windows
    that cross from one text to the next are masked out.
    """
    coefficients = permutation_coefficients(num_perm)

    def minima(h: np.ndarray, starts: np.ndarray) -> np.ndarray:
        low = np.empty((len(starts), num_perm), np.uint64)
        x = np.empty_like(h)
        for i, (a, b) in enumerate(coefficients):
            np.multiply(h, np.uint64(a), out=x)
            x += np.uint64(b)
            low[:, i] = np.minimum.reduceat(x, starts)
        return low

    def alone(text: str) -> np.ndarray:
        points = _code_points(text)
        low = np.full(num_perm, np.iinfo(np.uint64).max, np.uint64)
        for start in range(0, max(len(points) - k + 1, 1), _BLOCK):
            h = _window_hashes(points[start : start + _BLOCK + k - 1], k)
            np.minimum(low, minima(h, np.array([0]))[0], out=low)
        return low

    def sign(texts: list[str]) -> np.ndarray:
        texts = [t.replace(" ", "") for t in texts]
        lengths = [len(t) for t in texts]
        low = np.empty((len(texts), num_perm), np.uint64)
        for group in _batches(lengths, k):
            sizes = np.array([lengths[i] for i in group])
            h = _window_hashes(_code_points("".join(texts[i] for i in group)), k)
            inside = np.ones(len(h), bool)
            ends = np.cumsum(sizes)[:-1]
            for j in range(1, k):
                inside[ends - j] = False
            windows = sizes - k + 1
            low[group] = minima(h[inside], np.cumsum(windows) - windows)
        for i, n in enumerate(lengths):
            if not k <= n <= _BLOCK:
                low[i] = alone(texts[i])
        return (low >> np.uint64(32)).astype(np.int64)

    return sign


def _present(texts: pd.Series, values: Callable[[list[str]], list]) -> pd.Series:
    """``values`` of the texts that are not null; null for the others."""
    known = iter(values([t for t in texts if isinstance(t, str)]))
    return pd.Series([next(known) if isinstance(t, str) else None for t in texts], dtype=object)


def minhash_signature(c: Column, num_perm: int, k: int = SHINGLE_SIZE) -> Column:
    """``array<bigint>`` of minima over the shingle set of ``c``."""
    sign = _signer(num_perm, k)

    @F.pandas_udf(ArrayType(LongType()))
    def signatures(texts: pd.Series) -> pd.Series:
        return _present(texts, lambda known: list(sign(known)))

    return once(signatures)(c)


def band_keys(c: Column, bands: int, rows: int, k: int = SHINGLE_SIZE) -> Column:
    """``array<binary>``: per band a 16-byte md5 of the band number and its minima.

    Only these keys leave the Python worker; the signature does not.
    """
    sign = _signer(bands * rows, k)

    def key(band: int, minima: list[int]) -> bytes:
        return hashlib.md5(",".join(map(str, [band, *minima])).encode()).digest()

    def keys(texts: list[str]) -> list[list[bytes]]:
        minima = sign(texts).reshape(len(texts), bands, rows).tolist()
        return [[key(band, low) for band, low in enumerate(text)] for text in minima]

    @F.pandas_udf(ArrayType(BinaryType()))
    def all_keys(texts: pd.Series) -> pd.Series:
        return _present(texts, keys)

    return once(all_keys)(c)
