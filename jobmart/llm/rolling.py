"""Polynomial hashes of substrings of a byte array, modulo 2^64, and bounded steps over texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Bytes that one vectorised step handles; a longer text is cut into overlapping blocks.
STEP_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_TABLES: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    table = _TABLES.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        table[0] = 1
        _TABLES[base] = table = np.multiply.accumulate(table)
    return table[:n]


class Rolling:
    """Hashes of any substrings of ``data`` (uint8); ``seed`` gives independent functions."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        values = mix(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed << 9)) | np.uint64(1)
        self.prefix = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(values[data] * _powers(_BASE, len(data)), out=self.prefix[1:])
        self.back = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.prefix[end] - self.prefix[start]) * self.back[start]
        return mix(raw + (end - start).astype(np.uint64))

    def grams(self, width: int) -> np.ndarray:
        """The hash of every substring of ``width`` bytes, by start."""
        raw = (self.prefix[width:] - self.prefix[:-width]) * self.back[: len(self.prefix) - width]
        return mix(raw + np.uint64(width))


def blocks(texts: list[bytes], overlap: int, limit: int = STEP_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Steps of about ``limit`` bytes: (data, index of text, offset in it, first byte in
    data) of the segments that a step holds. Segments of one long text overlap."""
    data, which, offset, size = [], [], [], 0

    def out():
        lengths = np.array([len(x) for x in data], dtype=np.int64)
        return (
            np.frombuffer(b"".join(data), dtype=np.uint8),
            np.array(which, dtype=np.int64),
            np.array(offset, dtype=np.int64),
            np.append(0, np.cumsum(lengths)),
        )

    for i, text in enumerate(texts):
        at = 0
        while True:
            part = text[at : at + limit]
            if size and size + len(part) > limit:
                yield out()
                data, which, offset, size = [], [], [], 0
            data.append(part)
            which.append(i)
            offset.append(at)
            size += len(part)
            if at + limit >= len(text):
                break
            at += limit - overlap
    if data:
        yield out()
