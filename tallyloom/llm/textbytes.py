"""Whole batches of texts as one NumPy array of UTF-8 bytes, and rolling hashes over it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# An odd base for the rolling hash; its inverse modulo 2^64 exists because it is odd.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
U64 = np.uint64
CHUNK = 1 << 15  # values at a time, so that what is made of them stays in a core's cache


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the offsets of their bounds. A null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not (pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)):
        texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    if texts.null_count:
        texts = texts.fill_null(b"" if pa.types.is_large_binary(texts.type) else "")
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8, bounds[-1] - bounds[0], bounds[0]), bounds - bounds[0]


def by_size(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        at, n = 0, batch.num_rows
        if not n:
            continue
        _, bounds = text_bytes(batch.column(batch.schema.get_field_index(column)))
        while at < n:
            end = int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1
            end = min(max(end, at + 1), n)
            yield batch.slice(at, end - at)
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads hashes over all 64 bits (the finalizer of SplitMix64, by Steele, Lea and Flood)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


# A random 64-bit number for each byte, so that no byte counts as zero.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * U64(BASE))


class Powers:
    """Powers of the base and of its inverse, as far as a batch needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                self.up = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(size, U64(BASE))]))
                self.down = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(size, U64(INVERSE))]))
        return self.up, self.down


POWERS = Powers()


class PrefixHash:
    """Polynomial hashes of any run of a sequence in constant time, modulo 2^64; of ``numbers[values]`` if these are given."""

    def __init__(self, values: np.ndarray, numbers: np.ndarray | None = None) -> None:
        up, self.down = POWERS.upto(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        for a in range(0, len(values), CHUNK):
            some = values[a : a + CHUNK]
            own = self.sums[a + 1 : a + 1 + len(some)]
            np.cumsum((some if numbers is None else numbers[some]) * up[a : a + len(some)], out=own)
            own += self.sums[a]

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def byte_hashes(data: np.ndarray) -> PrefixHash:
    return PrefixHash(data, BYTE_VALUES)
