"""Array helpers for work on whole Arrow batches of texts."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import SparkSession

#: Bytes of text that numpy steps hold at a time; a single longer text is taken alone.
SLICE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_BASE = 0x100000001B3
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class Shipped:
    """A value that tasks get by broadcast, its classes with it, so that executors need no copy of the package.

    A broadcast names classes by their module; packed by value beforehand it does not. Each task unpacks it once.
    """

    def __init__(self, spark: SparkSession, value: Any) -> None:
        self._packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._found: list[Any] = []

    @property
    def value(self) -> Any:
        if not self._found:
            self._found.append(pickle.loads(self._packed.value))
        return self._found[0]

    def drop(self) -> None:
        self._packed.unpersist()


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null gives empty bytes."""
    return [t or b"" for t in texts.cast(pa.large_binary()).to_pylist()]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes together, of one row at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield start, stop
        start = stop


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the offsets of the texts in them; null counts as empty."""
    values = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def _table(inside: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(inside)] = True
    return out


#: The bytes of ASCII white space.
SPACES = _table(b" \t\n\r\x0b\x0c")


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words between white space; no word crosses a text's end."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SPACES[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = offsets[:-1][np.diff(offsets) > 0]
    starts[cut] |= inside[1:-1][cut]
    cut = cut[cut > 0] - 1
    ends[cut] |= inside[1:-1][cut]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


class SpanHash:
    """Hashes of any spans of some bytes, from running sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        rising = powers(len(data) + 1, _BASE)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * rising[:-1], out=self.sums[1:])
        self.falling = powers(len(data) + 1, _BASE_INVERSE)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.falling[starts])


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(_ODD)
    return values ^ (values >> np.uint64(32))


def spans(counts: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each count n, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
