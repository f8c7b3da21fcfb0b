"""Chunks: runs of documents in one row, whose distinct keys are looked up in a table of any size.

A step that needs a number for every token (its count in the whole corpus, say)
would shuffle all tokens. Here a task packs documents into chunks of bounded
bytes, each with a dictionary of its distinct keys; only the dictionaries are
joined with the table, so a key that is in every text is joined once a chunk.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.arrays import slices

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20


def numbered(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of a task in chunks by the bytes of column ``text``, each with a number no other chunk has."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for start, stop in slices(batch.column(text), limit):
            yield number, batch.slice(start, stop - start)
            number += 1
            give_back()


def give_back() -> None:
    """Hand freed memory back to the machine: a Python worker goes on to later stages with what it once had."""
    pa.default_memory_pool().release_unused()
    getattr(ctypes.CDLL(None), "malloc_trim", int)(0)  # not every C library has it


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0: a byte that says how wide they are, then the low bytes of all, the next bytes of all ...

    High bytes are mostly zeros and side by side, so the bytes compress well.
    """
    most = int(values.max()) if len(values) else 0
    width = next(w for w in range(1, 9) if most < 1 << 8 * w)
    wide = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    return bytes([width]) + wide[:, :width].T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    narrow = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    wide = np.zeros((narrow.shape[1], 8), np.uint8)
    wide[:, : data[0]] = narrow.T
    return wide.reshape(-1).view("<i8")


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of the values between each two offsets; nothing between gives 0."""
    running = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]


def entries(chunks: DataFrame, lists: list[str]) -> DataFrame:
    """A row for each place of the lists of each chunk: ``chunk``, ``at`` and the values there."""
    zipped = F.posexplode(F.arrays_zip(*lists)).alias("at", "e")
    return chunks.select("chunk", zipped).select("chunk", "at", *(F.col(f"e.{c}").alias(c) for c in lists))


def look_up(chunks: DataFrame, keys: list[str], table: DataFrame, values: list[str]) -> DataFrame:
    """``chunks`` with ``found``: places in the lists ``keys`` and the ``values`` of the row of ``table`` with those keys.

    ``table`` has one row for each combination of keys. Each chunk sends a key
    once, so no key has more rows than there are chunks, and what comes back
    to a chunk is bounded by its own bytes.
    """
    found = entries(chunks, keys).join(table.select(*keys, *values), keys)
    home = found.groupBy("chunk").agg(F.collect_list(F.struct("at", *values)).alias("found"))
    return chunks.join(home, "chunk", "left")


def spread(found: pa.ListArray, row: int, n: int, value: str, kind: type) -> np.ndarray:
    """What ``look_up`` found for a chunk of ``n`` keys, by place; 0 where the table has no row."""
    out = np.zeros(n, kind)
    if found[row].is_valid:
        rows = found[row].values
        out[rows.field("at").to_numpy()] = rows.field(value).fill_null(0).to_numpy(zero_copy_only=False)
    return out
