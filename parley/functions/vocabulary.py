"""Tokens of a given vocabulary: greedy longest match over a double-array trie.

The trie is walked for all places of all texts of a batch side by side, one byte
a step, so a batch takes as many steps as the longest token has bytes. Which
matches follow each other from a text's start is then found by doubling jumps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text walked at a time; a longer text is taken alone.
_SLICE = 1 << 20
#: Places of the trie that are tried together for a state's children.
_WINDOW = 512


def _fitting(check: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
    """From which of the next places on all children of a state find gaps; beyond the end all do."""
    fits = np.ones(_WINDOW, bool)
    for code in codes:
        taken = check[at + code : at + code + _WINDOW] >= 0
        fits[: len(taken)] &= ~taken
    return fits


@dataclass
class Trie:
    """State s goes on byte c to ``t = base[s] + c + 1`` if ``check[t] == s``; ``ids[t]`` is the token that ends there, or -1."""

    base: np.ndarray
    check: np.ndarray
    ids: np.ndarray

    @classmethod
    def build(cls, tokens: dict[bytes, int]) -> Trie:
        """States are laid out breadth first, each one's children in the first gap that takes them all."""
        size = 8 * _WINDOW
        base, check, ids = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        check[0] = 0
        names = sorted(t for t in tokens if t)
        level: list[tuple[int, int, int, int]] = [(0, 0, len(names), 0)]  # state, first and last name, depth
        # There is no gap before ``free``, which a place below 257 could not tell; several children are tried from ``spot`` on.
        free = spot = 257
        while level:
            below: list[tuple[int, int, int, int]] = []
            for state, start, stop, depth in level:
                if start < stop and len(names[start]) == depth:
                    ids[state] = tokens[names[start]]
                    start += 1
                children: list[tuple[int, int, int]] = []
                while start < stop:
                    byte, first = names[start][depth], start
                    while start < stop and names[start][depth] == byte:
                        start += 1
                    children.append((byte + 1, first, start))
                if not children:
                    continue
                codes = np.array([c for c, _, _ in children])
                if len(codes) == 1:
                    while check[free] >= 0:
                        free += 1
                    at = free - int(codes[0])
                else:
                    at = spot = max(spot, free)
                    while not (fits := _fitting(check, at, codes)).any():
                        at += _WINDOW
                    at = spot = at + int(np.argmax(fits))
                    while check[free] >= 0:
                        free += 1
                if max(at, free) + 4 * _WINDOW >= size:
                    base, check, ids = (np.r_[x, np.full(size, fill, np.int32)] for x, fill in ((base, 0), (check, -1), (ids, -1)))
                    size *= 2
                base[state] = at
                check[at + codes] = state
                below += [(at + c, first, last, depth + 1) for c, first, last in children]
            level = below
        return cls(base, check, ids)

    def longest(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each byte, the length and the id of the longest token that begins there and ends by ``ends``; 0 and -1 if none does."""
        size, token = np.zeros(len(data), np.int32), np.full(len(data), -1, np.int32)
        at, state, step = np.flatnonzero((data & 0xC0) != 0x80), None, 0
        state = np.zeros(len(at), np.int32)
        while len(at):
            code = data[at + step].astype(np.int32) + 1
            after = self.base[state] + code
            on = self.check[after] == state
            at, state = at[on], after[on]
            step += 1
            found = self.ids[state] >= 0
            size[at[found]], token[at[found]] = step, self.ids[state[found]]
            inside = at + step < ends[at]
            at, state = at[inside], state[inside]
        return size, token


@dataclass
class Vocabulary:
    """A tokenizer for ``token_count`` and ``token_ids``: ``unknown`` stands for each character that begins no token."""

    trie: Trie
    unknown: int

    @classmethod
    def of(cls, table: DataFrame, token: str = "token", number: str = "id", unknown: int = -1, most: int = 1 << 20) -> Vocabulary:
        """From a table of tokens and ids, of ``most`` rows at most; null and empty tokens are none, of a repeated one the least id counts."""
        known = table.where(F.col(number).isNotNull() & (F.col(token) != "")).groupBy(token).agg(F.min(number).alias(number))
        rows = known.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"the vocabulary has more than {most} tokens")
        return cls(Trie.build({r[0].encode(): int(r[1]) for r in rows}), unknown)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text; null gives none."""
        values = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        raw = values.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        parts, counts = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        row = 0
        while row < len(values):
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _SLICE, "right")) - 1)
            some, at = data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
            ids, n = self._slice(some, at)
            parts.append(ids)
            counts.append(n)
            row = stop
        lists = np.r_[0, np.cumsum(np.concatenate(counts))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(lists), pa.array(np.concatenate(parts), pa.int32()))

    def _slice(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        size, token = self.trie.longest(data, np.repeat(at[1:], np.diff(at)))
        first = data.astype(np.int32)
        character = 1 + (first >= 0xC0) + (first >= 0xE0) + (first >= 0xF0)
        jump = np.r_[np.minimum(np.arange(n) + np.where(token >= 0, size, character), n), n].astype(np.int64)
        reached = np.zeros(n + 1, bool)
        reached[at] = True
        seen = 0
        while (now := int(reached.sum())) > seen:
            seen = now
            reached[jump[np.flatnonzero(reached)]] = True
            jump = jump[jump]
        places = np.flatnonzero(reached[:n])
        return np.where(token[places] >= 0, token[places], self.unknown), np.diff(np.searchsorted(places, at))


def encoded(vocabulary: Vocabulary):
    """An Arrow function of texts to lists of ids."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield vocabulary.encode(batch)

    return run


def counted(vocabulary: Vocabulary):
    """An Arrow function of texts to numbers of ids."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            ids = vocabulary.encode(batch)
            yield pa.array(np.diff(ids.offsets.to_numpy()), pa.int64())

    return run
