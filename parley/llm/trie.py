"""Self-join of fingerprints over a binary trie: which of them differ in a few bits."""

from __future__ import annotations

import numpy as np

#: Node pairs that are held at a time.
FRONTIER = 1 << 18


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values)


def flatten(label: np.ndarray) -> np.ndarray:
    """Follow labels to their roots; a label is an index not above its own."""
    while True:
        further = label[label]
        if np.array_equal(further, label):
            return label
        label = further


def unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join the components of each left with those of its right; labels become the lowest index."""
    while len(left):
        a, b = label[left], label[right]
        differ = a != b
        left, right, a, b = left[differ], right[differ], a[differ], b[differ]
        if len(left):
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            label = flatten(label)
    return label


class TrieJoin:
    """Trie over sorted fingerprints of several buckets; a node is a range of them.

    Pairs of nodes go down together from bit 63: both take the same bit, or the
    bits differ and one more is counted. A pair is given up once it has more
    than ``errors`` differing bits, or once all its leaves are known to be
    connected. A pair of two leaves is decided by their bits at once.
    """

    def __init__(self, bucket: np.ndarray, values: np.ndarray, errors: int):
        self.values, self.errors = values, errors
        self.label = np.arange(len(values))
        near = np.flatnonzero((bucket[1:] == bucket[:-1]) & (popcount(values[1:] ^ values[:-1]) <= errors))
        self.label = unite(self.label, near, near + 1)
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(values) else np.zeros(1, int)
        low, high = edges[:-1], edges[1:]
        several = high - low > 1
        self.roots = (low[several], high[several])

    def components(self) -> np.ndarray:
        """For each fingerprint the index of the lowest one of its bucket that links lead to."""
        low, high = self.roots
        stack = []
        for at in range(0, len(low), FRONTIER):
            part = slice(at, at + FRONTIER)
            stack.append((63, (low[part], high[part], low[part], high[part], np.zeros(len(low[part]), np.uint8))))
        while stack:
            bit, pairs = stack.pop()
            pairs = self._open(*pairs)
            if not len(pairs[0]):
                continue
            below = self._down(bit, *pairs)
            for at in range(0, len(below[0]), FRONTIER):
                stack.append((bit - 1, tuple(x[at : at + FRONTIER] for x in below)))
        return self.label

    def _open(self, low, high, low2, high2, errors):
        """Decide pairs of leaves; leave the pairs that may still hold new links."""
        single = (high - low == 1) & (high2 - low2 == 1)
        a, b = low[single], low2[single]
        linked = (a != b) & (popcount(self.values[a] ^ self.values[b]) <= self.errors)
        self.label = unite(self.label, a[linked], b[linked])
        changes = np.r_[0, np.cumsum(self.label[1:] != self.label[:-1])]
        one = (changes[high - 1] == changes[low]) & (changes[high2 - 1] == changes[low2])
        done = one & (self.label[low] == self.label[low2])
        left = ~single & ~done
        return low[left], high[left], low2[left], high2[left], errors[left]

    def _down(self, bit, low, high, low2, high2, errors):
        ones = np.r_[0, np.cumsum((self.values >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)]
        split = high - (ones[high] - ones[low])
        split2 = high2 - (ones[high2] - ones[low2])
        own = low == low2
        cross = ~own
        parts = [
            (low, split, low2, split2, errors, None),
            (split, high, split2, high2, errors, None),
            (low, split, split2, high2, errors + 1, None),
            (split[cross], high[cross], low2[cross], split2[cross], errors[cross] + 1, None),
        ]
        out = []
        for a, b, c, d, e, _ in parts:
            keep = (b > a) & (d > c) & (e <= self.errors) & ~((a == c) & (b - a == 1))
            out.append((a[keep], b[keep], c[keep], d[keep], e[keep]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))
