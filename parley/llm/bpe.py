"""Byte-pair encoding with forced boundaries, for a vocabulary with word ends."""

from __future__ import annotations

import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks of text, and words of them, whose ids are remembered at a time, beside those of the texts in hand.
CACHE_CHUNKS = 200_000
#: Characters of text that are encoded together; a longer text is taken alone.
TOGETHER = 1 << 21

# White space of Python's split() that the vocabulary's own pattern takes for ordinary characters.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WHITE = regex.compile(r"\p{White_Space}+")


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies.

    Printable bytes of Latin-1 stand for themselves, the others take the characters from U+0100 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def _together(texts: list[str]) -> Iterator[list[str]]:
    some, size = [], 0
    for t in texts:
        if some and size + len(t) > TOGETHER:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


class PairTable:
    """Ranks of pairs of ids, looked up for many pairs at once in an open hash table."""

    def __init__(self, pairs: list[tuple[int, int]]):
        self.none = len(pairs)
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, self.none, np.int64)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        for rank, (key, at) in enumerate(zip(keys.tolist(), self._home(keys).tolist(), strict=True)):
            while self.keys[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.keys[at], self.ranks[at] = key, rank

    def _home(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, the number of pairs where there is none; -1 is in no pair."""
        keys = np.where((left < 0) | (right < 0), np.int64(-2), left << 32 | right)
        at = self._home(keys)
        out = self.ranks[at]
        look = np.flatnonzero(self.keys[at] != keys)
        while len(look):
            empty = self.keys[at[look]] < 0
            out[look[empty]] = self.none
            look = look[~empty]
            at[look] = (at[look] + 1) & ((1 << self.bits) - 1)
            out[look] = self.ranks[at[look]]
            look = look[self.keys[at[look]] != keys[look]]
        return out


class Encoder:
    """A vocabulary file read for encoding; ``encode`` gives the ids as little-endian 32-bit numbers.

    A chunk between white space is split by the file's pattern into words. Two
    neighbouring byte letters that stand side by side in no token of the
    vocabulary can never be joined, so a word is cut there first; the pieces are
    encoded on their own, by merging, and their ids put in a row.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        letters = byte_letters()
        # A byte inside a word and a byte that ends it are letters of their own: b and b + 256.
        names = [*letters, *(c + self.end for c in letters)]
        number = {c: i for i, c in enumerate(names)}
        self.letter_ids = np.array([self.vocab.get(c, -1) for c in names], np.int64)
        self.inside = np.zeros((512, 512), bool)
        for token in self.vocab:
            ids = [number[c] for c in self._letters(token)]
            self.inside[ids[:-1], ids[1:]] = True
        self.joined = np.array([self.vocab[a + b] for a, b in merges], np.int64)
        self.table = PairTable([(self.vocab[a], self.vocab[b]) for a, b in merges])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(split["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str) -> Encoder:
        with open(path, encoding="utf-8") as f:
            return cls(json.load(f))

    def _letters(self, token: str) -> list[str]:
        """Letters of a token; the word end belongs to the last of them."""
        if self.end and token.endswith(self.end) and token != self.end:
            stem = token[: -len(self.end)]
            return [*stem[:-1], stem[-1] + self.end]
        return list(token)

    def fragments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letters of all words in a row, where fragments begin, and where words begin.

        A word is cut where a letter and the next stand side by side in no token.
        """
        data = [w.encode() for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        letters = np.frombuffer(b"".join(data), np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        letters[ends - 1] += 256
        new_word = np.zeros(len(letters), bool)
        new_word[ends - sizes] = True
        cut = new_word.copy()
        cut[1:] |= ~self.inside[letters[:-1], letters[1:]]
        return letters, cut, new_word

    def merge(self, words: list[str]) -> list[bytes]:
        """Ids of words: in every fragment the pair of least rank is joined, leftmost first, as long as there is one.

        All fragments take a step together. Letters that the vocabulary lacks give nothing.
        """
        if not words:
            return []
        letters, cut, new_word = self.fragments(words)
        symbols, fragment = self.letter_ids[letters], np.cumsum(cut) - 1
        word_of = (np.cumsum(new_word) - 1)[cut]
        none = len(self.joined)
        ranks = np.full(len(symbols), none, np.int64)
        pair = np.flatnonzero(~cut[1:])
        ranks[pair] = self.table(symbols[pair], symbols[pair + 1])
        done = []
        while len(symbols):
            first = np.flatnonzero(np.r_[True, fragment[1:] != fragment[:-1]])
            counts = np.diff(np.r_[first, len(symbols)])
            least = np.minimum.reduceat(ranks, first)
            over = np.repeat(least == none, counts)
            if over.any():
                done.append((fragment[over], symbols[over]))
                keep = ~over
                symbols, fragment, ranks = symbols[keep], fragment[keep], ranks[keep]
                counts, least = counts[least != none], least[least != none]
            if not len(symbols):
                break
            at = np.flatnonzero(ranks == np.repeat(least, counts))
            at = at[np.r_[True, fragment[at[1:]] != fragment[at[:-1]]]]
            symbols[at] = self.joined[least]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, fragment, ranks = symbols[keep], fragment[keep], ranks[keep]
            at -= np.arange(len(at))
            ranks[at] = none
            for left in (at[at > 0] - 1, at[at < len(symbols) - 1]):
                left = left[fragment[left] == fragment[left + 1]]
                ranks[left] = self.table(symbols[left], symbols[left + 1])
        fragments, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(fragments, kind="stable")
        owner, ids = word_of[fragments[order]], ids[order]
        owner, ids = owner[ids >= 0], ids[ids >= 0]
        ends = np.cumsum(np.bincount(owner, minlength=len(words)))
        return [part.astype("<u4").tobytes() for part in np.split(ids, ends[:-1])]

    def _words(self, chunk: str) -> list[str]:
        """Most chunks are letters, with or without one stop; the pattern takes all others apart."""
        if chunk.isalpha():
            return [chunk]
        if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self.word.findall(chunk)

    def _learn(self, chunks: set[str]) -> None:
        """Encode the chunks without white space that are not remembered."""
        new = {c: self._words(c) for c in chunks if c not in self.chunks}
        if len(self.chunks) + len(new) > CACHE_CHUNKS:
            self.chunks.clear()
            self.words.clear()
            new = {c: self._words(c) for c in chunks}
        words = list({w for ws in new.values() for w in ws if w not in self.words})
        self.words.update(zip(words, self.merge(words), strict=True))
        for c, ws in new.items():
            self.chunks[c] = b"".join([self.words[w] for w in ws])

    def normalized(self, text: str) -> str:
        """NFC, then every character in lower case by itself, so that a sigma does not look around."""
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()

    def _parts(self, text: str) -> list[int | list[str]]:
        """Special tokens as their ids, what stands between them as chunks without white space."""
        out: list[int | list[str]] = []
        for i, part in enumerate(self.cut.split(text) if "<" in text else (text,)):
            if i % 2:
                out.append(self.special[part])
                continue
            part = self.normalized(part)
            out.append(list(filter(None, _WHITE.split(part))) if _SEPARATORS.search(part) else part.split())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; special tokens in them get their own ids, nothing is added or cut."""
        out = []
        for some in _together(texts):
            parts = [self._parts(t) for t in some]
            self._learn({c for ps in parts for p in ps if not isinstance(p, int) for c in p})
            get = self.chunks.__getitem__
            for ps in parts:
                ids = (struct.pack("<I", p) if isinstance(p, int) else b"".join(map(get, p)) for p in ps)
                out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        """The tokens with one blank between them: the file names no decoder. Unknown ids give nothing."""
        numbers = memoryview(ids).cast("I") if len(ids) else ()
        get = self.tokens.get
        try:
            return " ".join(map(self.tokens.__getitem__, numbers))
        except KeyError:
            return " ".join(t for t in map(get, numbers) if t is not None)


def encode_texts(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", keep: bool = True) -> DataFrame:
    """Columns key, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, with ``keep``, ``ids`` and ``decoded``.

    ``path`` is a vocabulary file that every executor can open. Null and empty
    texts have no tokens. Each row is encoded and decoded on its own: no shuffle.
    """
    fields = ["n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
    fields += ["ids array<int>", "decoded string"] if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(path)
        for batch in batches:
            at = 0
            for texts in _together([t or "" for t in batch.column(1).to_pylist()]):
                # What a few texts give goes out at once, so a batch of any size takes little memory.
                ids = encoder.encode(texts)
                decoded = [encoder.decode(i) for i in ids]
                columns = [
                    batch.column(0).slice(at, len(texts)),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()),
                ]
                if keep:
                    ends = np.cumsum([0] + [len(i) // 4 for i in ids]).astype(np.int32)
                    values = np.frombuffer(b"".join(ids), "<i4")
                    columns += [pa.ListArray.from_arrays(ends, values), pa.array(decoded, pa.string())]
                at += len(texts)
                yield pa.record_batch(columns, names)

    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if keep else [])]
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, ", ".join([f"key {kind}", *fields])).withColumnRenamed("key", key)
