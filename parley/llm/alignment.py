"""Alignment of two tokenizers: links between tokens that share bytes, by sparse matrix products over the bytes."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.arrays import flat, spans
from parley.llm.chunks import entries, look_up, numbered, pack, spread, sums, unpack
from parley.session import materialize

#: Bytes of joined fragments that a tokenizer is given at a time.
ENCODE_BYTES = 1 << 18
#: Bytes of text whose fragments have a dictionary in common; a longer text has its own.
FRAGMENT_BYTES = 4 << 20
#: Non-zero products that a matrix product holds at a time, beside the rest of one row.
PRODUCT_ENTRIES = 1 << 20


@dataclass
class Matrix:
    """A sparse matrix by rows: the entries of row i are ``at[i]`` to ``at[i + 1]``, each with a column and a value."""

    at: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    width: int

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.at) - 1), np.diff(self.at))

    def transposed(self) -> Matrix:
        order = np.argsort(self.columns, kind="stable")
        at = np.r_[0, np.cumsum(np.bincount(self.columns, minlength=self.width))]
        return Matrix(at, self.rows()[order], self.values[order], len(self.at) - 1)


def incidence(rows_at: np.ndarray, columns: np.ndarray, width: int) -> Matrix:
    """A matrix of ones."""
    return Matrix(rows_at, columns, np.ones(len(columns), np.int64), width)


def token_bytes(ends: np.ndarray, size: int) -> Matrix:
    """Tokens by bytes: row i has the bytes of token i, which end before ``ends[i]``; tokens lie side by side."""
    return incidence(np.r_[0, ends], np.arange(size), size)


def product_sizes(left: Matrix, right: Matrix) -> np.ndarray:
    """Entries that each row of ``left`` meets in ``right``: the first pass of the product, which makes none of them."""
    return sums(np.diff(right.at)[left.columns], left.at)


def row_products(left: Matrix, right: Matrix, limit: int = PRODUCT_ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, columns and values of the product, some rows at a time.

    Row by row: for each entry (i, k) of ``left`` the row k of ``right`` is added
    to row i of the result; equal columns of a row are summed. Rows are taken together up to ``limit`` entries.
    """
    met = np.cumsum(product_sizes(left, right))
    start = 0
    while start < len(met):
        before = met[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(met, before + limit, "right")))
        some = slice(left.at[start], left.at[stop])
        k = left.columns[some]
        n = right.at[k + 1] - right.at[k]
        place = np.repeat(right.at[k], n) + spans(n)
        row = np.repeat(np.repeat(np.arange(start, stop), np.diff(left.at[start : stop + 1])), n)
        column, value = right.columns[place], np.repeat(left.values[some], n) * right.values[place]
        key = row * right.width + column
        if len(key) and np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, row, column, value = key[order], row[order], column[order], value[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        if len(first):
            yield row[first], column[first], np.add.reduceat(value, first)
        start = stop


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones stand for themselves, others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(others)}}


class Tokens:
    """The bytes of every token of a vocabulary, side by side."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.at = np.r_[0, np.cumsum(self.sizes)]
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.sizes[ids]
        return self.data[np.repeat(self.at[ids], n) + spans(n)]


class ByteLevel:
    """Tokenizer A: a byte-level BPE file of the tokenizers library; special tokens in texts are plain text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            stated = json.load(f)
        letters = byte_letters()
        ids = {**stated["model"]["vocab"], **{t["content"]: t["id"] for t in stated["added_tokens"]}}
        pieces = [b""] * (1 + max(ids.values()))
        for piece, i in ids.items():
            pieces[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
        self.tokens = Tokens(pieces)

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, add_special_tokens=False).ids, np.int64)


class Pieces:
    """Tokenizer B: a sentencepiece file with byte fallback that puts a space before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        raw = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.tokens = Tokens(raw)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text that begins with a space, which the model adds itself."""
        return np.array(self.model.encode(text[1:], num_threads=1), np.int64)


@cache
def _loaded(kind: type, path: str):
    return kind(path)


def _visible(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the sign before each of ``ends`` is no white space for any tokenizer; in doubt, it is.

    No token of either tokenizer has a space after such a sign, and what follows that space is read alike
    whatever is before it: there, texts can be cut and fragments joined.
    """
    padded = np.r_[np.zeros(3, np.uint8), data]
    a, b, c = padded[ends + 2], padded[ends + 1], padded[ends]
    # The last bytes of white space beyond ASCII, and of signs that some count as such.
    wide = (b == 0xC2) | ((c == 0xE1) & ((b == 0x9A) | (b == 0xA0))) | ((c == 0xE2) & ((b == 0x80) | (b == 0x81)))
    wide |= ((c == 0xE3) & (b == 0x80)) | ((c == 0xEF) & (b == 0xBB))
    return ((a > 0x20) & (a < 0x7F)) | ((a >= 0x80) & ~wide)


def _cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where fragments begin: at the starts of the texts, none empty, and at spaces that visible signs surround."""
    cut = np.zeros(len(data) + 1, bool)
    space = np.flatnonzero(data == 0x20)
    cut[space[_visible(data, space)]] = True
    cut[offsets[1:] - 1] = False  # B takes a space alone for nothing
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut[:-1])


def _encoded(tokenizer, fragments: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all fragments, their offsets, and whether the ids' bytes are those of the fragment; else it has none.

    Fragments whose last sign is visible are encoded joined: the next one's space parts them again.
    """
    data, at = flat(fragments)
    n = len(fragments)
    closed = _visible(data, at[1:])
    found: list[tuple[np.ndarray, np.ndarray]] = []  # fragments, ids of each fragment in a row
    counts, right = np.zeros(n, np.int64), np.zeros(n, bool)

    def take(some: np.ndarray) -> None:
        n_bytes = at[some + 1] - at[some]
        whole = data[np.repeat(at[some], n_bytes) + spans(n_bytes)].tobytes()
        ids = tokenizer.encode(whole.decode())
        same = int(tokenizer.tokens.sizes[ids].sum()) == len(whole) and tokenizer.tokens.joined(ids).tobytes() == whole
        if same:
            ends = np.cumsum(tokenizer.tokens.sizes[ids])
            bounds = np.cumsum(n_bytes)
            upto = np.searchsorted(ends, bounds, "right")
            if len(some) == 1 or np.array_equal(ends[upto - 1], bounds):
                counts[some], right[some] = np.diff(np.r_[0, upto]), True
                found.append((some, ids))
                return
        if len(some) > 1:  # one of them is not what its ids say
            for i in some:
                take(np.array([i]))

    joined = np.flatnonzero(closed)
    size = np.cumsum(at[joined + 1] - at[joined])
    start = 0
    while start < len(joined):
        stop = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + ENCODE_BYTES, "right")))
        take(joined[start:stop])
        start = stop
    for i in np.flatnonzero(~closed):
        take(np.array([i]))
    offsets = np.r_[0, np.cumsum(counts)]
    out = np.zeros(offsets[-1], np.int64)
    for some, ids in found:
        out[np.repeat(offsets[some], counts[some]) + spans(counts[some])] = ids
    return out, offsets, right


def _written(ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Decimal numbers, each with a sign after it, side by side, and where each begins."""
    tens = 10 ** np.arange(1, 10)
    digits = 1 + np.searchsorted(tens, ids, "right")
    at = np.r_[0, np.cumsum(digits + 1)]
    out = np.empty(at[-1], np.uint8)
    rest = ids.copy()
    for k in range(int(digits.max()) if len(digits) else 0):
        some = digits > k
        out[(at[:-1] + digits - 1 - k)[some]] = 48 + rest[some] % 10
        rest //= 10
    out[at[1:] - 1] = after
    return out, at


@dataclass
class Aligned:
    """What both tokenizers make of some fragments: sizes by fragment, links by fragment, and the groups written out."""

    right: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_group_links: np.ndarray
    link_at: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    shared: np.ndarray
    groups: list[bytes]


def align(fragments: pa.Array, a: ByteLevel, b: Pieces) -> Aligned:
    """Align fragments, each of which begins with a space; those that either tokenizer changes have no tokens.

    Over the bytes of all fragments: links are the entries of (A tokens x bytes) (B tokens x bytes)^T, their values the
    shared bytes; the pairs of a group those of (A tokens x groups) (B tokens x groups)^T, of which only the sizes are needed.
    """
    ids_a, at_a, right_a = _encoded(a, fragments)
    ids_b, at_b, right_b = _encoded(b, fragments)
    right = right_a & right_b
    ids_a, ids_b = ids_a[np.repeat(right, np.diff(at_a))], ids_b[np.repeat(right, np.diff(at_b))]
    n_a, n_b = np.diff(at_a) * right, np.diff(at_b) * right
    at_a, at_b = np.r_[0, np.cumsum(n_a)], np.r_[0, np.cumsum(n_b)]
    ends_a, ends_b = np.cumsum(a.tokens.sizes[ids_a]), np.cumsum(b.tokens.sizes[ids_b])
    size = int(ends_a[-1]) if len(ends_a) else 0
    # Groups end where tokens of both end.
    group_ends = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
    group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
    fragment_ends = np.r_[0, ends_a][at_a]
    n_groups = np.diff(np.searchsorted(group_ends, fragment_ends, "right"))
    of_a = incidence(np.arange(len(ids_a) + 1), group_a, len(group_ends))
    of_b = incidence(np.arange(len(ids_b) + 1), group_b, len(group_ends))
    n_group_links = sums(product_sizes(of_a, of_b.transposed()), at_a)
    parts = list(row_products(token_bytes(ends_a, size), token_bytes(ends_b, size).transposed()))
    row, column, shared = (np.concatenate([np.zeros(0, np.int64), *p]) for p in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
    link_at = np.searchsorted(row, at_a)
    # In writing, the A tokens of a group come before its B tokens.
    place_a = np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)
    place_b = np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")
    last_a, last_b = np.r_[np.diff(group_a) > 0, True][: len(ids_a)], np.r_[np.diff(group_b) > 0, True][: len(ids_b)]
    ids, after = np.empty(len(ids_a) + len(ids_b), np.int64), np.empty(len(ids_a) + len(ids_b), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    after[place_a] = np.where(last_a, ord("|"), ord(","))
    after[place_b] = np.where(last_b, ord(";"), ord(","))
    text, at = _written(ids, after)
    bounds, whole = at[at_a + at_b].tolist(), text.tobytes()
    groups = [whole[x : y - 1] if y > x else b"" for x, y in zip(bounds, bounds[1:], strict=False)]
    return Aligned(right, n_a, n_b, n_groups, n_group_links, link_at, ids_a[row], ids_b[column], shared, groups)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_group_links"]


def _chunked(path_a: str, path_b: str, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _loaded(ByteLevel, path_a), _loaded(Pieces, path_b)
        for number, batch in numbered(batches, 1, FRAGMENT_BYTES):
            raw, raw_at = flat(batch.column(1))
            full = np.diff(raw_at) > 0
            # A space before each text that is not empty.
            offsets = np.r_[0, np.cumsum(np.diff(raw_at) + full)]
            data = np.full(offsets[-1], 0x20, np.uint8)
            given = np.ones(len(data), bool)
            given[offsets[:-1][full]] = False
            data[given] = raw
            begins = _cuts(data, np.r_[offsets[:-1][full], len(data)])
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.r_[begins, len(data)].astype(np.int64)), pa.py_buffer(data)])
            coded = words.dictionary_encode()
            which = coded.indices.to_numpy().astype(np.int64)
            found = align(coded.dictionary, a, b)
            at = np.searchsorted(begins, offsets)
            ok = full & (sums((~found.right[which]).astype(np.int64), at) == 0)
            which = which[np.repeat(ok, np.diff(at))]
            at = np.r_[0, np.cumsum(np.diff(at) * ok)]
            n_links = np.diff(found.link_at)
            by_text = [sums(x[which], at) for x in (found.n_a, found.n_b, found.n_groups, n_links, found.n_group_links)]
            listed, place = which.tolist(), at.tolist()
            digests = [
                hashlib.sha256(b";".join([found.groups[i] for i in listed[x:y]])).hexdigest() if y > x else ""
                for x, y in zip(place, place[1:], strict=False)
            ]
            width = len(b.tokens.sizes)
            pairs, pair = np.unique(found.link_a * width + found.link_b, return_inverse=True)
            times = np.bincount(which, minlength=len(found.groups))
            n = np.zeros(len(pairs), np.int64)
            np.add.at(n, pair, np.repeat(times, n_links))
            row = [
                pa.array([number], pa.int64()),
                pa.array([batch.column(0)], pa.list_(batch.column(0).type)),
                *(pa.array([x], pa.list_(pa.int64())) for x in by_text),
                pa.array([digests], pa.list_(pa.string())),
                *(pa.array([pack(x)], pa.binary()) for x in (at, which, found.link_at, pair)),
                pa.array([pairs // width], pa.list_(pa.int32())),
                pa.array([pairs % width], pa.list_(pa.int32())),
                pa.array([n], pa.list_(pa.int64())),
            ]
            yield pa.record_batch(row, ["chunk", "keys", *_COUNTS, "digests", "at", "which", "link_at", "pair", "a", "b", "n"])

    counts = ", ".join(f"{c} array<long>" for c in _COUNTS)
    schema = f"chunk long, keys array<{kind}>, {counts}, digests array<string>, at binary, which binary, link_at binary, pair binary, a array<int>, b array<int>, n array<long>"
    return run, schema


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each chunk, with the corpus-wide counts of their links."""
    for batch in batches:
        c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for r in range(batch.num_rows):
            at, which, link_at, pair = (unpack(c[x][r].as_py()) for x in ("at", "which", "link_at", "pair"))
            pairs = int(c["pairs"][r].as_py())
            count, best = (spread(c["found"], r, pairs, x, np.int64) for x in ("count", "best"))
            by_text = [sums(sums(x[pair], link_at)[which], at) for x in (best, count)]
            columns = [c["keys"][r].values, *(c[x][r].values for x in _COUNTS), *map(pa.array, by_text), c["digests"][r].values]
            yield pa.record_batch(columns, ["key", *_COUNTS, "n_best", "count_sum", "groups_sha256"])


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Columns ``a``, ``b``, ``count``: in how many links two ids are linked, and ``best``: 1 where no other ``a`` of ``b`` has more."""
    counts = entries(chunks, ["a", "b", "n"]).groupBy("a", "b").agg(F.sum("n").alias("count")).where("count > 0")
    counts = materialize(counts, "pair-counts")
    most = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("most")))  # a row for each id of B at most
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).cast("long").alias("best"))


def align_texts(df: DataFrame, path_a: str, path_b: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each row of ``df``: how the tokens of its whole text by the files ``path_a`` and ``path_b`` are linked.

    Columns key, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_group_links`` (pairs in the same group), ``n_best``,
    ``count_sum`` and ``groups_sha256``. Null and empty texts, and texts that a tokenizer changes, have zeros and ''.
    Rows with equal or null keys each keep their own row; other columns of ``df`` are not looked at.

    Each distinct fragment of a chunk is encoded and aligned once. The links' counts come back by chunk: what is
    shuffled are the distinct id pairs of a chunk and fragment numbers, never texts or links.
    """
    kind = df.schema[key].dataType.simpleString()
    run, schema = _chunked(path_a, path_b, kind)
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    chunks = materialize(rows.mapInArrow(run, schema), "alignments")
    known = pair_counts(chunks)
    ready = look_up(chunks.withColumn("pairs", F.size("a")), ["a", "b"], known, ["count", "best"]).drop("a", "b", "n")
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    out = ready.mapInArrow(_summed, f"key {kind}, {counts}, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("key", key)
