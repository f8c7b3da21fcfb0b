"""Benchmark decontamination: latent semantic search for passages near an item, then checks word by word."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.arrays import Shipped, SpanHash, flat, slices, words
from parley.session import materialize

#: A passage is two neighbouring blocks of so many words; every block begins one.
BLOCK = 16
#: Words are hashed to so many bits for their weights.
BITS = 18
#: Dimensions of the latent space, more of them while it is found, and rounds of power iteration.
RANK, EXTRA, ROUNDS = 240, 16, 2
#: Weight of the items beside the documents where the space is fitted.
ITEM_WEIGHT = 8.0
#: Cells that a task has for sums of pairs of terms, and the parts of one that they are summed in: no passage adds more than one
#: to a sum, so that sums of 2**35 passages are whole numbers of 64 bits.
CELLS, PARTS = 1 << 24, 1 << 28
#: Least cosine of a candidate; least share of an item's words in a common subsequence, and of its answer's words.
LEAST_COSINE, LEAST_COMMON, LEAST_ANSWER = 0.35, 0.6, 0.5
#: Passages of items that share a space, fewer than its dimensions; and spaces that are searched in one pass.
PASSAGES, SPACES = 200, 8

_ANSWER = re.compile(r"(?is)\banswer\s*:\s*(.+)$")
# Signs at the edges of a word that do not count.
_EDGES = np.zeros(256, bool)
_EDGES[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, in lower case without signs at the edges, and where each text's words begin."""
    data, offsets = flat(pc.utf8_lower(texts))
    begins, ends = words(data, offsets)
    sizes = np.searchsorted(begins, offsets)
    left, right = np.arange(len(begins)), np.arange(len(begins))
    while len(left) or len(right):
        left = left[(ends[left] - begins[left] > 1) & _EDGES[data[begins[left]]]]
        begins[left] += 1
        right = right[(ends[right] - begins[right] > 1) & _EDGES[data[ends[right] - 1]]]
        ends[right] -= 1
    return SpanHash(data)(begins, ends), sizes


def terms(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Blocks:
    """The blocks of some texts: a row of ``BLOCK`` terms each, every term once (-1 for none), and the text of each."""

    terms: np.ndarray
    first: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, hashes: np.ndarray, sizes: np.ndarray) -> Blocks:
        counts = np.diff(sizes)
        n = -(-counts // BLOCK)
        owner = np.repeat(np.arange(len(n)), n)
        ends = np.cumsum(n)
        first = np.repeat(sizes[:-1], n) + (np.arange(len(owner)) - np.repeat(ends - n, n)) * BLOCK
        at = first[:, None] + np.arange(BLOCK)
        inside = at < sizes[1:][owner][:, None]
        found = terms(hashes).astype(np.int32)
        rows = np.full(at.shape, -1, np.int32)
        rows[inside] = found[at[inside]]
        rows.sort(axis=1)
        rows[:, 1:][rows[:, 1:] == rows[:, :-1]] = -1
        return cls(rows, first, owner)


def document_counts(df: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many passages (blocks) of all rows each term is, and how many passages there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, total = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for start, stop in slices(batch.column(0)):
                hashes, sizes = word_hashes(batch.column(0).slice(start, stop - start))
                rows = Blocks.of(hashes, sizes).terms
                counts += np.bincount(rows.ravel() + 1, minlength=(1 << BITS) + 1)[1:]
                total += len(rows)
        found = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(np.append(found, -1)), pa.array(np.append(counts[found], total))], ["term", "n"])

    rows = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "term long, n long")
    out = np.zeros((1 << BITS) + 1, np.int64)
    # One row a term at most.
    for r in rows.groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


@dataclass
class Item:
    """A benchmark text: its key, its words, and which of them are its answer."""

    key: int
    hashes: np.ndarray
    answer: np.ndarray


def read_items(rows: list[tuple[int, str | None]]) -> list[Item]:
    """Items with words; the answer is what follows "answer:", or else the last sentence."""
    out = []
    for key, text in rows:
        text = text or ""
        hashes, _ = word_hashes(pa.array([text], pa.large_string()))
        marked = _ANSWER.search(text)
        last = marked[1] if marked else next((s for s in reversed(re.split(r"[.!?\n]+\s*", text)) if s.strip()), "")
        answer, _ = word_hashes(pa.array([last], pa.large_string()))
        if len(hashes):
            out.append(Item(key, hashes, answer))
    return out


@dataclass
class Space:
    """Term weights and the latent space of some passages of items: ``rows[slot[term]]`` are a term's coordinates.

    ``queries`` has the passages' directions; each is of the item ``item_of`` and begins at its word ``offset``.
    """

    weight: np.ndarray
    slot: np.ndarray
    rows: np.ndarray
    items: list[Item]
    queries: np.ndarray
    item_of: np.ndarray
    offset: np.ndarray

    def known(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared lengths of blocks of terms, and of their part that the items' terms make up."""
        squares = np.append(self.weight * self.weight, np.float32(0))
        inside = np.where(np.append(self.slot, np.int32(-1)) >= 0, squares, np.float32(0))
        return squares[rows].sum(axis=1), inside[rows].sum(axis=1)

    def fold(self, rows: np.ndarray) -> np.ndarray:
        """Coordinates of blocks of terms."""
        slot = -np.sort(-np.append(self.slot, np.int32(-1))[rows], axis=1)
        counts = (slot >= 0).sum(axis=1)
        out = np.zeros((len(rows), self.rows.shape[1]), self.rows.dtype)
        # Blocks with many known terms first, so that the k-th terms of all are the k-th column's beginning.
        order = np.argsort(-counts, kind="stable")
        for at in range(0, len(order), 512):
            some = order[at : at + 512]
            part, known = slot[some], counts[some]
            sums = np.zeros((len(some), out.shape[1]), out.dtype)
            for k in range(known[0] if len(known) else 0):
                n = np.searchsorted(-known, -k, "left")
                sums[:n] += self.rows[part[:n, k]]
            out[some] = sums
        return out


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, with the rows of the table as bits of one number."""
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        matched = row & places.get(x, 0)
        row = ((row + matched) | (row - matched)) & full
    return len(a) - row.bit_count()


def check(item: Item, window: np.ndarray) -> tuple[float, float]:
    """Share of an item's words in a common subsequence with the window, and of its answer's words in the window."""
    common = common_subsequence(item.hashes, window) / len(item.hashes)
    answer = float(np.isin(item.answer, window).mean()) if len(item.answer) else 1.0
    return common, answer


def _weights(counts: np.ndarray, passages: int) -> np.ndarray:
    return np.log((passages + 1) / (counts + 1)).astype(np.float32)


def _slots(hashes: np.ndarray) -> np.ndarray:
    slot = np.full(1 << BITS, -1, np.int32)
    used = np.unique(terms(hashes))
    slot[used] = np.arange(len(used))
    return slot


def _rows(lists: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of ``width`` numbers each as the rows of a matrix."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), width)


def _corners(n: int) -> np.ndarray:
    """Where the rows of a lower triangle of ``n`` rows begin in its cells, and its number of cells."""
    return np.arange(n + 1) * np.arange(1, n + 2) // 2


def _add_pairs(cells: np.ndarray, slot: np.ndarray, weight: np.ndarray, rows: np.ndarray, lengths: np.ndarray) -> None:
    """Add each two terms' product in some blocks of terms, of length 1 in the space of all terms, to a lower triangle."""
    begin = _corners(int(slot.max()) + 1)
    found = -np.sort(-np.append(slot, np.int32(-1))[rows], axis=1)
    counts = (found >= 0).sum(axis=1)
    # Blocks with many known terms first, so that the k-th terms of all are the k-th column's beginning.
    order = np.argsort(-counts, kind="stable")
    found, counts = found[order], counts[order]
    by_slot = np.append(weight[slot_terms(slot)], np.float32(0)).astype(np.float64)
    values = np.ascontiguousarray((by_slot[found] / np.sqrt(np.maximum(lengths[order], 1e-9))[:, None]).T)
    found = np.ascontiguousarray(found.T).astype(np.int64)
    for k in range(counts[0] if len(counts) else 0):
        n = np.searchsorted(-counts, -k, "left")
        for j in range(k + 1):
            # Whole parts, so that sums are the same in any order.
            parts = np.rint(values[j, :n] * values[k, :n] * PARTS).astype(np.int64)
            np.add.at(cells, begin[found[j, :n]] + found[k, :n], parts)


_PAIRS = "space long, slot long, other array<int>, parts array<long>"


def _pairs_of(space: int, first: int, cells: np.ndarray, begin: np.ndarray) -> pa.RecordBatch:
    """Rows ``first`` and on of a triangle, without empty cells."""
    used = np.flatnonzero(cells)
    offsets = pa.array(np.searchsorted(used, begin - begin[0]), pa.int32())
    n = len(begin) - 1
    row = np.searchsorted(begin - begin[0], used, "right") - 1
    other = pa.ListArray.from_arrays(offsets, pa.array(used - (begin - begin[0])[row], pa.int32()))
    parts = pa.ListArray.from_arrays(offsets, pa.array(cells[used], pa.int64()))
    columns = [pa.array(np.full(n, space)), pa.array(np.arange(first, first + n)), other, parts]
    return pa.record_batch(columns, ["space", "slot", "other", "parts"])


def pair_sums(df: DataFrame, weight: np.ndarray, slots: list[np.ndarray]) -> DataFrame:
    """For each space: the matrix of all rows' passages, transposed, times itself; a row a term, with the terms up to it.

    Texts are read once for as many spaces as have ``CELLS`` cells; the result grows with the spaces' terms, not with the texts.
    """
    sizes = [int(_corners(int(s.max()) + 1)[-1]) for s in slots]
    turns: list[list[int]] = [[]]
    for i, size in enumerate(sizes):
        if turns[-1] and sum(sizes[k] for k in turns[-1]) + size > CELLS:
            turns.append([])
        turns[-1].append(i)

    def counted(turn: list[int]) -> DataFrame:
        shared = Shipped(df.sparkSession, (weight, [slots[i] for i in turn]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weight, slots = shared.value
            squares = np.append(weight * weight, np.float32(0))
            begins = [_corners(int(s.max()) + 1) for s in slots]
            totals = [np.zeros(b[-1], np.int64) for b in begins]
            for batch in batches:
                for start, stop in slices(batch.column(0)):
                    rows = Blocks.of(*word_hashes(batch.column(0).slice(start, stop - start))).terms
                    lengths = squares[rows].sum(axis=1)
                    for cells, slot in zip(totals, slots, strict=True):
                        _add_pairs(cells, slot, weight, rows, lengths)
            for i, cells, begin in zip(turn, totals, begins, strict=True):
                for at in range(0, len(begin) - 1, 256):
                    some = begin[at : at + 257]
                    yield _pairs_of(i, at, cells[some[0] : some[-1]], some)

        return df.mapInArrow(run, _PAIRS).where(F.size("other") > 0)

    def add(table: pa.Table) -> pa.Table:
        space, slot = table.column("space")[0].as_py(), table.column("slot")[0].as_py()
        cells = np.zeros(slot + 1, np.int64)
        for other, parts in zip(table.column("other").chunks, table.column("parts").chunks, strict=True):
            np.add.at(cells, other.flatten().to_numpy(), parts.flatten().to_numpy())
        return pa.Table.from_batches([_pairs_of(space, slot, cells, np.array([0, slot + 1]))])

    found = counted(turns[0])
    for turn in turns[1:]:
        found = found.union(counted(turn))
    return found.groupBy("space", "slot").applyInArrow(add, _PAIRS)


def _products(pairs: DataFrame, bases: list[np.ndarray]) -> list[np.ndarray]:
    """For each space: the matrix that ``pair_sums`` has a triangle of, times the basis."""
    shared = Shipped(pairs.sparkSession, bases)
    kinds = pa.schema([("space", pa.int64()), ("slot", pa.int64()), ("product", pa.list_(pa.float64()))])

    def batch_of(space: int, used: np.ndarray, product: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(np.arange(len(used) + 1, dtype=np.int32) * product.shape[1], product.ravel())
        return pa.record_batch([pa.array(np.full(len(used), space)), pa.array(used), lists.cast(kinds.field(2).type)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases = shared.value
        totals = [np.zeros(b.shape) for b in bases]
        for batch in batches:
            spaces, rows = (batch.column(c).to_numpy() for c in (0, 1))
            ends, others, parts = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy(), batch.column(3).values.to_numpy()
            for i in np.unique(spaces):
                mine = np.flatnonzero(spaces == i)
                for at in range(0, len(mine), 256):
                    some = mine[at : at + 256]
                    half = np.zeros((len(some), len(bases[i])))
                    for k, r in enumerate(some):
                        half[k, others[ends[r] : ends[r + 1]]] = parts[ends[r] : ends[r + 1]] / PARTS
                    totals[i][rows[some]] += half @ bases[i]
                    half[np.arange(len(some)), rows[some]] = 0
                    totals[i] += half.T @ bases[i][rows[some]]
        for i, total in enumerate(totals):
            used = np.flatnonzero(np.any(total != 0, axis=1))
            yield batch_of(i, used, total[used])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            ends, values = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            for i, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                sums[key] = sums.get(key, 0) + values[ends[i] : ends[i + 1]]
        for (space, slot), product in sums.items():
            yield batch_of(space, np.array([slot]), product[None, :])

    fields = "space long, slot long, product array<double>"
    # One row a space and term.
    found = pairs.mapInArrow(run, fields).repartition("space", "slot").mapInArrow(add, fields).toArrow()
    shared.drop()
    out = [np.zeros(b.shape) for b in bases]
    space, slot = (found.column(c).to_numpy() for c in ("space", "slot"))
    for i, total in enumerate(out):
        mine = np.flatnonzero(space == i)
        total[slot[mine]] = _rows(found.column("product").take(pa.array(mine)), total.shape[1])
    return out


def _product(slot: np.ndarray, weight: np.ndarray, basis: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """What some blocks of terms add to the product; a block's vector has length 1 in the space of all terms."""
    by_term = weight[slot_terms(slot)]
    space = Space(weight, slot, basis * by_term[:, None], [], basis[:0], rows[:0], rows[:0])
    lengths, _ = space.known(rows)
    folded = space.fold(rows) / np.maximum(lengths, 1e-9)[:, None]
    found = np.append(slot, np.int32(-1))[rows]
    block, place = np.nonzero(found >= 0)
    at = found[block, place]
    order = np.argsort(at, kind="stable")
    at, block = at[order], block[order]
    begin = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.zeros(0, np.int64)
    ends = np.append(begin, len(at))
    out = np.zeros_like(basis)
    for i in range(0, len(begin), 512):
        some = begin[i : i + 512]
        a, b = some[0], ends[min(i + 512, len(begin))]
        out[at[some]] = np.add.reduceat(folded[block[a:b]], some - a, axis=0) * by_term[at[some]][:, None]
    return out


def slot_terms(slot: np.ndarray) -> np.ndarray:
    """The term of every slot."""
    used = np.flatnonzero(slot >= 0)
    return used[np.argsort(slot[used])]


def item_passages(items: list[Item]) -> tuple[np.ndarray, np.ndarray]:
    """The item and the first word of every passage: side by side, the last one ending with its item."""
    whole = 2 * BLOCK
    starts = [np.minimum(np.arange(0, len(i.hashes), whole), max(0, len(i.hashes) - whole)) for i in items]
    return np.repeat(np.arange(len(items)), [len(s) for s in starts]), np.concatenate(starts)


def latent_spaces(df: DataFrame, items: list[Item], counts: np.ndarray, passages: int, rank: int = RANK) -> list[Space]:
    """Latent spaces of TF-IDF passages by a randomised singular value decomposition.

    Every item is cut into passages, and each space has at most ``PASSAGES`` of them, so that its dimensions suffice to hold them. A
    space's matrix has the passages of all rows and its own as rows and its own passages' terms as columns: other terms have no part
    in a product with them, but count in a passage's length. The matrix's transpose times itself is summed once over all texts; a random
    basis is multiplied by it, for all spaces at once, and made orthogonal, ``ROUNDS`` times; the small problem that is left gives the
    singular vectors.
    """
    weight = _weights(counts, passages)
    item_of, offset = item_passages(items)
    own, slots, bases, places = [], [], [], []
    for some in np.array_split(np.arange(len(item_of)), -(-len(item_of) // PASSAGES)):
        cut = [items[i].hashes[at : at + 2 * BLOCK] for i, at in zip(item_of[some], offset[some], strict=True)]
        hashes = np.concatenate(cut)
        own.append(Blocks.of(hashes, np.r_[0, np.cumsum([len(c) for c in cut])]))
        slots.append(_slots(hashes))
        n = int(slots[-1].max()) + 1
        bases.append(np.linalg.qr(np.random.default_rng(5).standard_normal((n, min(n, rank + EXTRA))))[0])
        places.append(some)

    pairs = materialize(pair_sums(df, weight, slots), "pairs")

    def multiplied(bases: list[np.ndarray]) -> list[np.ndarray]:
        out = []
        for product, slot, basis, found in zip(_products(pairs, bases), slots, bases, own, strict=True):
            mine = _product(slot, weight, basis, found.terms)
            # Items are few beside the documents, but the space is for them.
            out.append(product / max(np.abs(product).max(), 1e-9) + ITEM_WEIGHT * mine / max(np.abs(mine).max(), 1e-9))
        return out

    for _ in range(ROUNDS):
        bases = [np.linalg.qr(product)[0] for product in multiplied(bases)]
    out = []
    for product, basis, slot, found, some in zip(multiplied(bases), bases, slots, own, places, strict=True):
        values, vectors = np.linalg.eigh((basis.T @ product + product.T @ basis) / 2)
        best = np.argsort(-values)[: min(rank, basis.shape[1])]
        rows = (basis @ vectors[:, best] * weight[slot_terms(slot)][:, None]).astype(np.float32)
        space = Space(weight, slot, rows, items, basis[:0], item_of[some], offset[some])
        folded = np.zeros((len(some), len(best)), np.float32)
        np.add.at(folded, found.owner, space.fold(found.terms))
        space.queries = folded / np.maximum(np.linalg.norm(folded, axis=1, keepdims=True), 1e-9)
        out.append(space)
    return out


def candidates(space: Space, found: Blocks, least: float = LEAST_COSINE) -> list[tuple[int, int, int, float]]:
    """Text, first word, query and cosine of all passages that are near a passage of an item in the latent space.

    A passage's length is that in the space of all terms, so one that shares little with any item is near none.
    """
    if not len(found.first):
        return []
    lengths, inside = space.known(found.terms)
    # The block after one, if it is of the same text; the last row stands for none.
    after = np.where(np.append(found.owner[1:], -1) == found.owner, np.arange(1, len(found.owner) + 1), len(found.owner))
    lengths = lengths + np.append(lengths, 0)[after]
    # No coordinate is longer than what it was made of: passages below the bound cannot be near, and are not folded.
    root = np.sqrt(np.append(inside, 0))
    chosen = np.flatnonzero(root[:-1] + root[after] >= least * np.sqrt(lengths))
    used, place = np.unique(np.append(chosen, after[chosen]), return_inverse=True)
    folded = space.fold(np.append(found.terms, np.full((1, BLOCK), -1, np.int32), axis=0)[used])
    folded = folded[place[: len(chosen)]] + folded[place[len(chosen) :]]
    folded /= np.sqrt(np.maximum(lengths[chosen], 1e-9))[:, None]
    near = np.flatnonzero(np.einsum("ij,ij->i", folded, folded) >= least * least)
    out = []
    for at in range(0, len(near), 8_192):
        part = near[at : at + 8_192]
        cosine = folded[part] @ space.queries.T
        for p, q in zip(*np.nonzero(cosine >= least), strict=True):
            place_of = chosen[part[p]]
            out.append((int(found.owner[place_of]), int(found.first[place_of]), int(q), float(cosine[p, q])))
    return out


def confirmed(spaces: list[Space], hashes: np.ndarray, sizes: np.ndarray) -> dict[tuple[int, int], tuple[float, float, float]]:
    """Text and item of the candidates that pass the checks: cosine, common share, answer share of the best place.

    A passage near a passage of an item says where the whole item would begin; places of one block are checked once.
    """
    found = Blocks.of(hashes, sizes)
    places: dict[tuple[int, int, int], float] = {}
    for space in spaces:
        for text, at, q, cosine in candidates(space, found):
            where = (text, int(space.item_of[q]), (at - int(sizes[text]) - int(space.offset[q])) // BLOCK)
            places[where] = max(places.get(where, 0.0), cosine)
    out: dict[tuple[int, int], tuple[float, float, float]] = {}
    for (text, i, step), cosine in places.items():
        item = spaces[0].items[i]
        begin, size = int(sizes[text]) + step * BLOCK, len(item.hashes)
        beside = size // 2 + BLOCK
        window = hashes[max(sizes[text], begin - beside) : max(sizes[text], min(sizes[text + 1], begin + BLOCK + size + beside))]
        # Cheap first: too few common words cannot hold a long common subsequence.
        if np.isin(item.hashes, window).mean() < LEAST_COMMON:
            continue
        common, answer = check(item, window)
        if common >= LEAST_COMMON and answer >= LEAST_ANSWER:
            out[text, i] = max(out.get((text, i), (0.0, 0.0, 0.0)), (common, answer, cosine))
    return {k: (c, a, b) for k, (a, b, c) in out.items()}


_FOUND = "key {kind}, item_id long, cosine double, common double, answer double"


def _search(df: DataFrame, spaces: list[Space], text: str, key: str) -> DataFrame:
    shared = Shipped(df.sparkSession, spaces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spaces = shared.value
        for batch in batches:
            at, rows = [], []
            for start, stop in slices(batch.column(1)):
                hashes, sizes = word_hashes(batch.column(1).slice(start, stop - start))
                for (t, i), scores in sorted(confirmed(spaces, hashes, sizes).items()):
                    at.append(start + t)
                    rows.append((spaces[0].items[i].key, *scores))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            picked = batch.column(0).take(pa.array(at, pa.int64()))
            yield pa.record_batch(
                [picked, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["key", "item_id", "cosine", "common", "answer"],
            )

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, _FOUND.format(kind=kind))


def _all_spaces(
    df: DataFrame, benchmark: DataFrame, text: str, key: str, item: str, item_text: str, fit_rows: int | None
) -> Iterator[list[Space]]:
    """The latent spaces of all items, as many at a time as one pass searches."""
    counts, passages = document_counts(df, text)
    fitted = df.select(F.col(f"`{text}`").alias("text"))
    if fit_rows is not None:
        share = min(1.0, fit_rows / max(1, df.count()))
        # A hash below a bound: the same rows each time, about ``fit_rows`` of them.
        chosen = df.where(F.pmod(F.xxhash64(key, F.lit(9)), F.lit(1 << 31)) < int(share * (1 << 31)))
        fitted = materialize(chosen.select(F.col(f"`{text}`").alias("text")), "fitted")
    asked = benchmark.select(F.col(f"`{item}`").alias("item"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"))
    asked = asked.where("item IS NOT NULL")
    n = asked.agg(F.sum(F.ceil(F.size(F.split("text", r"\s+")) / (2 * BLOCK)))).first()[0] or 0
    groups = max(1, -(-n // (PASSAGES * SPACES)))
    for g in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == g)
        items = read_items(sorted((r[0], r[1]) for r in mine.collect()))
        if items:
            yield latent_spaces(fitted, items, counts, passages)


def contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    fit_rows: int | None = None,
) -> DataFrame:
    """Columns key, ``item_id``, ``cosine``, ``common`` and ``answer``: every row that holds an item or a paraphrase of it.

    Term weights are counted over all passages of all rows, and the latent spaces are fitted on them and all items' passages (a
    caller may ask for about ``fit_rows`` rows instead); every passage of every row is searched, and candidates are
    checked with the item's whole words. Items of any number and length are cut into passages, ``PASSAGES`` of them to a space;
    ``SPACES`` spaces are searched in one pass, so neither a space nor what is broadcast grows with the benchmark. No text is shuffled.
    Null and empty texts and items match nothing; repeated rows each give their matches; other columns are not read.
    """
    out = None
    for spaces in _all_spaces(df, benchmark, text, key, item, item_text, fit_rows):
        found = _search(df, spaces, text, key)
        out = found if out is None else out.union(found)
    if out is None:
        out = df.sparkSession.createDataFrame([], _FOUND.format(kind=df.schema[key].dataType.simpleString()))
    return out.withColumnRenamed("key", key)


def _hit(spaces: list[Space], df: DataFrame, text: str) -> Column:
    shared = Shipped(df.sparkSession, spaces)

    @F.arrow_udf("boolean")
    def hit(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), bool)
        for start, stop in slices(texts):
            hashes, sizes = word_hashes(texts.slice(start, stop - start))
            out[[start + t for t, _ in confirmed(shared.value, hashes, sizes)]] = True
        return pa.array(out)

    return hit(F.col(f"`{text}`"))


def keep_clean(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    item: str = "item_id",
    item_text: str = "text",
    fit_rows: int | None = None,
) -> DataFrame:
    """The rows of ``df`` whose text holds no item, judged where they are: no join, no shuffle.

    Rows with a null key are judged like all others, and of rows that share a key only those that hold an item go.
    """
    out = df
    for spaces in _all_spaces(df, benchmark, text, key, item, item_text, fit_rows):
        out = out.where(~_hit(spaces, df, text))
    return out
