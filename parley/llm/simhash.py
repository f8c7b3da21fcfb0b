"""SimHash near-duplicates: fingerprints of word shingles, linked over a binary trie."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.arrays import as_bytes
from parley.llm.components import components
from parley.llm.trie import TrieJoin
from parley.session import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: The fingerprint is cut into so many pieces for the search.
PIECES = 6
#: Fingerprints of one bucket in one group; fuller buckets are dealt out in pairs of portions.
PORTION = 50_000
#: Fingerprints that the trie join takes at a time, beside the rest of the last bucket.
CHUNK = 200_000
#: Shingles whose bits are counted at a time.
_BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a whole text: a bit is 1 if set in over half the hashes of its shingles.

    A-Z are lower-cased, words are what ASCII white space separates; fewer words
    than a shingle has are one shingle, and no words give 0.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    n = len(parts) - shingle + 1
    if n < 1:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(sizes + 1) - 1
        digest = xxhash.xxh64_intdigest
        starts, stops = (ends - sizes)[:n].tolist(), ends[shingle - 1 :].tolist()
        hashes = [digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)]
    values = np.array(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(values), _BLOCK):
        bits = np.unpackbits(values[at : at + _BLOCK].view(np.uint8), bitorder="little")
        # Eight counters of one byte are added at a time; 255 rows fill none of them.
        eights = np.add.reduceat(bits.view(np.uint64).reshape(-1, 8), range(0, len(bits) // 64, 255), axis=0)
        counts += eights.view(np.uint8).sum(axis=0, dtype=np.int64)
    high = np.packbits(2 * counts > len(values), bitorder="little")
    return int.from_bytes(high.tobytes(), "little")


def simhash(df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """Columns key and ``fp``, the fingerprint as a signed 64-bit number; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in as_bytes(batch.column(1))], np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(found.view(np.int64))], ["key", "fp"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, fp long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _pieces(max_bits: int, pieces: int) -> list[int]:
    """Masks of pieces such that two fingerprints within ``max_bits`` agree under one mask at least."""
    bounds = [64 * i // pieces for i in range(pieces + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(masks, pieces - max_bits)]


def _joined(max_bits: int):
    def chunk(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((values, keys))
        keys, values = keys[order], values[order]
        root = values[TrieJoin(keys, values, max_bits).components()]
        new = root != values
        return pa.record_batch([pa.array(values[new].view(np.int64)), pa.array(root[new].view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last, group = [], 0, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.stack([c.to_numpy() for c in batch.columns[:4]])
            first = columns[:, 0] if last is None else last
            new = np.any(columns != np.column_stack([first, columns[:, :-1]]), axis=0)
            groups = group + np.cumsum(new)
            group, last = int(groups[-1]), columns[:, -1]
            held.append((groups, batch.column(4).to_numpy().view(np.uint64)))
            size += batch.num_rows
            if size >= CHUNK:
                groups, values = (np.concatenate(x) for x in zip(*held, strict=True))
                whole = groups < group
                if whole.any():
                    yield chunk(groups[whole], values[whole])
                    held, size = [(groups[~whole], values[~whole])], int((~whole).sum())
                else:
                    held = [(groups, values)]
        if held:
            yield chunk(*(np.concatenate(x) for x in zip(*held, strict=True)))

    return run


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS, pieces: int = PIECES, portion: int = PORTION) -> DataFrame:
    """Links ``a``, ``b`` that connect all of ``fp`` (distinct) whose bits differ in ``max_bits`` places or fewer.

    Two such fingerprints agree in all but ``max_bits`` of the pieces, so each
    goes to a bucket for every choice of the other pieces; the trie join runs in
    each bucket and gives a spanning forest of its links, never all pairs. A bucket
    of more than ``portion`` fingerprints is cut into portions and each pair
    of portions is a group of its own, so no group grows with the input.
    """
    choices = F.array(
        *(
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("part"))
            for i, m in enumerate(_pieces(max_bits, pieces))
        )
    )
    keyed = fingerprints.select("fp", F.explode(choices).alias("k")).select("fp", "k.choice", "k.part")
    counts = keyed.groupBy("choice", "part").count()
    full = counts.where(F.col("count") > portion).select(
        "choice", "part", F.ceil(F.col("count") / portion).cast("long").alias("portions")
    )
    n = F.coalesce("portions", F.lit(1))
    mine = F.pmod(F.xxhash64("fp"), n)
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), n - 1),
        lambda j: F.struct(F.least(mine, j).alias("i"), F.greatest(mine, j).alias("j")),
    )
    dealt = (
        keyed.join(full, ["choice", "part"], "left")
        .select("choice", "part", "fp", F.explode(F.array_distinct(pair)).alias("p"))
        .select(F.col("choice").cast("long"), "part", "p.i", "p.j", "fp")
    )
    key = ["choice", "part", "i", "j"]
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(_joined(max_bits), "a long, b long")


def near_duplicates(
    df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """Columns key, ``fp`` and ``component_id``, the least key that links lead to from a row.

    Every row stays, with its fingerprint, in the result. Equal texts have equal fingerprints and
    are one node; null and empty texts share fingerprint 0. Rows with a null key
    are kept and do not name a component unless it has no other key. Only
    keys and fingerprints are shuffled, never texts.
    """
    marks = materialize(simhash(df, text, key, shingle), "fingerprints")
    distinct = materialize(marks.groupBy("fp").agg(F.min("key").alias("first")), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_bits), "a", "b")
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = materialize(named.join(least, "root").select("fp", "component_id"), "components")
    return marks.join(of, "fp").select(F.col("key").alias(key), "fp", "component_id")


def hexadecimal(fp: Column | str) -> Column:
    """A signed 64-bit number as 16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(
    df: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``df`` with the least key of each group of near-duplicates.

    Rows that share a key are one document and stay or go together: they stay if the
    key is the least of any group. Rows with a null key stay.
    """
    found = near_duplicates(df, text, key, shingle, max_bits)
    kept = F.max(F.col(key) == F.col("component_id"))
    dropped = found.groupBy(key).agg(kept.alias("kept")).where("NOT kept").select(key)
    return df.join(dropped, key, "left_anti")
