"""Document fingerprints of closed syncmers, anchors that depend on no context around them."""

from __future__ import annotations

import base64
import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parley.llm.arrays import mix, slices

#: Characters of a k-mer and of the inner substrings that are compared in it.
K = 16
S = 5
#: Bytes of an anchor's hash that a fingerprint keeps.
HASH_BYTES = 5
#: Bytes of text in a range of keys, which is one task's.
RANGE_BYTES = 32 << 20
#: Bytes of fingerprints that are handed on together.
OUT_BYTES = 4 << 20
_KEPT = np.uint64((1 << 8 * HASH_BYTES) - 1)
_BASE = 0x2545F4914F6CDD1D | 1
#: Characters that are worked on at a time.
_BLOCK = 1 << 19


def _hashes(points: np.ndarray, starts: np.ndarray | slice, width: int) -> np.ndarray:
    """Hashes of the substrings of one width at the given places, or at all of them."""
    whole = isinstance(starts, slice)
    n = len(points) - width + 1
    out = np.zeros(n if whole else len(starts), np.uint64)
    for i in range(width):
        out *= np.uint64(_BASE)
        out += points[i : i + n] if whole else points[starts + i]
    return mix(out)


def _least_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window, by windows of doubling widths."""
    done = 1
    while done < width:
        more = min(done, width - done)
        values = np.minimum(values[: len(values) - more], values[more:])
        done += more
    return values


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the closed syncmers of a text.

    A k-mer is one if the least of its inner substrings is the first or the last
    of them, which only its own characters decide. A text shorter than a k-mer
    is one anchor, as is a longer one in which no k-mer is chosen; an empty text has none.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if len(points) < K:
        hashes = _hashes(points, slice(None), len(points)) if len(points) else points
        return hashes, np.zeros(len(hashes), np.int64)
    out, places = [], []
    for at in range(0, len(points) - K + 1, _BLOCK):
        part = points[at : at + _BLOCK + K - 1]
        inner = _hashes(part, slice(None), S)
        least = _least_in(inner, K - S + 1)
        n = len(least)
        found = np.flatnonzero((inner[:n] == least) | (inner[K - S : K - S + n] == least))
        out.append(_hashes(part, found, K))
        places.append(found + at)
    if not sum(map(len, out)):
        return _hashes(points, slice(None), len(points)), np.zeros(1, np.int64)
    return np.concatenate(out), np.concatenate(places)


def sketch(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of the whole text in its order, each with the distance to the one before (the first: its place).

    Hashes are cut to ``HASH_BYTES``. Every stretch of k-mers as long as a k-mer has inner substrings holds an
    anchor, so distances fit into a byte. A text long enough for k-mers but without an anchor is one.
    """
    hashes, places = anchors(text)
    gaps = np.diff(places, prepend=0).astype(np.uint8)
    return hashes & _KEPT, gaps


def written(found: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as text: base64 of the distance and the hash of each anchor, 8 characters an anchor."""
    hashes, gaps = found
    packed = np.empty((len(hashes), HASH_BYTES + 1), np.uint8)
    packed[:, 0] = gaps
    packed[:, 1:] = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]
    return base64.b64encode(packed.tobytes()).decode()


def read(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """The anchors of a written fingerprint."""
    packed = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, HASH_BYTES + 1)
    hashes = np.zeros((len(packed), 8), np.uint8)
    hashes[:, :HASH_BYTES] = packed[:, 1:]
    return hashes.view("<u8").ravel().astype(np.uint64), packed[:, 0].copy()


def links(found: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One hash an anchor, of the anchor before, the distance, and itself; sorted, repeats kept."""
    hashes, gaps = found
    before = np.concatenate([np.zeros(1, np.uint64), hashes[:-1]])[: len(hashes)]
    return np.sort(mix(before * np.uint64(_BASE) + gaps) * np.uint64(_BASE) + hashes)


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of anchors that two fingerprints have in common at matching places, 0 to 1.

    An anchor matches one of the other text that has the same hash and follows an equal anchor at the same
    distance, each anchor once. Runs of anchors that agree on a shift match whole, whatever the shift and
    however many there are, so insertions cost only the anchors around them. Two empty fingerprints are alike.
    """
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    (x, n), (y, m) = (np.unique(links(f), return_counts=True) for f in (a, b))
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return 2.0 * int(np.minimum(n[i], m[j]).sum()) / (len(a[0]) + len(b[0]))


def edited(text: str, following: str) -> str:
    """The text with its second half replaced by as much of the beginning of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns key, ``n_chars`` and ``fingerprint`` of every row's whole text; null counts as empty. No shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(1), OUT_BYTES):
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part.column(1).to_pylist()]
                sizes, prints = pa.array(map(len, texts), pa.int64()), pa.array([written(sketch(t)) for t in texts], pa.string())
                yield pa.record_batch([part.column(0), sizes, prints], ["key", "n_chars", "fingerprint"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_chars long, fingerprint string").withColumnRenamed("key", key)


_FIELDS = (
    "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and key; every row is compared with the one after it in its range."""
    names = [f.split()[0] for f in _FIELDS.split(", ")]
    held = None
    for whole in batches:
        for start, stop in slices(whole.column(3), OUT_BYTES):
            out = []
            parts, keys, lookahead, texts = (c.to_pylist() for c in whole.slice(start, stop - start).columns)
            for part, key, ahead, text in zip(parts, keys, lookahead, texts, strict=True):
                text = text or ""
                mark = sketch(text)
                if held is not None and held[0] == part:
                    _, last_key, last, last_mark = held
                    new = edited(last, text)
                    new_mark = sketch(new) if new != last else last_mark
                    digest = hashlib.sha256(new.encode()).hexdigest()
                    out.append(
                        (last_key, len(last), digest, written(last_mark), written(new_mark))
                        + (likeness(last_mark, new_mark), likeness(last_mark, mark))
                    )
                held = None if ahead else (part, key, text, mark)
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names)


_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def compare_with_next(df: DataFrame, text: str = "text", key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Fingerprints of every text, of its edited form, and how near they and the next document are.

    The next document is the one with the next key; after the last comes the first.
    Rows are dealt out by ranges of keys, as many as the bytes of the texts ask for (``RANGE_BYTES`` each, or one for
    each of the session's cores), one a task. Each range also gets a copy of the row that follows it, so texts are
    shuffled once and no task sees more than its range. The bounds come from the keys alone; a key, or the null
    key, that fills several ranges is parted by a hash of the text.
    Null keys come first and repeated keys are put in the order of their texts' hashes; a null text counts
    as empty; a single row is followed by itself. Rows equal in key and text stay in one range.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    if parts is None:
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(-(-size // RANGE_BYTES), spark.sparkContext.defaultParallelism)
    shares = [i / parts for i in range(1, parts)] or [0.5]
    stats = rows.agg(
        F.count("*").alias("n"), F.count("key").alias("known"), F.percentile_approx("key", shares, 100 * parts).alias("cuts")
    ).first()
    found = stats["cuts"] or []
    cuts = sorted(set(found))
    times = Counter(found)
    # Slots: null keys, then for every bound the keys below it and the key itself, then the keys above. A slot has
    # one range; null keys and a key that several bounds fall on have as many as their rows ask for.
    nulls = -(-(stats["n"] - stats["known"]) * parts // max(stats["n"], 1))
    first_range, widths, ranges = [0], [nulls], nulls
    for c in cuts:
        hot = times[c] > 1
        first_range += [ranges, ranges + hot]
        widths += [1, times[c]]
        ranges += 1 + hot * times[c]
    first_range, widths, ranges = [*first_range, ranges], [*widths, 1], ranges + 1
    below = _place(F.col("key"), cuts)
    at_bound = F.get(_numbers(cuts), below) == F.col("key")
    slot = F.when(F.col("key").isNull(), F.lit(0)).otherwise(1 + 2 * below + F.when(at_bound, 1).otherwise(0))
    width, first_at = F.get(_numbers(widths), F.col("slot")), F.get(_numbers(first_range), F.col("slot"))
    # The hash, moved to 0 and up, in as many equal steps as the slot has ranges.
    step = F.floor((F.shiftright("mark", 32) + F.lit(1 << 31)) * width / F.lit(1 << 32))
    placed = (
        rows.select(slot.alias("slot"), "key", F.xxhash64("text").alias("mark"), "text")
        .withColumn("part", (first_at + step).cast("int"))
        .drop("slot")
    )
    # The first row of every range, by key and text, also ends the range before it: one row a range.
    opening = placed.groupBy("part").agg(F.min(F.struct(F.col("key").isNotNull(), "key", "mark")).alias("o")).collect()
    firsts = sorted((r["part"], r["o"]["key"], r["o"]["mark"]) for r in opening)
    at: list[list] = [[None] * ranges for _ in range(3)]
    for i, (number, first, mark) in enumerate(firsts):
        for column, value in zip(at, (first, mark, firsts[i - 1][0]), strict=True):
            column[number] = value
    first, mark, before = (F.get(_numbers(c), F.col("part")) for c in at)
    is_first = F.col("key").eqNullSafe(first) & (F.col("mark") == mark)
    both = F.array(
        F.struct(F.col("part").cast("int").alias("part"), F.lit(False).alias("ahead")),
        F.struct(F.when(is_first, before).cast("int").alias("part"), F.lit(True).alias("ahead")),
    )
    dealt = placed.select("key", "mark", "text", F.explode(both).alias("p")).where("p.part IS NOT NULL")
    ranged = dealt.select("p.part", "p.ahead", "key", "mark", "text").repartitionById(ranges, "part")
    ranged = ranged.sortWithinPartitions("part", "ahead", "key", "mark")
    return ranged.select("part", "key", "ahead", "text").mapInArrow(_compared, _FIELDS).withColumnRenamed("key", key)


def _numbers(values: list) -> Column:
    """Whole numbers or nulls as one constant array."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _place(value: Column, cuts: list[int]) -> Column:
    """How many of the sorted bounds are below a value, by halving."""
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    if not steps:
        return F.lit(0)

    def go(at, step):
        return at + F.when(F.get(_numbers(cuts), at + step - 1) < value, step).otherwise(0)

    return F.when(value.isNotNull(), F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), go))
