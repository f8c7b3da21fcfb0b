"""Importance resampling towards a target: hashed n-gram features from running CRCs, log ratios, and a Gumbel top-k draw."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrays import flat, slices
from parley.llm.chunks import sums
from parley.session import materialize

#: Buckets of the features, words in the longest feature, words of a document that may be drawn, and percent drawn.
BUCKETS, LONGEST, MIN_WORDS, PERCENT = 10_000, 2, 20, 25
SEED = 7

_POLYNOMIAL = 0xEDB88320
_ALL = np.uint32(0xFFFFFFFF)
#: Bytes whose running CRCs are found side by side, a power of two.
_ROW = 64


def _inside() -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
    return out


_INSIDE = _inside()


@cache
def _byte_steps() -> np.ndarray:
    """The register after one byte, by the register's low byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> np.uint32(1)) ^ (np.uint32(_POLYNOMIAL) * (out & np.uint32(1)))
    return out


def _tables(matrix: np.ndarray) -> np.ndarray:
    """A linear map over GF(2), given by what it makes of each bit, as a table for each byte of a register."""
    byte = np.arange(256)
    out = np.zeros((4, 256), np.uint32)
    for part in range(4):
        for bit in range(8):
            out[part] ^= np.where(byte >> bit & 1, matrix[8 * part + bit], np.uint32(0)).astype(np.uint32)
    return out


def _mapped(tables: np.ndarray, values: np.ndarray) -> np.ndarray:
    return tables[0][values & 0xFF] ^ tables[1][values >> 8 & 0xFF] ^ tables[2][values >> 16 & 0xFF] ^ tables[3][values >> 24]


@cache
def _doubling(power: int) -> np.ndarray:
    """Tables of the map that shifts a register by 2**power zero bytes; it is the map before, twice."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    if power:
        half = _doubling(power - 1)
        return _tables(_mapped(half, _mapped(half, bits)))
    return _tables((bits >> np.uint32(8)) ^ _byte_steps()[bits & np.uint32(0xFF)])


def shift(values: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Registers after as many zero bytes as ``zeros`` says for each: shifts of powers of two, put together."""
    out = values.astype(np.uint32)
    power = 0
    while (rest := zeros >> power).any():
        odd = (rest & 1).astype(bool)
        out[odd] = _mapped(_doubling(power), out[odd])
        power += 1
    return out


def running(data: np.ndarray) -> np.ndarray:
    """The register, begun at zero, before every byte and after the last: ``len(data) + 1`` values.

    Rows of bytes are stepped through side by side; the registers at the rows' ends are carried
    over to later rows by shifts, in as many rounds as the number of rows has bits.
    """
    rows = -(-len(data) // _ROW) + 1
    padded = np.zeros(rows * _ROW, np.uint8)
    padded[: len(data)] = data
    columns = np.ascontiguousarray(padded.reshape(rows, _ROW).T)
    inner = np.empty((_ROW + 1, rows), np.uint32)
    inner[0] = 0
    steps = _byte_steps()
    for i in range(_ROW):
        inner[i + 1] = (inner[i] >> np.uint32(8)) ^ steps[(inner[i] ^ columns[i]) & np.uint32(0xFF)]
    ends, reach, power = inner[_ROW].copy(), 1, _ROW.bit_length() - 1
    while reach < rows:
        ends[reach:] ^= _mapped(_doubling(power), ends[:-reach])
        reach, power = 2 * reach, power + 1
    before = np.r_[np.zeros(1, np.uint32), ends[:-1]]
    for i in range(_ROW):
        inner[i] ^= before
        before = (before >> np.uint32(8)) ^ steps[before & np.uint32(0xFF)]
    return inner[:_ROW].T.reshape(-1)[: len(data) + 1]


def spans_crc(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of spans of bytes from two prefixes each: what came before, shifted by the span's length, cancels out."""
    return prefix[ends] ^ shift(prefix[starts] ^ _ALL, ends - starts) ^ _ALL


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts with A-Z lower-cased and one space after each word: the bytes, starts and ends of words, and offsets by text in words."""
    lower = data + np.uint8(32) * ((data >= ord("A")) & (data <= ord("Z"))).astype(np.uint8)
    inside = _INSIDE[lower]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside & (np.r_[True, ~inside[:-1]] | edge[:-1])
    stops = inside & (np.r_[~inside[1:], True] | edge[1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sizes = ends - starts
    at = np.r_[0, np.cumsum(sizes + 1)]
    out = np.full(at[-1], 0x20, np.uint8)
    place = np.ones(at[-1], bool)
    place[at[1:] - 1] = False
    out[place] = lower[inside]
    return out, at[:-1], at[:-1] + sizes, np.searchsorted(starts, offsets)


def features(texts: pa.Array, longest: int = LONGEST, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets of all runs of 1 to ``longest`` words of some texts, offsets of the texts in them, and the texts' words.

    A bucket is the CRC-32 of the run's words, joined by spaces, modulo ``buckets``.
    """
    for start, stop in slices(texts):
        data, starts, ends, at = normalised(*flat(texts.slice(start, stop - start)))
        prefix, words = running(data), np.diff(at)
        text = np.repeat(np.arange(len(words)), words)
        of, found = [], []
        for n in range(longest):
            first = np.arange(max(0, len(starts) - n))
            first = first[text[first] == text[first + n]] if n else first
            of.append(text[first])
            found.append(spans_crc(prefix, starts[first], ends[first + n]) % np.uint32(buckets))
        whose, bucket = np.concatenate(of), np.concatenate(found).astype(np.int64)
        order = np.argsort(whose, kind="stable")
        yield bucket[order], np.r_[0, np.cumsum(np.bincount(whose, minlength=len(words)))], words


def bucket_counts(df: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket. A task sends one row a bucket, the driver gets ``buckets`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for bucket, _, _ in features(batch.column(0), longest, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    parts = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The floored thousandfold log ratio of each bucket's smoothed share in the target and in the source."""
    buckets = len(source)
    ratio = (target + 1.0) * (float(source.sum()) + buckets) / ((source + 1.0) * (float(target.sum()) + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(df: DataFrame, gain: np.ndarray, text: str = "text", key: str = "doc_id", longest: int = LONGEST) -> DataFrame:
    """Columns key, ``n_words``, ``n_features`` and ``weight``, the floored mean gain of a text's features, 0 if it has none."""
    shared = df.sparkSession.sparkContext.broadcast(gain.tolist())  # a number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = np.array(shared.value, np.int64)
        for batch in batches:
            row = 0
            for bucket, at, words in features(batch.column(1), longest, len(value)):
                n = np.diff(at)
                mean = np.where(n > 0, sums(value[bucket], at) // np.maximum(n, 1), 0)
                keys = batch.column(0).slice(row, len(n))
                yield pa.record_batch([keys, pa.array(words), pa.array(n), pa.array(mean)], ["key", "n_words", "n_features", "weight"])
                row += len(n)

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_words long, n_features long, weight long")


def gumbel(key: Column, seed: int = SEED) -> Column:
    """Thousandfold Gumbel noise, floored, from a hash of the key; a null key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """``df`` with the place of each row in a total order, from 1 on, without one task for all.

    Rows are dealt out by ranges of the order and numbered inside each; ranges begin after the counts of those before.
    Rows equal in all of ``order`` come in the order of the files they are read from.
    """
    named = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    keys = [f"_o{i}" for i in range(len(order))] + ["_tie"]
    rows = df.select("*", *named, F.monotonically_increasing_id().alias("_tie")).repartitionByRange(*keys)
    dealt = materialize(rows.withColumn("_range", F.spark_partition_id()), "ranges")
    counts = {r["_range"]: r["n"] for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect()}  # one a task
    before, starts = 0, []
    for part in sorted(counts):
        starts.append((part, before))
        before += counts[part]
    first = F.broadcast(df.sparkSession.createDataFrame(starts, "_range int, _before long"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*keys))
    out = dealt.join(first, "_range").withColumn(rank, F.col("_before") + within)
    return out.drop("_range", "_before", *keys)


def resample(
    df: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    target_text: str = "text",
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Draw rows of ``df`` that look like ``target``, without replacement, by importance weights of their n-grams.

    Columns key, ``n_words``, ``n_features``, ``weight``, ``score`` (weight and Gumbel noise) and ``rank``: 1, 2, 3 ... for
    the highest scores, null for rows that are not drawn. Of the N rows with ``min_words`` words or more, floor(percent * N / 100)
    are drawn; ties go to the smaller key, null keys last. Null and empty texts have no features and weight 0; repeated
    rows are rows of their own. Two passes over the texts; only drawn rows are shuffled, without their texts.
    """
    gain = gains(bucket_counts(df, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    scored = weights(df, gain, text, key, longest).withColumn("score", F.col("weight") + gumbel(F.col("key"), seed))
    scored = materialize(scored, "scores")
    # Scores are whole numbers within some ten thousands of zero, so their counts are few rows whatever the input.
    counts = scored.where(F.col("n_words") >= min_words).groupBy("score").count().collect()
    wanted = percent * sum(r["count"] for r in counts) // 100
    cut, above = None, 0
    for r in sorted(counts, key=lambda r: -r["score"]):
        if above >= wanted:
            break
        cut, above = r["score"], above + r["count"]
    may = (F.col("n_words") >= min_words) & (F.col("score") >= cut) if cut is not None else F.lit(False)
    order = [-F.col("score"), F.col("key").isNull(), F.col("key")]
    first = ranked(scored.where(may), order, "rank")
    first = first.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    rest = scored.where(~may).withColumn("rank", F.lit(None).cast("long"))
    return first.unionByName(rest).withColumnRenamed("key", key)
