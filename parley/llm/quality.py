"""Quality classifier: n-gram indicators scaled by class ratios, and a linear hinge-loss model by dual coordinate descent."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.arrays import Shipped, SpanHash, flat, mix, slices, words
from parley.session import materialize

#: Indicators are hashed to so many bits.
BITS = 18
#: Labelled rows of each class that the model is fitted on, chosen by a hash of their key.
FIT_ROWS = 3_000
#: Bytes of a byte n-gram, and hash bases that keep the kinds of n-grams apart.
GRAM = 4
#: Weight of an error, passes over the rows, rows of smoothing, and parts for the calibration.
COST, PASSES, SMOOTH, FOLDS = 1.0, 12, 1.0, 4
THRESHOLD = 0.3

_LETTER, _UPPER, _DIGIT, _OTHER = 1, 2, 4, 8


def _kinds() -> np.ndarray:
    out = np.full(256, _OTHER, np.uint8)
    out[[*range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = _LETTER
    out[[*range(ord("A"), ord("Z") + 1)]] = _UPPER
    out[[*range(ord("0"), ord("9") + 1)]] = _DIGIT
    return out


_KIND = _kinds()


def _ranked(values: np.ndarray, salt: int) -> np.ndarray:
    return (mix(values + np.uint64(salt << 40)) >> np.uint64(64 - BITS)).astype(np.int64)


def indicators(texts: pa.Array) -> Iterator[np.ndarray]:
    """For every text, in order, the numbers of the n-grams that it has, ascending.

    n-grams of bytes, of words (one and two), and of the shapes of three words:
    letters, capitals, digits or signs in a word, its rough length, and whether it repeats the word before.
    """
    flags = np.zeros(1 << BITS, bool)
    for start, stop in slices(texts):
        data, offsets = flat(texts.slice(start, stop - start))
        begins, ends = words(data, offsets)
        hashes = SpanHash(data)(begins, ends)
        pairs = np.r_[hashes[:1], hashes[1:] * np.uint64(31) + hashes[:-1]]
        kinds = np.bitwise_or.reduceat(_KIND[data], begins) if len(begins) else np.zeros(0, np.uint8)
        if len(begins):
            # The last byte is often a stop; its kind alone tells lists and noise from sentences.
            last = _KIND[data[ends - 1]]
            same = np.r_[False, hashes[1:] == hashes[:-1]]
            size = np.minimum(np.log2(ends - begins + 1).astype(np.int64), 7)
            shapes = (kinds.astype(np.int64) << 8) | (last.astype(np.int64) << 4) | (size << 1) | same
            shapes = shapes.astype(np.uint64)
        else:
            shapes = np.zeros(0, np.uint64)
        threes = shapes.copy()
        threes[2:] = (shapes[2:] << np.uint64(24)) | (shapes[1:-1] << np.uint64(12)) | shapes[:-2]
        code = data.astype(np.uint64)
        grams = np.zeros(max(0, len(data) - GRAM + 1), np.uint64)
        for i in range(GRAM):
            grams = (grams << np.uint64(8)) | code[i : i + len(grams)]
        numbers = [_ranked(v, s) for s, v in enumerate((grams, hashes, pairs, threes), 1)]
        first = np.searchsorted(begins, offsets)
        for i in range(stop - start):
            a, b = first[i], first[i + 1]
            some = (
                numbers[0][offsets[i] : max(offsets[i], offsets[i + 1] - GRAM + 1)],
                numbers[1][a:b],
                numbers[2][a + 1 : b],
                numbers[3][a + 2 : b],
            )
            for n in some:
                flags[n] = True
            found = np.flatnonzero(flags)
            flags[found] = False
            yield found


def ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log ratio, for every n-gram, of its smoothed share among the rows of class 1 and of class 0."""
    counts = [np.full(1 << BITS, SMOOTH), np.full(1 << BITS, SMOOTH)]
    for row, label in zip(rows, labels.tolist(), strict=True):
        counts[label][row] += 1
    return np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())


def _scaled(rows: list[np.ndarray], ratio: np.ndarray) -> list[np.ndarray]:
    """The values of each row's indicators, its ratios divided by their length."""
    out = []
    for row in rows:
        values = ratio[row]
        length = np.sqrt(values @ values)
        out.append(values / length if length else values)
    return out


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model with the least hinge loss, by dual coordinate descent.

    One dual variable a row, from 0 to the cost of its class; each step sets one
    to its best value with the others held. Classes weigh the same together.
    """
    weights, bias = np.zeros(1 << BITS), 0.0
    sign = np.where(labels > 0, 1.0, -1.0)
    share = np.array([np.mean(labels == 0), np.mean(labels == 1)])
    most = COST * 0.5 / np.maximum(share, 1e-9)[labels]
    square = np.array([v @ v + 1.0 for v in values])
    dual = np.zeros(len(rows))
    rng = np.random.default_rng(seed)
    for _ in range(PASSES):
        for i in rng.permutation(len(rows)).tolist():
            slope = sign[i] * (weights[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(dual[i] - slope / square[i], 0.0), most[i])
            step = (new - dual[i]) * sign[i]
            if step:
                weights[rows[i]] += step * values[i]
                bias += step
                dual[i] = new
    return weights, bias


def calibrate(margins: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits margins of rows the model has not seen, by Newton's steps."""
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        d, h = weight * (p - labels), weight * p * (1 - p) + 1e-9
        gradient = np.array([d @ margins + 1e-3 * slope, d.sum()])
        cross = h @ margins
        hessian = np.array([[h @ margins**2 + 1e-3, cross], [cross, h.sum() + 1e-6]])
        step = np.linalg.solve(hessian, gradient)
        slope, shift = slope - np.clip(step[0], -2, 2), shift - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(max(slope, 1e-3)), float(shift)


@dataclass
class Model:
    """``ratio`` scales indicators, ``weights`` and ``bias`` give the margin, ``slope`` and ``shift`` the score."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: float | None = None

    def score(self, found: np.ndarray) -> float:
        """Score of a text by its indicators; a text without words has none and scores 0."""
        if not len(found):
            return 0.0
        if self.constant is not None:
            return self.constant
        values = self.ratio[found].astype(np.float64)
        length = np.sqrt(values @ values)
        margin = (values @ self.weights[found]) / (length or 1.0) + self.bias
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -30, 30))))


def fit(rows: list[np.ndarray], labels: np.ndarray, share: float) -> Model:
    """Fit on rows of both classes; ``share`` is that of class 1 among all labelled rows, for the scores.

    Rows of one class, or none, give a model whose score is that class (or 0.5) for every text.
    """
    if len(set(labels.tolist())) < 2:
        nothing = np.zeros(1 << BITS, np.float32)
        return Model(nothing, nothing, 0.0, 1.0, 0.0, float(labels[0]) if len(labels) else 0.5)
    fold = np.arange(len(rows)) % FOLDS
    margins = np.zeros(len(rows))
    for k in range(FOLDS):
        inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(set(labels[inside].tolist())) < 2:
            continue
        some = [rows[i] for i in inside]
        ratio = ratios(some, labels[inside])
        weights, bias = descend(some, _scaled(some, ratio), labels[inside])
        for i, v in zip(outside.tolist(), _scaled([rows[i] for i in outside], ratio), strict=True):
            margins[i] = v @ weights[rows[i]] + bias
    here = np.mean(labels)
    weight = np.where(labels > 0, share / here, (1 - share) / (1 - here))
    slope, shift = calibrate(margins, labels, weight)
    ratio = ratios(rows, labels)
    weights, bias = descend(rows, _scaled(rows, ratio), labels)
    return Model(ratio.astype(np.float32), weights.astype(np.float32), bias, slope, shift)


def learn(df: DataFrame, labelled: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """Fit on the texts of at most ``rows`` labelled rows of each class, chosen by a hash of their key.

    Labels other than 0 and 1 and null keys teach nothing; of repeated labels of a key the least counts,
    of repeated rows of a key the least text.
    Keys are chosen before any text moves, so the texts join a bounded table. Indicators are found where the texts
    are; one task holds those of the chosen rows (20 KB each or so) and fits the model.
    """
    known = labelled.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.where("key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(F.min("label").alias("label"))
    known = materialize(known, "labels")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    order = F.xxhash64("key", F.lit(3))
    picked = [known.where(F.col("label") == c).orderBy(order, "key").limit(rows) for c in (0, 1)]
    chosen = materialize(picked[0].union(picked[1]), "chosen")
    texts = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).where("text IS NOT NULL")
    found = texts.join(F.broadcast(chosen), "key")  # at most two times ``rows`` keys
    # One text a key, chosen where the rows are before any moves.
    found = found.groupBy("key", "label").agg(F.min("text").alias("text"))
    found = found.repartition(df.sparkSession.sparkContext.defaultParallelism)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [f.astype("<u4").tobytes() for f in indicators(batch.column(1))]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(packed, pa.binary())], ["key", "label", "found"])

    def model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [r for b in batches for r in b.to_pylist()]
        seen.sort(key=lambda r: (r["key"], r["found"]))
        packed = [np.frombuffer(r["found"], "<u4").astype(np.int64) for r in seen]
        m = fit(packed, np.array([r["label"] for r in seen], np.int64), share)
        columns = [m.ratio.tobytes(), m.weights.tobytes(), [m.bias, m.slope, m.shift], m.constant]
        kinds = [pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.float64()]
        names = ["ratio", "weights", "numbers", "constant"]
        yield pa.record_batch([pa.array([c], k) for c, k in zip(columns, kinds, strict=True)], names)

    total = sum(totals.values())
    share = totals.get(1, 0) / total if total else 0.5
    kind = df.schema[key].dataType.simpleString()
    rows_of = found.select("key", "text", "label").mapInArrow(features, f"key {kind}, label int, found binary")
    rows_of = materialize(rows_of, "indicators")
    fitted = rows_of.coalesce(1).mapInArrow(model, "ratio binary, weights binary, numbers array<double>, constant double")
    r = fitted.collect()
    if not r:
        return fit([], np.zeros(0, np.int64), share)
    return Model(
        np.frombuffer(r[0]["ratio"], np.float32), np.frombuffer(r[0]["weights"], np.float32), *r[0]["numbers"], r[0]["constant"]
    )


def rate(df: DataFrame, model: Model, text: str = "text", key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """Columns key, ``score`` and ``predicted`` from every row's whole text; no shuffle. A null text counts as empty."""
    shared = Shipped(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([shared.value.score(f) for f in indicators(batch.column(1))], np.float64)
            predicted = (scores >= threshold).astype(np.int32)
            yield pa.record_batch([batch.column(0), pa.array(scores), pa.array(predicted)], ["key", "score", "predicted"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, score double, predicted int").withColumnRenamed("key", key)


def keep_good(df: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose text the model does not reject, scored where they are: no shuffle, no join."""
    shared = Shipped(df.sparkSession, model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(f) for f in indicators(texts)], pa.float64())

    return df.where(score(F.col(f"`{text}`")) >= threshold)
