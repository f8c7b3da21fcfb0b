"""Language-model scoring: a log-bilinear model of word classes, taught by noise contrast and normalised by matrix products."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parley.llm.arrays import SPACES, flat, words
from parley.llm.chunks import entries, give_back, look_up, numbered, pack, spread, sums, unpack
from parley.session import materialize, scratch_path

#: The commonest tokens are classes of their own; all others share classes by a hash of their last bytes.
HEAD, TAILS, SUFFIX = 256, 768, 2
CLASSES = HEAD + TAILS
#: Numbers in a class's vectors, tokens of a training step, noise classes of a step.
DIMENSIONS, STEP, NOISE = 16, 2_048, 64
#: First size of a step, and what the squared slopes begin with.
RATE, DAMP = 0.3, 1e-3
#: Each chunk teaches in one of so many rounds; after each, the tasks' models are averaged.
ROUNDS = 4
#: Values in one row of a model that travels.
_BLOCK = 4_096
#: The class before the first token of a text.
_START = CLASSES


def _lowered(data: np.ndarray) -> np.ndarray:
    return data + np.uint8(32) * ((data >= ord("A")) & (data <= ord("Z"))).astype(np.uint8)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Token numbers of all texts, offsets of the texts in them, and the tokens by number.

    Tokens are words between ASCII white space, A-Z lower-cased, then one end for each text: the empty token, number 0.
    """
    data, offsets = flat(texts)
    data = _lowered(data)
    starts, ends = words(data, offsets)
    joined = data[~SPACES[data]]
    at = np.r_[0, np.cumsum(ends - starts)]
    found = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(joined))]
    ).dictionary_encode()
    first = np.searchsorted(starts, offsets)
    numbers = np.insert(found.indices.to_numpy().astype(np.int64) + 1, first[1:], 0)
    names = pa.concat_arrays([pa.array([b""], pa.large_binary()), found.dictionary]).cast(pa.binary())
    return numbers, first + np.arange(len(first)), names


@dataclass
class Net:
    """Vectors of the class one and two tokens before, of the next class, and the next class's bias; squares of their slopes."""

    values: list[np.ndarray]
    squares: list[np.ndarray]

    @classmethod
    def new(cls, share: np.ndarray, seed: int = 11) -> Net:
        """Small random vectors; biases are the classes' log shares, so the model begins as their unigram model."""
        rng = np.random.default_rng(seed)
        shapes = [(CLASSES + 1, DIMENSIONS), (CLASSES + 1, DIMENSIONS), (CLASSES, DIMENSIONS)]
        values = [(0.1 * rng.standard_normal(s)).astype(np.float32) for s in shapes]
        values.append(np.log(np.maximum(share, 1e-26)).astype(np.float32))
        return cls(values, [np.full(v.shape, DAMP, np.float32) for v in values])

    def packed(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in [*self.values, *self.squares]])

    @classmethod
    def unpacked(cls, flat_values: np.ndarray) -> Net:
        shapes = [(CLASSES + 1, DIMENSIONS), (CLASSES + 1, DIMENSIONS), (CLASSES, DIMENSIONS), (CLASSES,)]
        out, at = [], 0
        for shape in shapes * 2:
            n = int(np.prod(shape))
            out.append(np.array(flat_values[at : at + n], np.float32).reshape(shape))
            at += n
        return cls(out[:4], out[4:])

    def _move(self, i: int, rows: np.ndarray, slopes: np.ndarray) -> None:
        """A step against the summed slopes of some rows, each shorter where slopes have been large."""
        order = np.argsort(rows.astype(np.uint16), kind="stable")
        ordered = rows[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        row, slope = ordered[first], np.add.reduceat(slopes[order], first, axis=0)
        self.squares[i][row] += slope * slope
        self.values[i][row] -= RATE * slope / np.sqrt(self.squares[i][row])

    def teach(self, two: np.ndarray, one: np.ndarray, after: np.ndarray, noise: np.ndarray, log_share: np.ndarray) -> None:
        """One step of noise-contrastive estimation: tell the classes that followed from ``noise`` classes, the same for all rows."""
        left, far, right, bias = self.values
        k = (np.log(len(noise)) + log_share).astype(np.float32)
        context = left[one] + far[two]
        true = np.einsum("ij,ij->i", context, right[after]) + bias[after] - k[after]
        other = context @ right[noise].T + (bias[noise] - k[noise])
        up = -1.0 / (1.0 + np.exp(np.clip(true, -30, 30)))
        down = 1.0 / (1.0 + np.exp(np.clip(-other, -30, 30)))
        scale = np.float32(1.0 / len(after))
        up, down = up * scale, down * scale
        back = up[:, None] * right[after] + down @ right[noise]
        rows = np.r_[after, noise]
        self._move(2, rows, np.r_[up[:, None] * context, down.T @ context])
        self._move(3, rows, np.r_[up, down.sum(axis=0)])
        self._move(0, one, back)
        self._move(1, two, back)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log probability of class w after classes b, a (a last): ``near[a, w] + far[b, w] - total[a, b]``.

        A context's vector is a sum, so the sum over all classes is a product of matrices: exp(near) exp(far)^T.
        """
        left, far, right, bias = (v.astype(np.float64) for v in self.values)
        near, away = left @ right.T + bias, far @ right.T
        top, most = near.max(axis=1, keepdims=True), away.max(axis=1, keepdims=True)
        total = np.log(np.exp(near - top) @ np.exp(away - most).T) + top + most.T
        return near.astype(np.float32), away.astype(np.float32), total.astype(np.float32)


def contexts(classes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes two and one tokens before each token; a start class stands before a text."""
    start = np.array([_START, _START], classes.dtype)
    one, two = np.r_[start[:1], classes[:-1]], np.r_[start, classes[:-2]][: len(classes)]
    begins = offsets[:-1][np.diff(offsets) > 0]
    one[begins] = two[begins] = _START
    second = begins + 1
    two[second[second < len(classes)]] = _START
    return two, one


def _chunked(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, batch in numbered(batches, 1):
            found, at, names = tokens(batch.column(1))
            trains = batch.column(2).fill_null(False).to_numpy(zero_copy_only=False)
            n = np.bincount(found[np.repeat(trains, np.diff(at))], minlength=len(names))
            row = [
                pa.array([number], pa.int64()),
                pa.array([batch.column(0)], pa.list_(batch.column(0).type)),
                pa.array([trains], pa.list_(pa.bool_())),
                *(pa.array([pack(x)], pa.binary()) for x in (at, found)),
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                pa.array([n], pa.list_(pa.int64())),
            ]
            yield pa.record_batch(row, ["chunk", "keys", "trains", "at", "tokens", "word", "n"])

    schema = f"chunk long, keys array<{kind}>, trains array<boolean>, at binary, tokens binary, word array<binary>, n array<long>"
    return run, schema


def tail(word: Column) -> Column:
    """The shared class of a token that is not among the commonest."""
    return F.lit(HEAD) + F.crc32(F.substring(word, -SUFFIX, SUFFIX)) % TAILS


def token_counts(chunks: DataFrame) -> DataFrame:
    """Columns ``word``, ``count`` and ``class`` of all tokens, counted in training texts; the commonest have classes of their own."""
    counts = entries(chunks, ["word", "n"]).groupBy("word").agg(F.sum("n").alias("count"))
    counts = materialize(counts, "token-counts")
    first = counts.where("count > 0").orderBy(F.desc("count"), "word").limit(HEAD)
    place = (F.row_number().over(Window.orderBy(F.desc("count"), "word")) - 1).alias("place")
    own = F.broadcast(first.select("word", place))  # HEAD rows
    of = F.coalesce("place", tail(F.col("word"))).cast("long")
    return counts.join(own, "word", "left").select("word", "count", of.alias("class"))


@dataclass
class Totals:
    """What a training corpus has by class, and in all: tokens and distinct tokens."""

    tokens: np.ndarray
    types: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame) -> Totals:
        out = cls(np.zeros(CLASSES), np.zeros(CLASSES))
        known = counts.where("count > 0")
        for r in known.groupBy("class").agg(F.sum("count").alias("tokens"), F.count("*").alias("types")).collect():
            out.tokens[r["class"]], out.types[r["class"]] = r["tokens"], r["types"]
        return out

    def share(self) -> np.ndarray:
        """Share of each class, shared ones with one unknown token each; classes nothing falls in have none."""
        n = self.tokens + (np.arange(CLASSES) >= HEAD)
        return n / n.sum()

    def within(self, count: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Log10 probability of tokens within their classes, by their counts plus one."""
        total = (self.tokens + self.types + 1)[classes]
        return np.where(classes < HEAD, 0.0, np.log10((count + 1.0) / total))


def _coded(totals: list[list[float]], kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Totals(*map(np.array, totals))
        everything = known.tokens.sum() + known.types.sum() + 1
        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                at, found = unpack(c["at"][r].as_py()), unpack(c["found"][r].as_py())
                words_here = int(found.max()) + 1 if len(found) else 0
                count, classes = np.divmod(spread(c["known"], r, words_here, "told", np.int64), CLASSES)
                values = (count > 0).astype(np.int64), np.log10((count + 1.0) / everything), known.within(count, classes)
                n = [np.diff(at), *(sums(v[found], at) for v in values)]
                number = c["chunk"][r].as_py()
                row = [
                    pa.array([number], pa.int64()),
                    pa.array([zlib.crc32(str(number).encode()) % ROUNDS], pa.int32()),
                    pa.array([c["keys"][r].values], pa.list_(c["keys"].type.value_type)),
                    pa.array([c["trains"][r].values], pa.list_(pa.bool_())),
                    c["at"].slice(r, 1),
                    pa.array([pack(classes[found])], pa.binary()),
                    *(pa.array([x], pa.list_(pa.from_numpy_dtype(x.dtype))) for x in n),
                ]
                names = ["chunk", "round", "keys", "trains", "at", "classes", "n_tokens", "n_known", "base", "within"]
                yield pa.record_batch(row, names)
                give_back()

    schema = (
        f"chunk long, round int, keys array<{kind}>, trains array<boolean>, at binary, classes binary, "
        "n_tokens array<long>, n_known array<long>, base array<double>, within array<double>"
    )
    return run, schema


def _taught(net: bytes, share: bytes, turn: int):
    """A task's own model after its rows, in blocks, each with the tokens it has learnt from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shares = Net.unpacked(np.frombuffer(net, np.float32)), np.frombuffer(share, np.float64)
        log_share, below = np.log(np.maximum(shares, 1e-26)), np.cumsum(shares)
        rng = np.random.default_rng([turn, TaskContext.get().partitionId()])
        seen = 0
        for batch in batches:
            for trains, offsets, packed in zip(*batch.columns, strict=True):
                at, classes = unpack(offsets.as_py()), unpack(packed.as_py()).astype(np.int16)
                two, one = contexts(classes, at)
                some = np.repeat(trains.values.to_numpy(zero_copy_only=False), np.diff(at))
                two, one, classes = two[some], one[some], classes[some]
                for i in range(0, len(classes), STEP):
                    noise = np.minimum(np.searchsorted(below, rng.random(NOISE) * below[-1], "right"), CLASSES - 1)
                    own.teach(two[i : i + STEP], one[i : i + STEP], classes[i : i + STEP], noise, log_share)
                seen += len(classes)
                give_back()
        if seen:
            flat_values = own.packed()
            parts = [flat_values[i : i + _BLOCK].tobytes() for i in range(0, len(flat_values), _BLOCK)]
            columns = [pa.array(np.arange(len(parts))), pa.array(np.full(len(parts), float(seen))), pa.array(parts, pa.binary())]
            yield pa.record_batch(columns, ["block", "weight", "part"])

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of models, as many as come in, as their weighted sum; one block of each is held at a time."""
    total: dict[int, list] = {}
    for batch in batches:
        for block, weight, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held = total.setdefault(block, [0.0, 0.0])
            held[0] += weight
            held[1] = held[1] + weight * np.frombuffer(part, np.float32).astype(np.float64)
    for block, (weight, part) in total.items():
        columns = [pa.array([block], pa.int64()), pa.array([weight]), pa.array([part.tobytes()], pa.binary())]
        yield pa.record_batch(columns, ["block", "weight", "part"])


def train(coded: DataFrame, share: np.ndarray, rounds: int = ROUNDS) -> Net:
    """A model taught by every training token once, in rounds; in each, tasks teach copies of it, which are then averaged.

    Tasks' models go through a shuffle in blocks and are summed as they come; the driver gets one model a round.
    """
    net = Net.new(share)
    schema = "block long, weight double, part binary"
    for turn in range(rounds):
        rows = coded.where(F.col("round") == turn).select("trains", "at", "classes")
        models = rows.mapInArrow(_taught(net.packed().tobytes(), share.tobytes(), turn), schema)
        parts = models.repartition(8, "block").mapInArrow(_averaged, schema).collect()  # a row a block
        if parts:
            parts.sort(key=lambda r: r["block"])
            mean = [np.frombuffer(r["part"], np.float64) / r["weight"] for r in parts]
            net = Net.unpacked(np.concatenate(mean).astype(np.float32))
    return net


def _scored(net: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, far, total = Net.unpacked(np.frombuffer(net, np.float32)).tables()
        for batch in batches:
            c = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for r in range(batch.num_rows):
                at, classes = unpack(c["at"][r].as_py()), unpack(c["classes"][r].as_py()).astype(np.int16)
                two, one = contexts(classes, at)
                value = near[one, classes].astype(np.float64)
                value += far[two, classes]
                value -= total[one, two]
                value /= np.log(10)
                score = sums(value, at) + c["within"][r].values.to_numpy()
                counts = [c[x][r].values for x in ("keys", "n_tokens", "n_known", "base")]
                yield pa.record_batch([*counts, pa.array(score)], ["key", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_texts(df: DataFrame, trains: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns key, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` for every row of ``df``.

    Tokens are words, A-Z lower-cased, and an end. Those of rows where ``trains`` holds are counted and teach the model;
    a null there is false. ``base_score`` sums log10 of each token's count plus one over all training tokens, distinct ones and one
    more. ``score`` is log10 of the text's probability: of each token's class after the two before it, by the log-bilinear
    model, times that of the token in its class, by counts plus one, an unknown token having its place in each shared
    class. Both sum to 1 over what may follow. Null and empty texts are one end; repeated rows, rows with null keys and
    further columns change nothing else; without training rows all tokens are unknown.

    Every training token teaches once. Counts of all tokens come back to the texts by chunk dictionary, so the
    vocabulary may be of any size; the model itself is of fixed size.
    """
    spark: SparkSession = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), trains.cast("boolean").alias("trains"))
    run, schema = _chunked(kind)
    chunks = materialize(rows.mapInArrow(run, schema), "tokens")
    counts = token_counts(chunks)
    totals = Totals.of(counts)
    told = counts.select("word", (F.col("count") * CLASSES + F.col("class")).alias("told"))
    joined = look_up(chunks, ["word"], told, ["told"])
    ready = joined.select("chunk", "keys", "trains", "at", F.col("tokens").alias("found"), F.col("found").alias("known"))
    run, schema = _coded([totals.tokens.tolist(), totals.types.tolist()], kind)
    path = scratch_path(spark, "classes")
    coded = ready.mapInArrow(run, schema)
    coded.write.partitionBy("round").parquet(path)
    coded = spark.read.schema(coded.schema).parquet(path)
    net = train(coded, totals.share())
    out = f"key {kind}, n_tokens long, n_known long, base_score double, score double"
    scored = coded.select("keys", "at", "classes", "n_tokens", "n_known", "base", "within").mapInArrow(_scored(net.packed().tobytes()), out)
    total = int(totals.tokens.sum())
    return scored.withColumn("train_tokens", F.lit(total).cast("long")).withColumnRenamed("key", key)
