"""Language identification by cross-parsing: how few phrases of known text build up an unknown one."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.arrays import Shipped
from parley.session import materialize

#: Labelled rows for each language that are learned from, and characters of them all that make up its text.
FIT_ROWS = 400
FIT_CHARS = 20_000
#: A labelled row of at most so many characters comes before longer ones.
FIT_ROW_CHARS = 4_000
#: Leading bits of a key's hash that are counted to find where the chosen rows end.
HASH_BITS = 16
#: A phrase ends at every so many characters at the latest, so that parts of a text are parsed side by side.
SEGMENT = 1_024
#: Characters that are parsed at a time.
PART_CHARS = 1 << 21
#: How sharply the difference in bits a character turns into a score.
SHARPNESS = 12.0

_BREAK = 0x20
#: The class of bytes that a language's text does not have.
_RARE = 0


def _letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters."""
    kinds, at = np.unique(points, return_inverse=True)
    return np.array([chr(p).isalpha() for p in kinds.tolist()], bool)[at]


_LOW = _letters(np.arange(0x250))


def encode(text: str) -> np.ndarray:
    """UTF-8 of a text's lower-cased letters, each run of what is no letter made one blank. No script is left out."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _LOW[np.minimum(points, len(_LOW) - 1)]
    beyond = np.flatnonzero(points >= len(_LOW))
    if len(beyond):
        letter[beyond] = _letters(points[beyond])
    keep = np.ones(len(points), bool)
    keep[1:] = letter[1:] | letter[:-1]
    kept = np.where(letter, points, _BREAK)[keep].astype("<u4")
    return np.frombuffer(kept.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)


def suffix_automaton(text: np.ndarray, width: int) -> np.ndarray:
    """Transitions of the automaton that reads exactly the substrings of a text; -1 where there is none."""
    states = 2 * len(text) + 2
    step = np.full((states, width), -1, np.int32)
    link, length = [-1] * states, [0] * states
    last, used = 0, 1
    for c in text.tolist():
        new, used = used, used + 1
        length[new] = length[last] + 1
        p = last
        while p >= 0 and step[p, c] < 0:
            step[p, c] = new
            p = link[p]
        if p < 0:
            link[new] = 0
        else:
            q = int(step[p, c])
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy, used = used, used + 1
                length[copy], link[copy] = length[p] + 1, link[q]
                step[copy] = step[q]
                while p >= 0 and step[p, c] == q:
                    step[p, c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step[:used]


@dataclass
class Model:
    """Automata of all languages in one table: a state is the place of its row, -1 is no state.

    Each language has classes of its own for the bytes that its text has, and one for all others.
    """

    langs: list[str]
    classes: np.ndarray
    step: np.ndarray
    roots: np.ndarray
    sizes: np.ndarray


def fit(texts: dict[str, list[str]], chars: int = FIT_CHARS) -> Model:
    """A suffix automaton for every language, over at most ``chars`` bytes of its coded texts."""
    langs = sorted(texts)
    steps, roots, sizes, used = [], [], [], 0
    classes = np.full((len(langs), 256), _RARE, np.int32)
    for k, lang in enumerate(langs):
        coded = [np.append(encode(t), np.uint8(_BREAK)) for t in texts[lang]]
        text = np.concatenate(coded)[:chars] if coded else np.zeros(0, np.uint8)
        kinds = np.unique(text)
        classes[k, kinds] = _RARE + 1 + np.arange(len(kinds))
        width = len(kinds) + 1
        step = suffix_automaton(classes[k, text], width)
        steps.append(np.where(step >= 0, step * width + used, -1).astype(np.int32).ravel())
        roots.append(used)
        sizes.append(max(2, len(text)))
        used += step.size
    table = np.concatenate(steps) if steps else np.zeros(0, np.int32)
    return Model(langs, classes, table, np.array(roots, np.int32), np.array(sizes, np.int64))


def phrases(model: Model, coded: list[np.ndarray]) -> np.ndarray:
    """Phrases that every text needs in every language: rows are texts, columns languages.

    A phrase is the longest match of what follows; the byte that ends it
    begins the next one, and one that the language never has is a phrase of its own.
    Segments of all texts are read side by side, the longest first.
    """
    counts = np.zeros((len(coded), len(model.langs)), np.int64)
    owner, start, sizes = [], [], []
    for i, c in enumerate(coded):
        for at in range(0, len(c), SEGMENT):
            owner.append(i)
            start.append(at)
            sizes.append(min(SEGMENT, len(c) - at))
    if not owner:
        return counts
    owners, lengths = np.array(owner), np.array(sizes)
    order = np.argsort(-lengths, kind="stable")
    owners, lengths = owners[order], lengths[order]
    lanes = np.zeros((lengths[0], len(owners)), np.uint8)
    for lane, j in enumerate(order.tolist()):
        lanes[: sizes[j], lane] = coded[owner[j]][start[j] : start[j] + sizes[j]]
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")
    roots = model.roots[:, None]
    state = np.repeat(roots, len(owners), axis=1)
    ended = np.ones(state.shape, np.int32)
    for t, n in enumerate(alive.tolist()):
        c = model.classes[:, lanes[t, :n]]
        now = state[:, :n]
        following = model.step.take(now + c)
        lang, lane = np.nonzero(following < 0)
        if len(lane):
            # A character that is nowhere in the language costs a phrase and leaves none begun.
            root = model.roots[lang]
            again = model.step.take(root + c[lang, lane])
            unknown = again < 0
            ended[lang, lane] += (now[lang, lane] != root).astype(np.int32) + unknown
            following[lang, lane] = np.where(unknown, root, again)
        state[:, :n] = following
    ended -= state == roots
    for k in range(len(roots)):
        counts[:, k] = np.bincount(owners, ended[k], len(coded))
    return counts


def bits_per_char(model: Model, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Cross-parsing entropy: phrases times the bits that point into the language's text, a character."""
    return counts * np.log2(model.sizes)[None, :] / np.maximum(sizes, 1)[:, None]


def predict(model: Model, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and score of every text; ``und`` and 0 for texts without a letter and for a model without languages.

    Of languages with equally many bits the first by name is taken.
    """
    out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
    wanted = [i for i, t in enumerate(texts) if t and model.langs and any(map(str.isalpha, t))]
    at = 0
    while at < len(wanted):
        stop, size = at, 0
        while stop < len(wanted) and (stop == at or size + len(texts[wanted[stop]]) <= PART_CHARS):
            size += len(texts[wanted[stop]])
            stop += 1
        coded = [encode(texts[i]) for i in wanted[at:stop]]
        sizes = np.array([len(c) for c in coded])
        bits = bits_per_char(model, phrases(model, coded), sizes)
        best = bits.argmin(axis=1)
        weights = np.exp2(-SHARPNESS * (bits - bits.min(axis=1, keepdims=True)))
        scores = 1.0 / weights.sum(axis=1)
        for i, b, s in zip(wanted[at:stop], best.tolist(), scores.tolist(), strict=True):
            out[i] = (model.langs[b], s if math.isfinite(s) else 0.0)
        at = stop
    return out


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = FIT_ROWS) -> Model:
    """Fit on at most ``rows`` labelled rows of each language, chosen by a hash of the key.

    Rows of usual length (``FIT_ROW_CHARS``) come first; a null label, text or key and empty texts
    teach nothing; rows equal in label, key and text teach once. Keys are chosen before any text moves: rows are counted by the leading bits of
    their hash, so that only those up to the bits of the last chosen row are put in order. The driver
    gets the texts of the chosen rows, no more than the model can use.
    """
    known = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    known = known.where("lang IS NOT NULL AND key IS NOT NULL AND length(text) > 0")
    known = known.withColumn("mark", F.xxhash64("text"))
    long = F.col("n") > FIT_ROW_CHARS
    # One row a text of a key, however often it is repeated; counted where the rows are before it moves.
    sized = known.groupBy("lang", "key", "mark").agg(F.min(F.length("text")).alias("n"))
    sized = sized.select("lang", "key", "mark", "n", long.alias("long"), F.xxhash64("key", F.lit(11)).alias("hash"))
    sized = materialize(sized, "labelled")
    # Ordered like (long, hash), in 2 ** (HASH_BITS + 1) steps.
    step = F.shiftright("hash", 64 - HASH_BITS) + F.when(F.col("long"), F.lit(1 << HASH_BITS)).otherwise(F.lit(0))
    counted = sized.groupBy("lang", step.alias("step")).agg(F.count(F.lit(1)).alias("rows"))
    so_far = F.sum("rows").over(Window.partitionBy("lang").orderBy("step").rowsBetween(Window.unboundedPreceding, 0))
    before = counted.withColumn("earlier", so_far - F.col("rows")).where(F.col("earlier") < rows)
    # One row a language, of which the model holds an automaton each.
    last = F.broadcast(before.groupBy("lang").agg(F.max("step").alias("last")))
    first = sized.join(last, "lang").where(step <= F.col("last"))
    order = Window.partitionBy("lang").orderBy("long", "hash", "key", "mark")
    chosen = (
        first.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= rows)
        .withColumn("before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
        .where(F.col("before") < 2 * FIT_CHARS)
    )
    # At most ``rows`` texts a language, one row of each.
    found = known.join(F.broadcast(chosen.select("lang", "key", "mark", "place")), ["lang", "key", "mark"])
    found = found.groupBy("lang", "place").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for r in sorted(found.select("lang", "place", "text").collect(), key=lambda r: (r["lang"], r["place"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    return fit(texts)


def identify(df: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Columns key, ``lang_pred`` and ``score``, from the whole text of every row; no shuffle."""
    shared = Shipped(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = predict(shared.value, batch.column(1).to_pylist())
            langs, scores = zip(*found, strict=True) if found else ((), ())
            columns = [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.record_batch(columns, ["key", "lang_pred", "score"])

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)
