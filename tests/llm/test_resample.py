"""Importance resampling: CRCs of spans, features and the draw, against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from parley.llm import resample

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def buckets(text):
    w = words(text)
    return [zlib.crc32(x.encode()) % 10_000 for x in [*w, *(" ".join(p) for p in zip(w, w[1:], strict=False))]]


def plain(docs, target):
    source, aim = (Counter(b for t in texts for b in buckets(t)) for texts in ([t for _, t in docs], target))
    gain = {
        b: math.floor(1000 * math.log((aim[b] + 1) * (source.total() + 10_000) / ((source[b] + 1) * (aim.total() + 10_000))))
        for b in source
    }
    rows = []
    for key, text in docs:
        found = buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(words(text))])
    may = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(may[: 25 * len(may) // 100], 1):
        r[4] = place
    return [tuple(r[:5]) for r in rows]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def drawn(df, target):
    return ordered(tuple(r) for r in resample.resample(df, target).drop("n_words").collect())


@given(st.binary(max_size=400), st.data())
@settings(max_examples=60, deadline=None)
def test_spans_have_their_own_crc(data, draw):
    prefix = resample.running(np.frombuffer(data, np.uint8))
    ends = sorted(draw.draw(st.lists(st.integers(0, len(data)), min_size=2, max_size=2)))
    found = resample.spans_crc(prefix, np.array(ends[:1]), np.array(ends[1:]))
    assert len(prefix) == len(data) + 1 and int(found[0]) == zlib.crc32(data[ends[0] : ends[1]])


@given(st.lists(st.none() | st.text(alphabet="aZ é1-.\x7f{`日\n", max_size=30), max_size=8))
@settings(max_examples=80, deadline=None)
def test_features_are_runs_of_words(texts):
    if texts:
        ((found, at, n),) = resample.features(pa.array(texts, pa.string()))
        assert [sorted(found[a:b].tolist()) for a, b in zip(at, at[1:], strict=False)] == [sorted(buckets(t)) for t in texts]
        assert n.tolist() == [len(words(t)) for t in texts]


def test_the_draw_equals_the_plain_version(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"Wort{i}" for i in range(40)] + ["und", "é", "a-b"]
    docs = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(400)]
    docs += [(7, docs[0][1]), (None, "x " * 30), (None, None), (500, ""), (501, None), (502, "long word " * 50_000)]
    target = [" ".join(vocabulary[:9] * 3), None, ""]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, weight int").repartition(6)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    assert drawn(df, aim) == ordered(plain(docs, target))


def test_equal_rows_have_ranks_of_their_own(spark):
    df = spark.createDataFrame([(1, "w " * 25)] * 900 + [(2, "v " * 25)] * 100, "doc_id long, text string").repartition(5)
    rows = resample.resample(df, df).collect()
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 251))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resample.resample(none, some).count() == 0
    assert {r["rank"] for r in resample.resample(some, none).collect()} == {None}


def test_places_in_an_order(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000).repartition(7).select((F.col("id") * 37 % 1000).alias("v"))
    found = resample.ranked(df, [F.col("v")], "place").collect()
    assert all(r["place"] == r["v"] + 1 for r in found)
