"""The log-bilinear model: counts and base scores against plain versions, probabilities that sum to one, held-out gain."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parley.llm import lblm
from parley.llm.queries import op13_lblm


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")), ""]


def plain(docs):
    counts = Counter(w for _, text, trains in docs if trains for w in words(text))
    n, v = counts.total(), len(counts)
    out = []
    for key, text, _ in docs:
        w = words(text)
        out.append((key, len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def held(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    return [(d["doc_id"], d["text"], zlib.crc32(str(d["doc_id"]).encode()) % 7 != 2) for d in docs]


def test_counts_and_base_scores_of_the_query(spark, sf_dir):
    rows = op13_lblm(spark, sf_dir).collect()
    docs = held(spark, sf_dir)
    found = ordered((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows)
    want = ordered(plain(docs))
    assert [f[:4] for f in found] == [w[:4] for w in want]
    assert np.allclose([f[4] for f in found], [w[4] for w in want], rtol=1e-9)
    assert {r["doc_id"] for r in rows if r["held_out"]} == {d[0] for d in docs if not d[2]}


def test_the_model_beats_the_base_on_held_out_texts(spark, sf_dir):
    rows = [r for r in op13_lblm(spark, sf_dir.replace("sf0.001", "sf0.01")).collect() if r["held_out"]]
    n = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] - r["base_score"] for r in rows) / n > 0.1  # log10 a token


def test_odd_rows_and_empty_tables(spark):
    docs = [(1, "A b\tc", True), (1, "a B c", True), (None, "a", False), (2, None, True), (3, "", False), (4, "zz " * 100_000, True)]
    schema = "doc_id long, text string, trains boolean, tokens string, count string"
    df = spark.createDataFrame([(*d, "x", "y") for d in docs] + [(5, "a", None, None, None)], schema).repartition(3)
    rows = lblm.score_texts(df, F.col("trains")).collect()
    found = ordered((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows)
    for f, w in zip(found, ordered(plain([*docs, (5, "a", False)])), strict=True):
        assert f[:4] == w[:4] and f[4] == pytest.approx(w[4])
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert lblm.score_texts(df.limit(0), F.col("trains")).count() == 0
    assert {r["train_tokens"] for r in lblm.score_texts(df, F.lit(False)).collect()} == {0}


def test_tables_are_those_of_a_plain_softmax():
    net = lblm.Net.new(np.full(lblm.CLASSES, 1 / lblm.CLASSES))
    net.values = [v * 5 for v in net.values]
    near, far, total = net.tables()
    left, back, right, bias = (v.astype(np.float64) for v in net.values)
    for a, b in [(0, 1), (5, lblm.CLASSES), (lblm.CLASSES, lblm.CLASSES), (700, 700)]:
        s = right @ (left[a] + back[b]) + bias
        p = np.exp(s - s.max())
        p /= p.sum()
        found = np.exp(near[a].astype(np.float64) + far[b] - total[a, b])
        assert found.sum() == pytest.approx(1, abs=1e-4) and np.allclose(found, p, atol=1e-6)


def test_the_step_follows_the_slope_of_its_loss():
    share = np.full(lblm.CLASSES, 1 / lblm.CLASSES)
    rng = np.random.default_rng(0)
    two, one, after, noise = (rng.integers(0, 30, n) for n in (40, 40, 40, 9))
    log_share = np.log(share)

    def loss(values):
        left, far, right, bias = values
        s = (left[one] + far[two]) @ right.T + bias - np.log(len(noise)) - log_share
        true, other = s[np.arange(40), after], s[:, noise]
        return (np.log1p(np.exp(-true)).sum() + np.log1p(np.exp(other)).sum()) / 40

    net = lblm.Net.new(share)
    before = [v.astype(np.float64) for v in net.values]
    slopes = []
    net._move = lambda i, rows, s: slopes.append((i, rows, s))
    net.teach(two, one, after, noise, log_share)
    for i, rows, s in slopes:
        total = np.zeros_like(before[i])
        np.add.at(total, rows, s)
        for row in rows[:3]:
            at = (row,) if total.ndim == 1 else (row, 2)
            moved = [v.copy() for v in before]
            moved[i][at] += 1e-4
            assert (loss(moved) - loss(before)) / 1e-4 == pytest.approx(total[at], abs=1e-4)


def test_contexts_begin_anew_in_each_text():
    two, one = lblm.contexts(np.array([1, 2, 3, 4, 5]), np.array([0, 1, 1, 5]))
    s = lblm.CLASSES
    assert one.tolist() == [s, s, 2, 3, 4] and two.tolist() == [s, s, s, 2, 3]


def test_classes_of_words_do_not_depend_on_the_chunk():
    found, at, names = lblm.tokens(pa.array(["B a", None, "a"]))
    names = names.to_pylist()
    assert [names[i] for i in found] == [b"b", b"a", b"", b"", b"a", b""] and at.tolist() == [0, 3, 4, 6]


def test_shared_classes_go_by_the_last_bytes(spark):
    names = [b"", b"a", b"ba", b"xyz", "Äé".encode()]
    rows = spark.createDataFrame([(w,) for w in names], "w binary").select("w", lblm.tail(F.col("w")).alias("c")).collect()
    assert all(r["c"] == lblm.HEAD + zlib.crc32(bytes(r["w"])[-lblm.SUFFIX :]) % lblm.TAILS for r in rows) and len(rows) == 5
