from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from parley.operators.evaluate import evaluate_loss
from parley.operators.unigram import fit_unigram, unigram_losses


def losses(train, rows):
    counts = Counter(t for r in train for t in r or [] if t is not None)
    everything = counts.total() + len(counts) + 1
    out = []
    for r in rows:
        told = [math.log(everything / (counts[t] + 1)) for t in r or [] if t is not None]
        out.append((len(told), sum(told) / len(told) if told else None))
    return out


def frame(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "id long, tokens array<string>").repartition(5)


def scored(df, model):
    return [(r["n_tokens"], r["loss"]) for r in sorted(unigram_losses(df, model, keep=["id"]).collect())]


def test_a_token_in_half_of_all_places(spark):
    train = [["hot", f"w{i % 700}"] for i in range(3000)] + [None, [], [None, "x"]]
    rows = [["hot"] * 40 + [f"w{i}", "never seen"] for i in range(900)] + [[], None, ["never"], [None]]
    model = fit_unigram(frame(spark, train))
    assert (model.tokens, model.types) == (6001, 702)
    assert {"hot"} <= {r["token"] for r in model.common().collect()}
    found = scored(frame(spark, rows), model)
    for f, w in zip(found, losses(train, rows), strict=True):
        assert f[0] == w[0] and f[1] == (None if w[1] is None else pytest.approx(w[1]))


def test_the_common_tokens_are_joined_where_the_rows_are(spark):
    rare = [[f"w{i}", f"v{i}"] for i in range(5000)]
    model = fit_unigram(frame(spark, [["hot"] * 4, *rare]))
    assert [r["token"] for r in model.common().collect()] == ["hot"]
    steps = unigram_losses(frame(spark, rare), model)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in steps and "BroadcastNestedLoopJoin" not in steps and "CartesianProduct" not in steps


def test_without_training_rows_every_token_is_unknown(spark):
    none = frame(spark, [["a"]]).limit(0)
    model = fit_unigram(none)
    assert scored(frame(spark, [["a", "b"], []]), model) == [(2, 0.0), (0, None)]
    assert unigram_losses(none, model).count() == 0


def test_equal_rows_count_each(spark):
    df = spark.createDataFrame([("s", ["a"])] * 7, "split string, tokens array<string>")
    found = unigram_losses(df, fit_unigram(df), keep=["split"])
    assert found.count() == 7
    row = evaluate_loss(found, F.col("loss"), by=["split"]).first()
    assert row["rows"] == 7 and row["loss"] == pytest.approx(math.log(9 / 8))
