from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.operators.profile import (
    dataset_stats,
    length_counts,
    length_histogram,
    length_stats,
    preview,
    token_stats,
)
from parley.operators.sft import tokenize_sft, training_plan


def histogram(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    rows = length_histogram(df, ["n"], bins).orderBy("bin").collect()
    return [r["rows"] for r in rows], [r["bin_low"] for r in rows]


@pytest.mark.parametrize(
    ("values", "bins"),
    [
        (list(range(11)), 5),
        ([3, 3, 3], 50),
        (list(range(0, 37)), 50),
        (list(range(10, 31)), 50),
        ([1, 1000, 7, 7, 500, 999], 7),
        ([0, 7], 3),
        ([int(x) for x in np.random.default_rng(1).lognormal(5, 1, 2000)], 50),
    ],
)
def test_histogram_is_numpys(spark, values, bins):
    counts, edges = np.histogram(np.asarray(values, dtype=np.int64), bins=bins)
    got, low = histogram(spark, values, bins)
    assert got == counts.tolist()
    assert low == pytest.approx(edges[:-1].tolist())


def test_histogram_of_nothing(spark):
    assert histogram(spark, [None], 5) == ([], [])


def test_length_stats(spark):
    df = spark.createDataFrame([(1,), (2,), (10,), (None,)], "token_length bigint")
    got = length_stats(df).first()
    assert got["seen"] == 4 and got["kept"] == 3 and got["count"] == 3
    assert (got["min"], got["max"]) == (1, 10)
    assert got["p95"] == pytest.approx(9.2) and got["mean"] == pytest.approx(13 / 3)


def test_stats_of_nothing(spark):
    df = spark.createDataFrame([], "token_length bigint")
    assert tuple(length_stats(df).first()) == (0, 0, 0, None, None, None, None)


def test_percentile_is_numpys(spark):
    values = np.random.default_rng(2).integers(0, 500, 3001)
    df = spark.createDataFrame([(int(v),) for v in values], "token_length bigint").repartition(6)
    assert length_stats(df).first()["p95"] == pytest.approx(np.percentile(values, 95))


def test_token_stats_counts_rows_without_messages(spark):
    rows = [("train", i, f"word {i}" if i % 3 else " ") for i in range(30)]
    df = spark.createDataFrame(rows, "split string, id bigint, text string")
    got = token_stats(df, max_rows=10, order_by=["id"]).first()
    assert (got["seen"], got["kept"]) == (10, 6)


def test_dataset_stats_and_preview(spark):
    df = spark.createDataFrame(
        [("a", i, f"t{i}", [1], None) for i in range(5)] + [("b", 9, "x", [1], None)],
        "split string, id bigint, text string, tags array<int>, score double",
    )
    rows = {r["split"]: r for r in dataset_stats(df).collect()}
    assert rows["a"]["rows"] == 5 and rows["b"]["columns"] == ["id", "text", "tags", "score"]
    assert rows["a"]["string_columns"] == ["text"]
    assert rows["a"]["column_types"] == {"int": 1, "str": 1, "list": 1, "float": 1}
    shown = preview(df, columns=2, order_by=["id"])
    assert shown.columns == ["split", "id", "text"]
    assert sorted(map(tuple, shown.collect())) == [("a", 0, "t0"), ("a", 1, "t1"), ("a", 2, "t2"), ("b", 9, "x")]
    hidden = preview(df, columns=1, order_by=["score", "id"])
    assert hidden.columns == ["split", "id"]


def test_length_counts(spark):
    df = spark.createDataFrame([(1, 2), (3, None)], "char_length bigint, token_length bigint")
    assert tuple(length_counts(df).first()) == (2, 1)


@pytest.mark.parametrize(("rows", "plan"), [(1000, (125, 125, 3)), (0, (1, 1, 0)), (8, (1, 1, 0))])
def test_training_plan(spark, rows, plan):
    df = spark.range(rows).withColumn("split", F.lit("train")).unionByName(spark.range(3).withColumn("split", F.lit("test")))
    got = training_plan(df).first()
    assert got["train_rows"] == rows
    assert (got["steps_per_epoch"], got["total_steps"], got["warmup_steps"]) == plan


def test_tokenize_sft(spark):
    df = spark.createDataFrame([("train", 1, "abcd"), ("train", 2, "ab"), ("train", 3, "")], "split string, id int, text string")
    got = {r["id"]: r for r in tokenize_sft(df, max_length=3, keep=["id"]).collect()}
    assert got[1]["input_ids"] == got[1]["labels"] == [97, 98, 99] and got[1]["was_truncated"]
    assert got[2]["input_ids"] == [97, 98] and not got[2]["was_truncated"]
    assert got[3]["input_ids"] == [] and not got[3]["was_truncated"]
