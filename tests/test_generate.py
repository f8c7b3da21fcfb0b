from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from parley.operators.evaluate import evaluate_loss
from parley.operators.generate import (
    chat_history,
    compare_markdown,
    compare_runs,
    generate,
    generation_benchmark,
    write_comparison,
)
from parley.session import scratch_path


def shout():
    return lambda messages, limit: f"{messages[-1]['content']}!{limit} "


def chat():
    return lambda messages, limit: [*messages, {"role": "assistant", "content": f" {len(messages)} said"}]


@pytest.fixture
def prompts(spark):
    return spark.createDataFrame([(1, "one two"), (2, "three")], "ord int, prompt string")


def test_generate(prompts):
    got = generate(prompts, shout, max_new_tokens=7, partitions=2)
    assert got.columns == ["ord", "prompt", "latency_sec", "reply"]
    assert sorted(r["reply"] for r in got.collect()) == ["one two!7", "three!7"]


def test_generate_from_messages(spark):
    df = spark.createDataFrame([([("user", "a"), ("assistant", "b"), ("user", "c")],)], "m array<struct<role:string,content:string>>")
    assert generate(df, chat, prompt="m").first()["reply"] == "3 said"


def test_generation_benchmark(spark):
    df = spark.createDataFrame([("p", "a b c", 0.0), ("q", "a b", 0.5)], "prompt string, reply string, latency_sec double")
    got = {r["prompt"]: tuple(r)[1:] for r in generation_benchmark(df).collect()}
    assert got == {"p": (0.0, 3, pytest.approx(3e6)), "q": (0.5, 2, 4.0)}


def test_comparison(spark, prompts):
    runs = compare_runs(generate(prompts, shout), generate(prompts, chat))
    assert sorted(map(tuple, runs.collect())) == [(1, "one two", "one two!256", "1 said"), (2, "three", "three!256", "1 said")]
    path = scratch_path(spark, "comparison")
    write_comparison(runs, path)
    import glob

    text = "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))
    assert text == (
        "# Compare Before/After\n\n"
        "## Case 1\n\n**Prompt**\n\none two\n\n**Base**\n\none two!256\n\n**Tuned**\n\n1 said\n\n"
        "## Case 2\n\n**Prompt**\n\nthree\n\n**Base**\n\nthree!256\n\n**Tuned**\n\n1 said\n\n"
    )
    assert compare_markdown(runs).count() == 3


def test_chat_history(spark):
    rows = [
        (1, 0, "user", " hi "),
        (1, 1, "assistant", "hello\n"),
        (1, 2, "user", "bye"),
        (2, 0, "system", "own"),
        (2, 1, "user", "a"),
        (2, 2, "assistant", "b"),
        (2, 3, "user", "　"),
        (2, 4, "assistant", "c"),
        (2, 5, "user", "late"),
        (3, 0, "user", None),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {(r["conv_id"], r["turn"]): [tuple(m) for m in r["messages"]] for r in chat_history(df, system="sys").collect()}
    assert got == {
        (1, 0): [("system", "sys"), ("user", "hi")],
        (1, 2): [("system", "sys"), ("user", "hi"), ("assistant", "hello"), ("user", "bye")],
        (2, 1): [("system", "own"), ("user", "a")],
    }
    compact = chat_history(df, system="sys", compact=True).collect()
    cut = {(r["conv_id"], p["turn"]): [tuple(m) for m in r["messages"][: p["upto"]]] for r in compact for p in r["points"]}
    assert cut == got and sorted(r["conv_id"] for r in compact) == [1, 2]


def test_evaluate_loss(spark):
    df = spark.createDataFrame([([1, 2, 3],), ([5],)], "input_ids array<int>")
    got = evaluate_loss(df, lambda: lambda rows: [float(len(ids)) for ids in rows]).first()
    assert (got["rows"], got["loss"]) == (2, 2.0) and got["perplexity"] == pytest.approx(math.exp(2))
    column = evaluate_loss(df, F.size("input_ids") * 100.0).first()
    assert column["loss"] == 200.0 and column["perplexity"] == math.inf
    assert evaluate_loss(df.limit(0), F.lit(1.0)).first()["perplexity"] == math.inf
