from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.operators.generate import chat_history
from parley.operators.runs import chat_runs, fold_runs, rejected_turns, unfold_runs

SCHEMA = "conv_id long, turn long, role string, text string"


def talk(spark, rows, parts=6):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def half(spark):
    """One conversation has half of all turns; some are blank; one ends early, one begins with a system turn."""
    rows = [(7, i, ("user", "assistant")[i % 2], f"turn {i} " + "x" * (i % 50)) for i in range(1500)]
    rows += [(c, i, ("system", "user", "assistant")[i % 3], "" if c % 5 == 0 and i == 4 else f" {c}:{i}\n") for c in range(100, 400) for i in range(5)]
    return talk(spark, rows).persist()


def test_a_conversation_of_half_of_all_turns_spreads_over_tasks(spark, half):
    runs = fold_runs(half, "conv_id", "turn", {"turn": "given", "role": "role", "text": "content"}, run_bytes=2000)
    rows = runs.withColumn("n", F.size("turns")).select("conv_id", "run", "before", "n").collect()
    hot = sorted((r["run"], r["before"], r["n"]) for r in rows if r["conv_id"] == 7)
    assert [r[0] for r in hot] == list(range(len(hot))) and len(hot) > 20
    assert [r[1] for r in hot] == [sum(x[2] for x in hot[:i]) for i in range(len(hot))]
    assert max(r["n"] for r in rows) < 120
    got = sorted(tuple(r) for r in unfold_runs(runs, turn="place").select("conv_id", "place", "given", "role", "content").collect())
    assert got == sorted((r[0], r[1], *r[1:]) for r in half.collect())


def test_no_task_packs_the_whole_conversation(spark, half):
    steps = fold_runs(half, "conv_id", "turn", {"text": "content"})._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in steps and "Aggregate" not in steps


@pytest.mark.parametrize("run_bytes", [1, 300, 1 << 20])
def test_histories_over_runs_are_those_of_whole_conversations(spark, half, run_bytes):
    whole = {
        r["conv_id"]: ([tuple(m) for m in r["messages"]], [tuple(p) for p in r["points"]])
        for r in chat_history(half, compact=True).collect()
    }
    found: dict = {}
    for r in sorted(chat_runs(half, run_bytes=run_bytes).collect(), key=lambda r: (r["conv_id"], r["run"])):
        messages, points = found.setdefault(r["conv_id"], ([], []))
        assert r["first"] == len(messages) + 1 or not r["messages"]
        messages += [tuple(m) for m in r["messages"]]
        points += [tuple(p) for p in r["points"]]
    assert {c: v for c, v in found.items() if v[1]} == whole


def test_odd_rows(spark):
    rows = [(None, 1, "user", "lost"), (1, None, "user", "a"), (1, 2, None, None), (1, 2, None, None), (2, 0, "system", None)]
    df = talk(spark, rows, 3).withColumn("other", F.lit(None).cast("long"))
    assert [tuple(r) for r in rejected_turns(df, ["conv_id", "other"]).groupBy("missing").count().orderBy("missing").collect()] == [
        ("conv_id,other", 1),
        ("other", 4),
    ]
    runs = fold_runs(df, "conv_id", "turn", {"role": "role", "text": "content"})
    assert sorted((r["conv_id"], r["run"], len(r["turns"])) for r in runs.collect()) == [(1, 0, 3), (2, 0, 1)]
    assert fold_runs(df.limit(0), "conv_id", "turn", {"role": "role"}).count() == 0
    assert chat_runs(df).count() == 2


def test_equal_turns_go_to_several_tasks(spark):
    df = spark.range(4000).select(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("same").alias("text"))
    runs = fold_runs(df, "conv_id", "turn", {"text": "content"}, run_bytes=500)
    rows = runs.select("run", "before", F.size("turns").alias("n")).orderBy("run").collect()
    assert sum(r["n"] for r in rows) == 4000 and [r["run"] for r in rows] == list(range(len(rows)))


def test_composite_keys(spark):
    df = spark.createDataFrame([("a", 1, i, f"{i}") for i in range(9)] + [("a", 2, 0, "z")], "x string, y long, turn long, text string")
    runs = fold_runs(df, ["x", "y"], "turn", {"text": "content"}, run_bytes=40, sums={"odd": F.col("turn") % 2}, firsts={"start": F.col("text")})
    rows = sorted(tuple(r) for r in runs.collect())
    assert {r[5] for r in rows if r[1] == 1} == {"0"} and rows[-1][:6] == ("a", 2, 0, 0, 0, "z")
    assert [t["content"] for r in rows if r[1] == 1 for t in r[6]] == [str(i) for i in range(9)]
    assert all(r[4] == r[3] // 2 for r in rows if r[1] == 1)
