from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.functions.messages import row_key
from parley.operators.clean import (
    clean_counts,
    convert_chat,
    normalize_rows,
    observe_rows,
    remove_duplicates,
    remove_null,
    stage_counts,
)

CHAT = "array<struct<role:string,content:string>>"


def test_remove_null(spark):
    rows = [(0, [("user", "x")]), (1, None), (2, []), (3, [("user", " ​　")]), (4, [None, ("npc", "y")])]
    df = spark.createDataFrame(rows, f"id int, messages {CHAT}")
    assert {r["id"] for r in remove_null(df).collect()} == {0, 4}


def test_normalize_rows(spark):
    schema = f"id int, note string, messages {CHAT}, conversations array<struct<from:string,value:string,n:int>>, other array<string>"
    rows = [
        (1, " Ａ\tb ", [("ＮＰＣ ", " c\t\td"), None], [("Ｘ", "﻿v", 3), ("y", None, 4)], [" k "]),
        (2, None, None, None, None),
    ]
    got = normalize_rows(spark.createDataFrame(rows, schema)).orderBy("id").collect()
    assert got[0]["note"] == "A b"
    assert [tuple(m) for m in got[0]["messages"]] == [("ＮＰＣ ", "c d")]
    assert [tuple(m) for m in got[0]["conversations"]] == [("Ｘ", "v", 3), ("y", None, 4)]
    assert got[0]["other"] == [" k "]
    assert tuple(got[1]) == (2, None, None, None, None)


def test_normalize_rows_is_idempotent_on_the_documents(spark, sf_dir):
    once = normalize_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert normalize_rows(once).exceptAll(once).isEmpty()


def brute_force_first(rows):
    seen, kept = set(), []
    for split, i, text in sorted(rows, key=lambda r: r[1]):
        key = (split, " ".join(text.split()))
        if key not in seen:
            seen.add(key)
            kept.append(i)
    return kept


@pytest.fixture(scope="module")
def repeated():
    # A third of all rows share one text.
    return [
        ("train" if i % 4 else "test", i, "the  same\ttext" if i % 3 == 0 else f"text {i % 50}{' ' * (i % 2)} end")
        for i in range(3000)
    ]


@pytest.mark.parametrize("partitions", [1, 7])
def test_remove_duplicates_keeps_the_first(spark, repeated, partitions):
    df = spark.createDataFrame(repeated, "split string, id int, text string").repartition(partitions)
    got = remove_duplicates(df, order_by=["id"])
    assert sorted(r["id"] for r in got.collect()) == brute_force_first(repeated)
    overall = remove_duplicates(df, order_by=["id"], scope="global")
    expected = brute_force_first([("all", i, t) for _, i, t in repeated])
    assert sorted(r["id"] for r in overall.collect()) == expected


def test_rows_without_messages_fall_back_to_their_columns(spark):
    rows = [(0, "a", "b c"), (1, "a", "b  c"), (2, "a", None), (3, "a", " ")]
    df = spark.createDataFrame(rows, "id int, name string, note string")
    assert sorted(r["id"] for r in remove_duplicates(df, order_by=["id"]).collect()) == [0, 2]
    keys = [r[0] for r in df.select(row_key(df), "id").orderBy("id").collect()]
    assert keys[0] == keys[1] != keys[2] == keys[3]


def test_unknown_scope(spark):
    with pytest.raises(ValueError, match="scope"):
        remove_duplicates(spark.range(1), order_by=["id"], scope="other")


def test_convert_chat(spark):
    schema = f"id int, messages {CHAT}, note string, score double, flag boolean, tags array<int>, text string"
    chat = [("user", "q"), ("assistant", "a")]
    rows = [(1, chat, "n", 0.5, True, [1], "t"), (2, chat[:1], "n", 0.5, True, [1], "t")]
    df = spark.createDataFrame(rows, schema)
    assert convert_chat(df).columns == ["messages"]
    assert convert_chat(df, keep=["id"]).columns == ["id", "messages"]
    kept = convert_chat(df, keep_other_fields=True)
    assert kept.columns == ["id", "note", "score", "flag", "messages"]
    assert [r["id"] for r in kept.collect()] == [1]


def test_stage_counts_and_observations(spark):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 3, "test").otherwise("train"))
    few = df.where("id % 2 = 0")
    rows = stage_counts({"all": df, "even": few}).collect()
    assert {(r["step"], r["stage"], r["split"], r["rows"]) for r in rows} == {
        (0, "all", "test", 3),
        (0, "all", "train", 7),
        (1, "even", "test", 2),
        (1, "even", "train", 3),
    }
    seen_df, seen = observe_rows(few, "even", ["train", "test"])
    seen_df.collect()
    assert seen.get == {"rows": 5, "rows_train": 3, "rows_test": 2}


def test_counts_of_one_pass_are_those_of_the_stages(spark):
    chat = "messages array<struct<role:string,content:string>>, split string, id int, note string"
    hello, answer = ("user", "hello"), ("assistant", "ｙｅｓ  sir")
    rows = [([hello, answer], "a", i, "n") for i in range(40)]
    rows += [([hello, ("assistant", "yes sir")], "b", 50, None), ([hello], "b", 51, None), ([hello], "b", 52, "x")]
    rows += [(None, "c", 60, "kept"), ([("user", " ")], "c", 61, ""), ([("user", None)], None, 62, None), ([answer], None, 63, None)]
    df = spark.createDataFrame(rows, chat)
    filled = remove_null(df)
    unique = remove_duplicates(normalize_rows(filled), ["id"])
    stages = {"raw": df, "no_null": filled, "normalized": normalize_rows(filled), "deduplicated": unique, "chat": convert_chat(unique)}
    wanted = {tuple(r) for r in stage_counts(stages).collect()}
    counted = clean_counts(df)
    steps = counted._jdf.queryExecution().executedPlan().toString()
    got = {tuple(r) for r in counted.collect()}
    assert {r for r in got if r[3]} == wanted and len(got) == 20
    assert steps.count("Scan ExistingRDD") == 1 and "Union" not in steps
    assert clean_counts(df.limit(0)).collect() == []
