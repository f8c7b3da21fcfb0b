from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from parley.operators.splits import head_per_split, pick_example
from parley.session import materialize, scratch_path
from parley.sources import datasets as d


@pytest.fixture
def path(spark):
    return scratch_path(spark, "test_sources")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_dataset_without_splits_is_train(spark, path):
    d.write_dataset(spark.range(3), path)
    assert rows_of(d.read_dataset(spark, path)) == [(0, "train"), (1, "train"), (2, "train")]
    assert d.read_dataset(spark, path, split="test").count() == 0


def test_asking_for_a_split_prunes_the_rest(spark, path):
    df = spark.range(10).withColumn("split", F.when(F.col("id") < 4, "test").otherwise("train"))
    d.write_dataset(df, path)
    part = d.read_dataset(spark, path, split="test")
    assert rows_of(part.select("id")) == [(0,), (1,), (2,), (3,)]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_stored_position(spark, path):
    d.write_dataset(spark.range(100, numPartitions=5), path)
    df = d.read_dataset(spark, path, position=True)
    first = head_per_split(df, 30)
    assert sorted(r["id"] for r in first.collect()) == list(range(30))
    assert pick_example(df, i=42).first()["id"] == 42
    assert pick_example(df, i=100).first() is None
    split = d.read_dataset(spark, path, position=True).withColumn("split", F.when(F.col("id") < 55, "a").otherwise("b"))
    got = head_per_split(split, 12)
    assert sorted(r["id"] for r in got.collect()) == [*range(12), *range(55, 67)]
    first = head_per_split(df, 5)
    assert re.search(r"DataFilters: .{0,200}file_path", first._jdf.queryExecution().executedPlan().toString())


def test_pick_example_falls_back_to_the_first_split(spark):
    df = spark.range(6).withColumn("split", F.when(F.col("id") % 2 == 0, "b").otherwise("a"))
    assert pick_example(df, "b", 1, ["id"]).first()["id"] == 2
    assert pick_example(df, "train", 2, ["id"]).first()["id"] == 5
    assert pick_example(df, "train", 3, ["id"]).first() is None


def test_jsonl(spark, path):
    df = spark.createDataFrame([(1, "你好 é", None), (2, None, 0.5)], "a int, b string, c double")
    d.write_jsonl(df, path)
    lines = sorted(r[0] for r in spark.read.text(path).collect())
    assert lines == ['{"a":1,"b":"你好 é","c":null}', '{"a":2,"b":null,"c":0.5}']
    assert rows_of(d.read_jsonl(spark, path, df.schema)) == rows_of(df)


def test_jsonl_skips_blank_lines_and_refuses_broken_ones(spark, path, tmp_path):
    spark.createDataFrame([('{"a":1}',), ("",), ("  ",), ('{"a":2}',)], "v string").coalesce(1).write.text(path)
    assert rows_of(d.read_jsonl(spark, path, "a int")) == [(1,), (2,)]
    (tmp_path / "broken.json").write_text('{"a":1}\n{"a":\n')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        d.read_jsonl(spark, str(tmp_path), "a int").collect()


def test_report(spark, path):
    df = spark.createDataFrame([(3, (1, 9.5))], "seen int, token_length struct<count:int,p95:double>")
    d.write_report(df, path)
    assert spark.read.text(path).collect() == [('{"seen":3,"token_length":{"count":1,"p95":9.5}}',)]
    assert d.read_report(spark, path, df.schema).first() == df.first()


def test_verify_dataset(spark):
    df = spark.createDataFrame([("train", 1, "x"), ("train", 2, None), ("test", 3, "y")], "split string, id int, text string")
    got = {(r["rule"], r["split"], r["subject"]): (r["rows"], r["failures"], r["passed"]) for r in d.verify_dataset(df, ["text", "label"], ["train", "test", "validation"]).collect()}
    assert got[("has_rows", "validation", "validation")] == (0, 1, False)
    assert got[("has_rows", "train", "train")] == (2, 0, True)
    assert got[("column_filled", "train", "text")] == (2, 1, False)
    assert got[("column_filled", "test", "text")] == (1, 0, True)
    assert got[("column_filled", "test", "label")] == (1, 1, False)


def test_split_columns(spark):
    df = spark.createDataFrame([("a", 1, "x")], "split string, id int, text string")
    assert rows_of(d.split_columns(df)) == [("a", 0, "id", "int"), ("a", 1, "text", "string")]
    assert rows_of(d.list_splits(df)) == [("a", 1)]


def test_scratch_is_in_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert scratch_path(spark, "x").startswith(f"{base.rstrip('/')}/parley/x-")
    kept = materialize(spark.range(5), "range")
    assert kept.count() == 5 and "parquet" in kept._jdf.queryExecution().executedPlan().toString()


def test_split_names_are_read_as_written(spark, tmp_path):
    df = spark.createDataFrame([(1, "1"), (2, "01"), (3, "001"), (4, None)], "id long, split string")
    d.write_dataset(df, str(tmp_path / "named"))
    assert {(r["id"], r["split"]) for r in d.read_dataset(spark, str(tmp_path / "named")).collect()} == {(r["id"], r["split"]) for r in df.collect()}


def test_stored_order_goes_by_part_number(spark, tmp_path):
    for number, value in ((99999, 1), (100000, 2)):
        spark.createDataFrame([(value,)], "id long").coalesce(1).write.parquet(str(tmp_path / str(number)))
        part = next((tmp_path / str(number)).glob("part-*.parquet"))
        (tmp_path / "all").mkdir(exist_ok=True)
        part.rename(tmp_path / "all" / f"part-{number}-x.parquet")
    df = d.read_dataset(spark, str(tmp_path / "all"), position=True)
    assert [r["id"] for r in df.orderBy("_position").collect()] == [1, 2]
    assert [r["id"] for r in head_per_split(df, 1).collect()] == [1]
