from __future__ import annotations

from pyspark.sql import functions as F

from parley.operators.clean import remove_duplicates
from parley.operators.seen import SeenKeys
from parley.session import scratch_path


def batch(spark, rows):
    return spark.createDataFrame(rows, "id long, split string, text string")


def test_batches_one_after_another_equal_one_run_over_all(spark):
    rows = [(i, ("a", "b", None)[i % 3], f"text {i * i % 37}") for i in range(400)] + [(400 + i, "a", "hot") for i in range(300)]
    path = scratch_path(spark, "seen")
    found = []
    for start in range(0, 700, 140):
        seen = SeenKeys(spark, path, buckets=4)  # opened again for each batch
        fresh = seen.fresh(batch(spark, rows[start : start + 140]).repartition(3), ["id"])
        again = seen.fresh(batch(spark, rows[start : start + 140]), ["id"])
        assert sorted(r["id"] for r in fresh.collect()) == sorted(r["id"] for r in again.collect())
        seen.add(fresh)
        found += [r["id"] for r in fresh.collect()]
    whole = remove_duplicates(batch(spark, rows), ["id"])
    assert sorted(found) == sorted(r["id"] for r in whole.collect())
    assert SeenKeys(spark, path, buckets=4).keys().count() == len(found)
    assert SeenKeys(spark, path, buckets=4).fresh(batch(spark, rows), ["id"]).count() == 0


def test_old_keys_are_not_shuffled(spark):
    seen = SeenKeys(spark, scratch_path(spark, "seen"), buckets=4)
    seen.add(seen.fresh(batch(spark, [(i, "a", f"t{i}") for i in range(50)]), ["id"]))
    new = batch(spark, [(9, "a", "t9"), (60, "a", "new")]).withColumn("_key", F.col("text")).hint("merge")
    steps = new.join(seen.keys(), "_key", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert steps.count("Exchange") == 1 and "Bucketed: true" in steps
    assert [r["id"] for r in seen.fresh(batch(spark, [(9, "a", "t9"), (60, "a", "new"), (61, "b", "t9")]), ["id"]).orderBy("id").collect()] == [60, 61]


def test_empty_batches_and_one_scope_for_all(spark):
    seen = SeenKeys(spark, scratch_path(spark, "seen"), buckets=2)
    none = batch(spark, [])
    assert seen.fresh(none, ["id"]).count() == 0
    seen.add(seen.fresh(none, ["id"]))
    first = seen.fresh(batch(spark, [(1, "a", "x"), (2, "b", "x")]), ["id"], scope="global")
    assert [r["id"] for r in first.collect()] == [1]
