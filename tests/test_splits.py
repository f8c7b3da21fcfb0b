from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from parley.operators import ranks, splits
from parley.operators.splits import head_per_split, pick_example, select_eval_split, split_dataset, split_sizes
from parley.sources.datasets import read_dataset


@pytest.mark.parametrize(("rows", "sizes"), [(1000, (960, 20, 20)), (100, (96, 2, 2)), (25, (24, 0, 1)), (0, (0, 0, 0))])
def test_split_sizes(rows, sizes):
    assert split_sizes(rows, 0.02, 0.02) == sizes


def brute_force_split(ids, test, validation, seed):
    order = sorted(ids, key=lambda i: hashlib.sha1(f"{seed}:{i}".encode()).hexdigest())
    _, n_validation, n_test = split_sizes(len(ids), test, validation)
    return {i: "test" if r < n_test else "validation" if r < n_test + n_validation else "train" for r, i in enumerate(order)}


@pytest.mark.parametrize("rows", [0, 1, 25, 1000, 9001])
@pytest.mark.parametrize(("test", "validation"), [(0.02, 0.02), (0.3, 0.1), (0.0, 0.5), (0.5, 0.0), (0.0, 0.0)])
def test_exact_split_is_the_ranked_split(spark, rows, test, validation):
    df = spark.range(rows, numPartitions=3)
    got = {r["id"]: r["split"] for r in split_dataset(df, "id", test, validation, seed=5).collect()}
    assert got == brute_force_split(range(rows), test, validation, 5)


def test_split_does_not_depend_on_partitions(spark):
    a = split_dataset(spark.range(500, numPartitions=1), "id")
    b = split_dataset(spark.range(500).repartition(6), "id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_equal_keys_fall_on_one_side(spark):
    df = spark.range(9000).withColumn("key", F.lit("same"))
    assert {r["split"] for r in split_dataset(df, "key").select("split").distinct().collect()} == {"test"}


def test_composite_keys_do_not_read_alike(spark):
    rows = [("a:b", "c"), ("a", "b:c"), (None, "c"), ("", "c"), ("c", None), ("c", ""), ("-", "c"), ("1:-", "c")]
    df = spark.createDataFrame(rows, "`x.y` string, z string")
    assert df.select(splits.split_hash(["x.y", "z"], 1)).distinct().count() == len(rows)


def test_hash_split_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    split_dataset(spark.range(10), "id", mode="hash")
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_repeated_keys_away_from_the_cut_do_no_harm(spark):
    df = spark.range(3000).withColumn("key", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")))
    sizes = {r["split"]: r["count"] for r in split_dataset(df, "key", 0.1, 0.1, seed=1).groupBy("split").count().collect()}
    assert sizes == {"train": 2400, "validation": 300, "test": 300}


def test_hash_split_is_close_and_covers_all(spark):
    got = split_dataset(spark.range(20_000), "id", 0.1, 0.2, mode="hash").groupBy("split").count()
    sizes = {r["split"]: r["count"] for r in got.collect()}
    assert sum(sizes.values()) == 20_000
    assert sizes["test"] == pytest.approx(2000, rel=0.1) and sizes["validation"] == pytest.approx(4000, rel=0.1)


def test_existing_splits(spark):
    df = spark.range(90)
    third = df.withColumn("split", F.element_at(F.array(*map(F.lit, ("train", "validation", "test"))), (F.col("id") % 3 + 1).cast("int")))
    assert split_dataset(third, "id").exceptAll(third).isEmpty()
    two = third.where("split <> 'validation'")
    with pytest.raises(ValueError, match="others"):
        split_dataset(two, "id")
    assert split_dataset(two, "id", others="drop").count() == 30
    assert split_dataset(two, "id", others="merge").count() == 60
    nulls = df.withColumn("split", F.when(F.col("id") < 40, "train"))
    assert split_dataset(nulls, "id", others="drop").count() == 40 and split_dataset(nulls, "id", others="merge").count() == 90
    assert split_dataset(df.withColumn("split", F.lit(None).cast("string")), "id").count() == 90
    other = df.withColumn("split", F.when(F.col("id") < 40, "b").otherwise("a"))
    assert {r["id"] for r in split_dataset(other, "id", others="drop").collect()} == set(range(40, 90))


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        split_dataset(spark.range(1), "id", mode="other")


ROWS = [
    (("a", "b", "c")[0 if i % 3 == 0 else i % 2 + 1], i * 7919 % 5003 - 2500 if i % 11 else None, -i)
    for i in range(5000)
]


def brute_force_head(n):
    out = set()
    for name in "abc":
        rows = [r for r in ROWS if r[0] == name]
        out |= set(sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))[:n])
    return out


@pytest.mark.parametrize("n", [0, 1, 40, 1200, 1700, 9999])
@pytest.mark.parametrize("way", ["ranked", "cut", "struct"])
def test_head_per_split(spark, monkeypatch, n, way):
    monkeypatch.setattr(splits, "_CUT_SPLITS", 64 if way == "cut" else 0)
    df = spark.createDataFrame(ROWS, "split string, x bigint, y bigint").repartition(5)
    if way == "struct":
        df = df.withColumn("x", F.struct("x"))
    got = head_per_split(df, n, ["x", "y"])
    if way == "struct":
        got = got.withColumn("x", F.col("x.x"))
    rows = got.collect()
    assert len(rows) == len(set(rows)) and {tuple(r) for r in rows} == brute_force_head(n)


def test_head_of_many_splits(spark):
    df = spark.range(3000).withColumn("split", (F.col("id") % 100).cast("string"))
    assert sorted(r["id"] for r in head_per_split(df, 3, ["id"]).collect()) == list(range(300))


def test_cuts_over_the_whole_range_of_numbers(spark):
    values = sorted({-(2**63), 2**63 - 1, *(s * 3**k for k in range(39) for s in (1, -1)), 0})
    df = spark.createDataFrame([("g", v) for v in values], "g string, v bigint")
    bounds = ranks.order_bounds(df, F.col("g"), F.col("v"))
    wanted = list(range(1, len(values)))
    cuts = ranks.order_cuts(df, F.col("g"), [F.col("v")], {"g": wanted}, bounds)["g"]
    for rank, cut in zip(wanted, cuts, strict=True):
        assert values[rank - 1] <= cut[0] < values[rank]


@pytest.mark.parametrize("n", [1, 700, 2000])
def test_tied_order_still_gives_n_rows(spark, n):
    df = spark.range(6000).select(F.lit("s").alias("split"), "id", (F.col("id") % 3).alias("x"))
    rows = head_per_split(df, n, ["x"]).collect()
    assert len({r["id"] for r in rows}) == n and {r["x"] for r in rows} == {0}


def test_ties_fall_alike_whichever_way_rows_are_found(spark, monkeypatch):
    df = spark.range(6000).select(F.lit("s").alias("split"), "id", (F.col("id") % 3).alias("x"))
    found = []
    for cut_splits, parts in ((64, 3), (0, 3), (0, 17)):
        monkeypatch.setattr(splits, "_CUT_SPLITS", cut_splits)
        found.append({r["id"] for r in head_per_split(df.repartition(parts), 1500, ["x"]).collect()})
    assert found[0] == found[1] == found[2]


def test_example_between_two_cuts(spark):
    rows = [("a", v, w) for v, w in ((None, 1), (3, 1), (3, 2), (5, 1), (5, 1), (9, 0))]
    df = spark.createDataFrame(rows, "split string, v bigint, w bigint")
    for i, row in enumerate(rows):
        assert [tuple(r) for r in pick_example(df, "a", i, ["v", "w"]).collect()] == [row]
    assert pick_example(df, "a", 6, ["v", "w"]).collect() == []
    big = spark.range(9000).withColumn("split", F.lit("train"))
    example = pick_example(big, i=7000, order_by=["id"])
    assert [r["id"] for r in example.collect()] == [7000]
    assert "TakeOrdered" not in example._jdf.queryExecution().executedPlan().toString()


def test_rows_without_a_split_are_a_split_too(spark):
    df = spark.range(100).withColumn("split", F.when(F.col("id") % 2 == 0, "s"))
    rows = sorted(r["id"] for r in head_per_split(df, 3, ["id"]).collect())
    assert rows == [0, 1, 2, 3, 4, 5]


STORED = [(("a", "b", "a", None)[k % 4 if k < 90 else 0], k) for k in range(150)]


@pytest.fixture
def stored(spark, tmp_path):
    """Rows of three splits in four files, a file holding several of them, and numbered in stored order."""
    path = str(tmp_path / "stored")
    df = spark.createDataFrame(STORED, "part string, k long").repartitionByRange(4, "k").sortWithinPartitions("k")
    df.write.parquet(path)
    return read_dataset(spark, path, position=True).withColumn("split", F.col("part")).drop("part")


@pytest.mark.parametrize("listed", [10_000, 1])
@pytest.mark.parametrize("n", [0, 1, 22, 500])
def test_first_rows_in_stored_order(monkeypatch, stored, n, listed):
    monkeypatch.setattr(splits, "_STORED_BITS", 2)
    monkeypatch.setattr(splits, "_LISTED", listed)
    wanted = [(s, k) for part in ("a", "b", None) for s, k in [r for r in STORED if r[0] == part][:n]]
    got = head_per_split(stored, n)
    assert got.columns == stored.columns
    assert sorted(((r["split"], r["k"]) for r in got.collect()), key=str) == sorted(wanted, key=str)
    kept = [r for r in STORED if r[1] % 3]
    wanted = [(s, k) for part in ("a", "b", None) for s, k in [r for r in kept if r[0] == part][:n]]
    got = head_per_split(stored.where("k % 3 > 0"), n).collect()
    assert sorted(((r["split"], r["k"]) for r in got), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("i", [0, 45, 104, 105])
def test_example_in_stored_order(monkeypatch, stored, i):
    monkeypatch.setattr(splits, "_STORED_BITS", 3)
    wanted = [r for r in STORED if r[0] == "a"][i : i + 1]
    assert [(r["split"], r["k"]) for r in pick_example(stored, "a", i).collect()] == wanted
    assert pick_example(stored.limit(0), "a", i).count() == 0


def test_example_in_stored_order_opens_one_file(spark, tmp_path):
    path = tmp_path / "one"
    spark.range(1000, numPartitions=5).write.parquet(str(path))
    found = pick_example(read_dataset(spark, str(path), position=True), i=450)
    for file in path.glob("part-*"):
        if "part-00002" not in file.name:
            file.write_bytes(b"no parquet")
    assert [r["id"] for r in found.collect()] == [450]


def test_select_eval_split(spark):
    df = spark.range(50).withColumn("split", F.when(F.col("id") < 20, "test").otherwise("train"))
    assert [r["id"] for r in select_eval_split(df, 3, ["id"]).orderBy("id").collect()] == [0, 1, 2]
    both = df.withColumn("split", F.when(F.col("id") > 45, "validation").otherwise(F.col("split")))
    assert [r["id"] for r in select_eval_split(both, None, ["id"]).orderBy("id").collect()] == [46, 47, 48, 49]
    with pytest.raises(ValueError, match="neither"):
        select_eval_split(df.where("split = 'train'"))
