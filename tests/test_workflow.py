from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.operators.clean import clean_counts, convert_chat, normalize_rows, remove_duplicates, remove_null
from parley.plans.inputs import untidy_conversations
from parley.plans.stages import Stages
from parley.plans.workflow import clean, run_workflow
from parley.session import scratch_path
from parley.sources.datasets import read_dataset, read_report, with_split
from parley.streaming.clean import clean_stream


def test_workflow(spark, sf_dir):
    raw = untidy_conversations(spark, sf_dir)
    done = run_workflow(raw, ["conv_id"], ["conv_id"], test=0.1, validation=0.1)
    counts = done.counts
    assert counts["raw"] == raw.count() >= counts["no_null"] == counts["normalized"]
    assert counts["deduplicated"] >= counts["chat"] == done.dataset.count() > 0
    sizes = {r["split"]: r["count"] for r in done.dataset.groupBy("split").count().collect()}
    assert done.training_plan.first()["train_rows"] == sizes["train"]
    assert done.training_tokens.count() == counts["chat"]
    assert done.stats.first()["rows"] == counts["raw"]
    assert done.preview.count() == 3
    assert done.token_stats.first()["seen"] == counts["raw"]
    assert done.length_counts.first()["char_count"] == counts["no_null"]
    assert done.length_histogram.count() == 100


def test_workflow_equals_the_single_steps(spark, sf_dir):
    raw = untidy_conversations(spark, sf_dir).withColumn("note", F.lit("ｎ"))
    together = clean(raw, ["conv_id"], keep_other_fields=True)[0]
    unique = remove_duplicates(normalize_rows(remove_null(with_split(raw))), ["conv_id"])
    steps = convert_chat(unique, keep_other_fields=True)
    assert set(together.columns) == {"split", "conv_id", "note", "messages"}
    columns = sorted(together.columns)
    a, b = together.select(*columns), steps.select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_saved_workflow(spark, sf_dir):
    raw = untidy_conversations(spark, sf_dir)
    out = scratch_path(spark, "saved")
    done = run_workflow(raw, ["conv_id"], ["conv_id"], test=0.1, validation=0.1, path=out)
    totals = done.stage_counts.groupBy("stage").agg(F.sum("rows").alias("rows")).collect()
    assert {r["stage"]: r["rows"] for r in totals} == done.counts
    saved = read_report(spark, f"{out}/reports/stage_counts").select(*done.stage_counts.columns)
    assert saved.exceptAll(done.stage_counts).isEmpty() and saved.count() == 5
    assert read_report(spark, f"{out}/reports/example").first()["conv_id"] == raw.agg(F.min("conv_id")).first()[0]
    sizes = {r["split"]: r["rows"] for r in read_report(spark, f"{out}/reports/split_sizes").collect()}
    assert sum(sizes.values()) == done.counts["chat"] == spark.read.parquet(f"{out}/training").count()
    assert read_report(spark, f"{out}/reports/training_plan").first()["train_rows"] == sizes["train"]
    assert read_dataset(spark, f"{out}/dataset").count() == done.counts["chat"]


def test_skipped_stages(spark, sf_dir):
    raw = untidy_conversations(spark, sf_dir)
    done = run_workflow(raw, ["conv_id"], ["conv_id"], skip_profile=True, skip_training=True)
    assert done.stats is None and done.training_text is None and done.dataset is not None
    again = run_workflow(done.dataset, ["conv_id"], ["conv_id"], skip_profile=True, skip_clean=True)
    assert again.counts is None and again.training_text.count() == done.dataset.count()


def test_clean_stream(spark, sf_dir):
    path, out, checkpoint = (scratch_path(spark, f"stream_{n}") for n in ("in", "out", "log"))
    raw = untidy_conversations(spark, sf_dir)
    raw.write.parquet(path)
    stream = clean_stream(spark.readStream.schema(raw.schema).parquet(path), keep=["conv_id"])
    run = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    run.awaitTermination(120)
    batch = clean_stream(raw, keep=["conv_id"])
    got = spark.read.schema(batch.schema).parquet(out)
    assert got.count() == batch.count() > 0 and got.exceptAll(batch).isEmpty()


def _raw(spark, path, guard=None):
    df = spark.read.parquet(path)
    turns = F.col("conversations")
    return df if guard is None else df.withColumn("conversations", F.when(F.raise_error(F.lit(guard)).isNull(), turns))


def test_a_resumed_workflow_skips_what_is_finished(spark, sf_dir):
    path, out = scratch_path(spark, "raw"), scratch_path(spark, "resumed")
    untidy_conversations(spark, sf_dir).write.parquet(path)

    def broken():
        return 1 / 0

    def run(df, **more):
        return run_workflow(df, ["conv_id"], ["conv_id"], path=out, resume=True, test=0.1, validation=0.1, **more)

    with pytest.raises(Exception, match="ZeroDivisionError"):
        run(_raw(spark, path), training_tokenizer=broken)
    before = {r["stage"]: r["path"] for r in spark.read.json(f"{out}/manifests/*").collect()}
    assert "cleaned" in before and "training" not in before
    # The raw rows cannot be read any more; what fails again is the stage that failed before.
    with pytest.raises(Exception, match="ZeroDivisionError"):
        run(_raw(spark, path, "raw rows are read again"), training_tokenizer=broken)
    after = {r["stage"]: r["path"] for r in spark.read.json(f"{out}/manifests/*").collect()}
    assert after == before


def test_other_arguments_or_files_run_a_stage_anew(spark, sf_dir):
    out = scratch_path(spark, "stages")
    made = []

    def build():
        made.append(1)
        return spark.range(5)

    for arguments in ({"seed": 1}, {"seed": 1}, {"seed": 2}):
        stage = Stages(spark, out, ["a.parquet"], arguments)
        assert stage.table("five", build).count() == 5 and stage.rows("five") == 5
    Stages(spark, out, ["a.parquet", "b.parquet"], {"seed": 2}).table("five", build)
    assert len(made) == 3


def test_stage_counts_are_exact_and_equal_the_cleaned_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    done = run_workflow(df, ["doc_id"], ["doc_id"], skip_profile=True, skip_training=True)
    assert done.counts["raw"] == df.count() and done.counts["chat"] == done.dataset.count()
    assert {r["stage"]: r["rows"] for r in clean_counts(df).collect()} == done.counts
