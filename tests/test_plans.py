"""The physical plans are the intended ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parley.functions.messages import to_messages
from parley.functions.text import compact_text, is_blank
from parley.functions.tokens import token_count
from parley.operators.clean import convert_chat, normalize_rows, remove_duplicates, remove_null
from parley.operators.profile import preview
from parley.operators.splits import head_per_split, split_dataset
from parley.operators.turns import unfold_turns
from parley.plans import queries
from parley.plans.workflow import clean
from parley.plans.inputs import table, untidy_conversations
from parley.session import scratch_path
from parley.sources.datasets import read_dataset, write_dataset


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_null_filter_and_text_scans_need_no_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    native = docs.select(compact_text(F.col("text")), is_blank(F.col("text")), token_count(F.col("text")))
    for df in (remove_null(docs), native):
        assert "Python" not in plan(df) and "Exchange" not in plan(df)


def test_conversion_runs_python_once_and_builds_messages_once(spark, sf_dir):
    raw = untidy_conversations(spark, sf_dir)
    steps = plan(convert_chat(raw, keep=["conv_id"]))
    assert steps.count("ArrowEvalPython") == 1
    # The only filter is that of turns without a conversation, at the scan: none stands over the messages.
    assert steps.count("Generate ") == 1
    assert steps.count("- Filter") == steps.count("- Filter isnotnull(conv_id") == 1
    assert plan(normalize_rows(raw)).count("ArrowEvalPython") == 1


def test_unfolded_messages_are_built_once_and_filters_reach_the_scan(spark, sf_dir):
    raw = untidy_conversations(spark, sf_dir)
    made = unfold_turns(raw.select("conv_id", to_messages(raw).alias("messages")))
    assert plan(made).count("ArrowEvalPython") == 1
    steps = plan(normalize_rows(table(spark, sf_dir, "documents")).where("doc_id < 9"))
    assert "PushedFilters: [IsNotNull(doc_id), LessThan(doc_id,9)]" in steps


def test_filters_on_the_split_prune_folders_below_normalisation(spark, sf_dir):
    path = scratch_path(spark, "pruned")
    write_dataset(table(spark, sf_dir, "documents").withColumn("split", F.col("lang")), path)
    steps = plan(normalize_rows(read_dataset(spark, path)).where("split = 'en'"))
    assert "PartitionFilters: [isnotnull(split" in steps


def test_dedup_drops_copies_before_the_shuffle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    steps = plan(remove_duplicates(docs, order_by=["doc_id"]))
    assert steps.count("WindowGroupLimit") == 2 and steps.count("Exchange") == 1


def test_workflow_cleans_with_one_shuffle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    steps = plan(clean(docs, ["doc_id"])[0])
    assert steps.count("Exchange") == 1 and steps.count("ArrowEvalPython") == 2
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in steps


def test_exact_split_and_large_head_shuffle_nothing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    assert "Exchange" not in plan(split_dataset(orders, "o_orderkey"))
    by_status = orders.withColumn("split", F.col("o_orderstatus"))
    steps = plan(head_per_split(by_status, 1001, ["o_orderkey"]))
    assert "Exchange" not in steps
    single = head_per_split(orders.withColumn("split", F.lit("train")), 1001, ["o_orderkey"])
    assert "PushedFilters: [Or(Or(IsNull(o_orderkey),LessThan(o_orderkey," in plan(single)


def test_preview_reads_only_what_it_shows(spark, sf_dir):
    steps = plan(preview(table(spark, sf_dir, "lineitem"), columns=2, order_by=["l_orderkey"]))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in steps


@pytest.mark.parametrize(("name", "firsts"), [("stored_order", [("de", k) for k in range(1, 20, 2)] + [("en", k) for k in range(0, 20, 2)]), ("stored_example", [("de", 59)])])
def test_stored_documents_have_parts_of_bounded_size(spark, monkeypatch, tmp_path, name, firsts):
    """As many parts as the documents have bytes for, so that no task reads a fixed share of all."""
    rows = [(k, "word " * 40, ("en", "de")[k % 2], "s", 200) for k in range(400)] + [(400, None, "en", None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(queries, "_PART_BYTES", 10_000, raising=False)
    found = queries.QUERIES[name](spark, str(tmp_path)).collect()
    assert sorted((r["split"], r["doc_id"]) for r in found) == firsts
    files = sorted(str(f.relative_to(tmp_path)) for f in (tmp_path / name).glob("*/part-*"))
    assert len({f.split("part-")[1][:5] for f in files}) == 11
    assert spark.read.parquet(str(tmp_path / name)).count() == len(rows)
