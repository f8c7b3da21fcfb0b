"""One registered query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.constants import MAX_LENGTH
from parley.functions.messages import (
    content_key,
    extract_reply,
    from_instruction,
    from_pair,
    from_qa,
    from_text,
    infer_roles,
    is_chat_pair,
    render_chat,
    row_key,
    to_messages,
)
from parley.functions.metrics import perplexity
from parley.functions.roles import normalize_role
from parley.functions.text import char_length, compact_text, nfkc, normalize_text, strip
from parley.functions.tokens import token_count, token_ids, token_list
from parley.functions.vocabulary import Vocabulary
from parley.operators.clean import clean_counts, convert_chat, normalize_rows, remove_duplicates, remove_null
from parley.operators.evaluate import evaluate_loss
from parley.operators.generate import (
    build_prompts,
    chat_history,
    compare_markdown,
    compare_runs,
    extract_replies,
    generation_benchmark,
    speed_summary,
)
from parley.operators.profile import (
    SKETCH_ERROR,
    dataset_stats,
    length_counts,
    length_histogram,
    length_sketches,
    merge_sketches,
    preview,
    text_lengths,
    token_stats,
)
from parley.operators.runs import chat_runs, fold_runs, rejected_turns, unfold_runs
from parley.operators.seen import SeenKeys
from parley.operators.sft import to_training_text, tokenize_sft, training_plan
from parley.operators.splits import head_per_split, pick_example, select_eval_split, split_dataset
from parley.operators.turns import fold_turns, unfold_turns
from parley.operators.unigram import fit_unigram, unigram_losses
from parley.plans.inputs import (
    NAMES,
    chats,
    documents,
    exchanges,
    table,
    untidy_conversations,
    untidy_documents,
    untidy_turns,
    widen,
)
from parley.plans.workflow import run_workflow
from parley.session import materialize, scratch_path
from parley.sources.datasets import (
    list_splits,
    read_dataset,
    read_jsonl,
    read_report,
    split_columns,
    verify_dataset,
    write_dataset,
    write_jsonl,
    write_report,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- text, roles, keys, rendering ---------------------------------------------


@query
def nfkc_text(spark, sf):
    docs = documents(spark, sf)
    tables = F.lit("\u2460\ufb01\uff76\uff9ee\u0301")  # only the Unicode tables know these
    return docs.select("doc_id", nfkc(F.concat(widen(F.col("text")), tables)).alias("text"))


@query
def normalized_text(spark, sf):
    return untidy_documents(spark, sf).select("doc_id", normalize_text(F.col("text")).alias("text"))


@query
def compacted_text(spark, sf):
    spaced = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit(" "), F.lit("\u3000\t "))).otherwise(F.col("text"))
    text = F.when(F.col("doc_id") % 7 != 0, spaced)
    return documents(spark, sf).select("doc_id", compact_text(text).alias("text"))


@query
def normalized_role(spark, sf):
    turns = table(spark, sf, "conversations")
    names = F.array(*[F.lit(raw).cast("string") for raw, _ in NAMES])
    name = F.get(names, ((F.col("conv_id") * 3 + F.col("turn")) % len(NAMES)).cast("int"))
    return turns.select("conv_id", "turn", normalize_role(name).alias("role"))


@query
def content_keys(spark, sf):
    return chats(spark, sf).select("conv_id", content_key(F.col("messages")).alias("key"))


@query
def row_keys(spark, sf):
    docs = documents(spark, sf)
    return docs.select("doc_id", row_key(docs).alias("key"))


@query
def rendered_chat(spark, sf):
    return chats(spark, sf).select("conv_id", render_chat(F.col("messages")).alias("text"))


@query
def rendered_chatml(spark, sf):
    text = render_chat(F.col("messages"), "chatml", add_generation_prompt=True)
    return chats(spark, sf).select("conv_id", text.alias("text"))


@query
def char_lengths(spark, sf):
    return table(spark, sf, "documents").select("doc_id", char_length(F.col("text")).alias("char_length"))


@query
def token_counts(spark, sf):
    return documents(spark, sf).select("doc_id", token_count(F.col("text")).alias("tokens"))


@query
def extracted_reply(spark, sf):
    padded = untidy_turns(spark, sf).select("conv_id", "turn", F.lit("assistant").alias("role"), "text")
    outputs = fold_turns(padded, "conv_id", "turn", {"role": "role", "text": "content"}, "generated")
    reply = normalize_text(extract_reply(outputs, "generated"))
    return outputs.select("conv_id", reply.alias("reply"))


@query
def perplexity_values(spark, sf):
    missing = F.when(F.col("event_id") % 13 != 0, F.col("value") * 3)
    loss = F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(missing)
    found = table(spark, sf, "events").select("event_id", perplexity(loss).alias("p"))
    infinite = F.col("p") == float("inf")
    return found.select(
        "event_id",
        infinite.alias("is_infinite"),
        F.when(~infinite, F.round(F.ln("p"), 6)).alias("log_perplexity"),
    )


# --- message construction -----------------------------------------------------


def _unfold_messages(df: DataFrame) -> DataFrame:
    return unfold_turns(df.select("conv_id", to_messages(df).alias("messages")), turn="position")


@query
def messages_shape(spark, sf):
    turns = untidy_turns(spark, sf)
    return _unfold_messages(fold_turns(turns, "conv_id", "turn", {"speaker": "role", "text": "content"}, "messages"))


@query
def conversations_shape(spark, sf):
    return _unfold_messages(untidy_conversations(spark, sf))


@query
def inferred_roles(spark, sf):
    turns = table(spark, sf, "conversations").withColumn(
        "speaker", F.when(F.col("role") == "system", F.col("role")).otherwise(F.concat(F.lit("npc #"), F.col("turn").cast("string")))
    )
    folded = fold_turns(turns, "conv_id", "turn", {"speaker": "speaker", "text": "content"}, "turns")
    return unfold_turns(folded.select("conv_id", infer_roles(F.col("turns")).alias("messages")), turn="position")


def _pair_columns(df: DataFrame, messages) -> DataFrame:
    return df.select("conv_id", "turn", messages.alias("m")).select(
        "conv_id",
        "turn",
        F.get("m", F.lit(0))["content"].alias("user_text"),
        F.get("m", F.lit(1))["content"].alias("assistant_text"),
    )


@query
def instruction_shape(spark, sf):
    df = exchanges(spark, sf)
    return _pair_columns(df, from_instruction(F.col("said"), F.col("extra"), F.col("answer")))


@query
def pair_shape(spark, sf):
    return _pair_columns(exchanges(spark, sf), from_pair(F.col("said"), F.col("answer")))


@query
def qa_shape(spark, sf):
    return _pair_columns(exchanges(spark, sf), from_qa(F.col("said"), F.col("answer")))


@query
def text_shape(spark, sf):
    docs = untidy_documents(spark, sf)
    return unfold_turns(docs.select("doc_id", from_text(F.col("text")).alias("messages")), turn="position")


@query
def dispatched_shapes(spark, sf):
    turns = untidy_turns(spark, sf)
    fields = {"speaker": "role", "text": "content"}
    third = F.col("conv_id") % 3
    folded = fold_turns(turns, "conv_id", "turn", fields, "turns").select(
        "conv_id",
        F.when(third == 0, F.col("turns")).alias("messages"),
        F.when(third == 1, F.col("turns")).alias("conversations"),
        F.array_join(F.transform("turns", lambda t: F.concat(F.lit("["), t["content"], F.lit("]"))), " ").alias("text"),
    )
    return _unfold_messages(folded)


@query
def folded_turns(spark, sf):
    return unfold_turns(chats(spark, sf))


@query
def chat_pairs(spark, sf):
    return chats(spark, sf).select("conv_id", is_chat_pair(F.col("messages")).alias("is_pair"))


# --- cleaning -----------------------------------------------------------------


def _with_empty(df: DataFrame) -> DataFrame:
    """Every fifth conversation has only blank turns, every seventh none at all."""
    blank = F.transform("conversations", lambda t: t.withField("value", F.lit("\u3000\u200b")))
    return df.withColumn(
        "conversations",
        F.when(F.col("conv_id") % 7 == 3, F.lit(None))
        .when(F.col("conv_id") % 5 == 2, blank)
        .otherwise(F.col("conversations")),
    )


def _copies(df: DataFrame) -> DataFrame:
    """Each conversation a second time, later in order, with other blanks between words."""
    respaced = F.transform("conversations", lambda t: t.withField("value", F.replace(t["value"], F.lit("\t "), F.lit(" \n"))))
    shifted = df.withColumn("conversations", respaced).withColumn("conv_id", F.col("conv_id") + 1_000_000_000)
    return shifted.unionByName(df)


@query
def nulls_removed(spark, sf):
    kept = remove_null(_with_empty(untidy_conversations(spark, sf)))
    return kept.select("conv_id", F.size("conversations").cast("bigint").alias("turns"))


@query
def normalized_rows(spark, sf):
    df = untidy_conversations(spark, sf).withColumn("note", widen(F.concat(F.lit("note  "), F.col("conv_id").cast("string"))))
    return unfold_turns(normalize_rows(df), "conversations").select(
        "conv_id", "note", "turn", F.col("from").alias("speaker"), F.col("value").alias("text")
    )


@query
def deduplicated_chats(spark, sf):
    kept = remove_duplicates(_copies(untidy_conversations(spark, sf)), order_by=["conv_id"])
    return kept.select("conv_id", F.size("conversations").cast("bigint").alias("turns"))


@query
def deduplicated_documents(spark, sf):
    docs = untidy_documents(spark, sf).withColumn("split", F.col("lang"))
    return remove_duplicates(docs, order_by=["doc_id"]).select("split", "doc_id")


@query
def deduplicated_globally(spark, sf):
    docs = documents(spark, sf).withColumn("split", F.col("source"))
    return remove_duplicates(docs, order_by=["doc_id"], scope="global").select("split", "doc_id")


@query
def deduplicated_batches(spark, sf):
    """Two batches one after the other: documents with odd ids are met by the keys of those with even ones."""
    docs = untidy_documents(spark, sf).withColumn("split", F.col("lang"))
    seen = SeenKeys(spark, scratch_path(spark, "seen"), buckets=8)
    batches = []
    for batch in (0, 1):
        batches.append(seen.fresh(docs.where(F.col("doc_id") % 2 == batch), ["doc_id"]))
        seen.add(batches[-1])
    return batches[0].unionByName(batches[1]).select("split", "doc_id")


@query
def converted_chats(spark, sf):
    df = untidy_conversations(spark, sf)
    df = df.withColumns(
        {"turns": F.size("conversations"), "half": F.col("conv_id") / 2, "tags": F.array(F.lit("dropped"))}
    )
    return unfold_turns(convert_chat(df, keep_other_fields=True), turn="position")


@query
def stage_report(spark, sf):
    """Two splits; each conversation and its copy lie in the same one."""
    raw = _copies(_with_empty(untidy_conversations(spark, sf)))
    return clean_counts(raw.withColumn("split", F.when(F.col("conv_id") % 2 == 0, "even").otherwise("odd")))


# --- splits -------------------------------------------------------------------


@query
def exact_split(spark, sf):
    return split_dataset(table(spark, sf, "documents").select("doc_id"), "doc_id")


@query
def hashed_split(spark, sf):
    return split_dataset(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.1, 0.2, seed=7, mode="hash")


@query
def first_rows_per_split(spark, sf):
    docs = table(spark, sf, "documents").withColumn("split", F.col("lang"))
    return head_per_split(docs, 20, ["doc_id"]).select("split", "doc_id", "n_chars")


@query
def many_first_rows_per_split(spark, sf):
    orders = table(spark, sf, "orders").withColumn("split", F.col("o_orderstatus"))
    first = head_per_split(orders, 4_500, ["o_custkey", "o_orderkey"])
    return first.select("split", "o_custkey", "o_orderkey", "o_totalprice")


@query
def eval_rows(spark, sf):
    docs = split_dataset(table(spark, sf, "documents"), "doc_id", 0.5, 0.0)
    return select_eval_split(docs, 100, ["doc_id"]).select("split", "doc_id")


# --- profiles and sources -----------------------------------------------------


def _documents_by_language(spark, sf):
    return documents(spark, sf).withColumn("split", F.col("lang"))


@query
def dataset_profile(spark, sf):
    stats = dataset_stats(_documents_by_language(spark, sf))
    types = F.array_sort(F.transform(F.map_entries("column_types"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))))
    return stats.select(
        "split",
        "rows",
        F.array_join("columns", ",").alias("columns"),
        F.array_join("string_columns", ",").alias("string_columns"),
        F.array_join(types, ",").alias("column_types"),
    )


@query
def columns_per_split(spark, sf):
    return split_columns(_documents_by_language(spark, sf))


@query
def first_rows_shown(spark, sf):
    customers = table(spark, sf, "customer").withColumn("split", F.col("c_mktsegment"))
    return preview(customers, columns=4, order_by=["c_custkey"])


@query
def splits_listed(spark, sf):
    return list_splits(_documents_by_language(spark, sf))


@query
def picked_example(spark, sf):
    return pick_example(_documents_by_language(spark, sf), "train", 7, ["doc_id"]).select("split", "doc_id", "text")


@query
def verified_dataset(spark, sf):
    docs = table(spark, sf, "documents")
    labels = table(spark, sf, "labels")
    joined = docs.join(labels, "doc_id", "left").withColumn("split", F.col("lang"))
    return verify_dataset(joined, ["text", "quality", "summary"], ["en", "de", "train"])


@query
def token_length_stats(spark, sf):
    stats = token_stats(chats(spark, sf), max_rows=None)
    return stats.withColumns({"p95": F.round("p95", 6), "mean": F.round("mean", 6)})


@query
def token_length_stats_by_language(spark, sf):
    stats = token_stats(untidy_documents(spark, sf), max_rows=None, by=["lang"])
    return stats.withColumns({"p95": F.round("p95", 6), "mean": F.round("mean", 6)})


@query
def token_stats_of_first_rows(spark, sf):
    stats = token_stats(_documents_by_language(spark, sf), max_rows=200, order_by=["doc_id"])
    return stats.withColumns({"p95": F.round("p95", 6), "mean": F.round("mean", 6)})


@query
def token_sketches(spark, sf):
    """Statistics from saved sketches; the rank of the percentile is looked up among all lengths."""
    lengths = materialize(text_lengths(_documents_by_language(spark, sf), keep=["split"]), "lengths")
    saved = materialize(length_sketches(lengths), "sketches")
    found = merge_sketches(saved, ["split"])
    ranks = lengths.join(found.select("split", "p95", "kept"), "split").groupBy("split").agg(
        F.avg((F.col("token_length") < F.col("p95")).cast("double")).alias("below"),
        F.avg((F.col("token_length") <= F.col("p95")).cast("double")).alias("upto"),
    )
    slack = SKETCH_ERROR + 1 / F.col("kept")
    near = (F.col("below") <= 0.95 + slack) & (F.col("upto") >= 0.95 - slack)
    return found.join(ranks, "split").select(
        "split", "seen", "kept", "min", "max", F.round("mean", 6).alias("mean"), near.alias("p95_is_near")
    )


@query
def length_histograms(spark, sf):
    lengths = text_lengths(chats(spark, sf), max_rows=None)
    hist = length_histogram(lengths)
    return hist.withColumns({"bin_low": F.round("bin_low", 6), "bin_high": F.round("bin_high", 6)})


@query
def length_totals(spark, sf):
    return length_counts(text_lengths(_with_empty(untidy_conversations(spark, sf)), max_rows=None))


@query
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet_roundtrip")
    number = F.concat(F.lit("00"), (F.col("doc_id") % 3).cast("string"))
    split = F.when(F.col("doc_id") % 4 == 0, F.lit("1")).when(F.col("doc_id") % 4 < 3, number)
    write_dataset(table(spark, sf, "documents").withColumn("split", split), path)
    return read_dataset(spark, path)


#: Bytes that a part of the stored documents holds, about; a row counts as its text and so many bytes more.
_PART_BYTES, _ROW_BYTES = 32 << 20, 64


def _stored_by_language(spark, sf, name):
    """The documents by language, stored in the order of their ids: parts of equal size, four at least, more for a larger table."""
    path = scratch_path(spark, name)
    docs = _documents_by_language(spark, sf)
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(_ROW_BYTES))).first()[0] or 0
    parts = max(4, -(-size // _PART_BYTES))
    write_dataset(docs.repartitionByRange(parts, "doc_id").sortWithinPartitions("split", "doc_id"), path)
    return read_dataset(spark, path, position=True)


@query
def stored_order(spark, sf):
    return head_per_split(_stored_by_language(spark, sf, "stored_order"), 10).select("split", "doc_id")


@query
def stored_example(spark, sf):
    return pick_example(_stored_by_language(spark, sf, "stored_example"), "train", 29).select("split", "doc_id", "text")


@query
def jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "jsonl_roundtrip")
    docs = table(spark, sf, "documents").withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.col("source")))
    write_jsonl(docs, path)
    return read_jsonl(spark, path, docs.schema)


@query
def report_roundtrip(spark, sf):
    path = scratch_path(spark, "report_roundtrip")
    stats = token_stats(_documents_by_language(spark, sf), max_rows=None)
    write_report(stats.select("seen", "kept", F.struct("count", "min", "max").alias("token_length")), path)
    return read_report(spark, path).select("seen", "kept", "token_length.count", "token_length.min", "token_length.max")


# --- training tables, evaluation, generation ----------------------------------


def _split_chats(spark, sf):
    return split_dataset(materialize(convert_chat(chats(spark, sf), keep=["conv_id"]), "chats"), "conv_id", 0.2, 0.2)


@query
def training_text(spark, sf):
    return to_training_text(_split_chats(spark, sf), "tagged", keep=["conv_id"]).drop("messages")


@query
def training_tokens(spark, sf):
    texts = to_training_text(_split_chats(spark, sf), "chatml", keep=["conv_id"])
    rows = tokenize_sft(texts, max_length=MAX_LENGTH, keep=["conv_id"])
    return rows.select(
        "conv_id",
        F.size("input_ids").cast("bigint").alias("tokens"),
        F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
        (F.col("labels") == F.col("input_ids")).alias("labels_match"),
        "was_truncated",
    )


@query
def training_steps(spark, sf):
    return training_plan(_split_chats(spark, sf), batch=2, accumulation=3, epochs=2.5)


@query
def evaluated_loss(spark, sf):
    """The loss of a row stands in its table: the mean log of its ids, over the whole text."""
    texts = chats(spark, sf).select("conv_id", render_chat(F.col("messages")).alias("text"))
    logs = F.aggregate("input_ids", F.lit(0.0), lambda total, i: total + F.ln(1 + i.cast("double")))
    found = evaluate_loss(tokenize_sft(texts), logs / F.nullif(F.size("input_ids"), F.lit(0)))
    return found.withColumns({"loss": F.round("loss", 6), "perplexity": F.round("perplexity", 4)})


@query
def unigram_loss(spark, sf):
    """Counts of the training split's tokens; losses of the other splits' whole texts by them."""
    texts = to_training_text(_split_chats(spark, sf), "tagged")
    tokens = texts.select("split", token_list(F.col("text")).alias("tokens"))
    model = fit_unigram(tokens.where("split = 'train'"))
    losses = unigram_losses(tokens.where("split <> 'train'"), model, keep=["split"])
    found = evaluate_loss(losses, F.col("loss"), by=["split"])
    return found.withColumns({"loss": F.round("loss", 6), "perplexity": F.round("perplexity", 3)})


@query
def vocabulary_tokens(spark, sf):
    """All turns as tokens of a vocabulary table: the words and characters of the benchmark, numbered by a hash."""
    texts = table(spark, sf, "benchmark").select("text")
    words = texts.select(F.explode(F.concat(token_list(F.col("text")), F.split("text", ""))).alias("token")).distinct()
    number = F.conv(F.substring(F.sha1("token"), 1, 7), 16, 10).cast("int")
    vocabulary = Vocabulary.of(words.select("token", number.alias("id")))
    turns = table(spark, sf, "conversations")
    ids = turns.select("conv_id", "turn", token_ids(F.col("text"), vocabulary).alias("ids"))
    return ids.select(
        "conv_id", "turn", F.size("ids").cast("bigint").alias("tokens"), F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids")
    )


def _prompts(spark, sf):
    return table(spark, sf, "benchmark").select((F.col("item_id") + 1).alias("ord"), F.col("text").alias("prompt"))


@query
def generated_replies(spark, sf):
    """The prompts as a model gets them, and the replies cut out of the whole chats that it gives back, as a table has them."""
    prompts = build_prompts(_prompts(spark, sf))
    answer = F.struct(F.lit("assistant").alias("role"), F.concat(F.lit(" You said: "), F.col("prompt"), F.lit("\n")).alias("content"))
    outputs = prompts.withColumn("generated", F.concat("chat", F.array(answer)))
    return extract_replies(outputs).select("ord", "model_input", "reply")


def _runs(spark, sf):
    """Replies of two runs, as a table has them."""
    prompts, text = _prompts(spark, sf), strip(F.col("prompt"))
    base = prompts.withColumn("reply", F.concat(F.lit("You said: "), text))
    return base, prompts.withColumn("reply", F.replace(text, F.lit(" "), F.lit("-")))


@query
def generation_speed(spark, sf):
    """Latencies stand in the table; some are zero."""
    timed = _runs(spark, sf)[1].withColumn("latency_sec", (F.col("ord") % 5) / 8)
    return generation_benchmark(timed).withColumn("tokens_per_sec", F.round("tokens_per_sec", 3))


@query
def generation_summary(spark, sf):
    """The speeds of two runs as one row each; latencies stand in the table."""
    latency = (F.col("ord") % 5) / 8
    runs = zip(("base", "tuned"), _runs(spark, sf), strict=True)
    timed = [df.withColumn("latency_sec", latency).withColumn("run", F.lit(name)) for name, df in runs]
    speeds = generation_benchmark(timed[0].unionByName(timed[1]), keep=["run"])
    found = speed_summary(speeds, ["run"])
    return found.withColumns({c: F.round(c, 6) for c in ("avg_latency_sec", "p95_latency_sec", "tokens_per_sec")})


@query
def compared_runs(spark, sf):
    return compare_runs(*_runs(spark, sf))


@query
def comparison_report(spark, sf):
    return compare_markdown(compare_runs(*_runs(spark, sf)))


def _talks(spark, sf):
    return table(spark, sf, "conversations").withColumn(
        "text", F.when((F.col("conv_id") + F.col("turn")) % 6 == 4, F.lit(" \u3000")).otherwise(F.concat(F.lit("\t"), F.col("text")))
    )


@query
def chat_histories(spark, sf):
    history = chat_history(_talks(spark, sf))
    return history.select("conv_id", "turn", render_chat(F.col("messages")).alias("history"))


@query
def chat_points(spark, sf):
    """Histories in their compact form: each chat once, and where every user turn's history ends in it."""
    chats = chat_history(_talks(spark, sf), compact=True)
    points = F.array_join(F.transform("points", lambda p: F.concat_ws(":", p["turn"], p["upto"])), ",")
    return chats.select("conv_id", render_chat(F.col("messages")).alias("chat"), points.alias("points"))


def _lost(spark, sf):
    """Turns of which every thirteenth has lost its conversation."""
    number = F.when((F.col("conv_id") + F.col("turn")) % 13 != 5, F.col("conv_id"))
    return table(spark, sf, "conversations").withColumn("conv_id", number)


@query
def turn_runs(spark, sf):
    """Turns folded to short runs and unfolded again, with the place of each in its conversation."""
    runs = fold_runs(_lost(spark, sf), "conv_id", "turn", {"turn": "given", "role": "role", "text": "content"}, run_bytes=600)
    return unfold_runs(runs, turn="place")


@query
def lost_turns(spark, sf):
    return rejected_turns(_lost(spark, sf), "conv_id").select("missing", "turn", "role", "text")


@query
def chat_run_points(spark, sf):
    """Chats cut into short runs: every message with its place, and whether a history ends there."""
    runs = chat_runs(_talks(spark, sf), run_bytes=400)
    lines = runs.select("conv_id", "first", "points", F.posexplode("messages").alias("i", "m"))
    place = F.col("first") + F.col("i")
    ends = F.exists("points", lambda p: p["upto"] == place)
    return lines.select("conv_id", place.alias("place"), "m.role", "m.content", ends.alias("is_point"))


@query
def workflow_split(spark, sf):
    """The flagship: clean, deduplicate, convert and split, then profile each split."""
    raw = _copies(_with_empty(untidy_conversations(spark, sf)))
    done = run_workflow(raw, ["conv_id"], ["conv_id"], skip_profile=True, test=0.1, validation=0.1)
    stats = token_stats(done.dataset, max_rows=None, by=["split"])
    return stats.withColumns({"p95": F.round("p95", 6), "mean": F.round("mean", 6)})


@query
def workflow_reports(spark, sf):
    """The reports and the dataset that a workflow has saved, read back."""
    raw = _copies(_with_empty(untidy_conversations(spark, sf)))
    out = scratch_path(spark, "workflow_reports")
    run_workflow(raw, ["conv_id"], ["conv_id"], skip_training=True, test=0.1, validation=0.1, path=out)

    def saved(name: str) -> DataFrame:
        return read_report(spark, f"{out}/reports/{name}")

    parts = [
        saved("stage_counts").select(F.col("stage").alias("what"), "split", "rows"),
        saved("stats").select(F.lit("stats").alias("what"), "split", "rows"),
        saved("token_stats").select(F.lit("tokens").alias("what"), F.lit("all").alias("split"), F.col("kept").alias("rows")),
        saved("split_sizes").select(F.lit("sizes").alias("what"), "split", "rows"),
        list_splits(read_dataset(spark, f"{out}/dataset")).select(F.lit("dataset").alias("what"), "split", "rows"),
    ]
    return reduce(DataFrame.unionByName, parts)
