"""Batch generation: replies, timings, side-by-side comparison, chat histories."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import (
    ASSISTANT,
    CHAT_SYSTEM_PROMPT,
    COMPARE_TITLE,
    MAX_NEW_TOKENS,
    MIN_LATENCY_SEC,
    SYSTEM,
    USER,
)
from parley.functions.messages import MESSAGES, ChatTemplate, extract_reply, render_chat
from parley.functions.text import strip
from parley.functions.tokens import TokenizerFactory, token_count
from parley.operators.turns import fold_turns
from parley.session import materialize

# Answers a list of messages with a text, or with the whole chat as messages.
Reply = Callable[[list[dict], int], "str | list[dict]"]
GeneratorFactory = Callable[[], Reply]

_GENERATED = T.StructType().add("generated", MESSAGES).add("latency_sec", T.DoubleType())
_ARROW_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("content", pa.string())]))


def _generate_udf(generator: GeneratorFactory, max_new_tokens: int):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reply = generator()
        for batch in batches:
            chats, seconds = [], []
            for messages in batch.to_pylist():
                start = time.perf_counter()
                out = reply(messages, max_new_tokens)
                seconds.append(time.perf_counter() - start)
                chats.append([{"role": ASSISTANT, "content": out}] if isinstance(out, str) else out)
            yield pa.StructArray.from_arrays(
                [pa.array(chats, _ARROW_MESSAGES), pa.array(seconds, pa.float64())],
                ["generated", "latency_sec"],
            )

    return F.arrow_udf(run, _GENERATED).asNondeterministic()


def user_message(prompt: Column) -> Column:
    """A prompt as a chat of one user message."""
    return F.array(F.struct(F.lit(USER).alias("role"), prompt.alias("content")))


def generate(
    df: DataFrame,
    generator: GeneratorFactory,
    prompt: str = "prompt",
    max_new_tokens: int = MAX_NEW_TOKENS,
    partitions: int | None = None,
) -> DataFrame:
    """Add each row's ``reply`` and ``latency_sec``.

    ``prompt`` is a text column or a ``messages`` column. The generator is
    built once per task. ``partitions`` spreads a small prompt table over the
    cluster. Write the result before using it twice, or the model runs twice.
    """
    if partitions:
        df = df.repartition(partitions)
    chat = F.col(prompt) if isinstance(df.schema[prompt].dataType, T.ArrayType) else user_message(F.col(prompt))
    out = df.withColumn("_out", _generate_udf(generator, max_new_tokens)(chat)).select(
        *df.columns, "_out.generated", "_out.latency_sec"
    )
    return out.withColumn("reply", extract_reply(out, "generated")).drop("generated")


def build_prompts(
    df: DataFrame, prompt: str = "prompt", system: str | None = None, template: str | ChatTemplate = "chatml"
) -> DataFrame:
    """Add ``chat``, the messages that a model is asked with, and ``model_input``, the same as it reads them. Native.

    ``prompt`` is a text column or a ``messages`` column; ``system`` opens every chat.
    """
    chat = F.col(prompt) if isinstance(df.schema[prompt].dataType, T.ArrayType) else user_message(F.col(prompt))
    if system is not None:
        chat = F.concat(F.array(F.struct(F.lit(SYSTEM).alias("role"), F.lit(system).alias("content"))), chat)
    return df.withColumn("chat", chat).withColumn("model_input", render_chat(F.col("chat"), template, add_generation_prompt=True))


def extract_replies(df: DataFrame, generated: str = "generated") -> DataFrame:
    """Add ``reply`` from what a model gave back: its text, or the last message of the whole chat. Native."""
    return df.withColumn("reply", extract_reply(df, generated))


def speed_summary(speeds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average and 95th percentile of latency, and tokens per second in all, of a ``generation_benchmark``; one row, or one per ``by``."""
    total = F.sum("generated_tokens")
    return speeds.groupBy(*by).agg(
        F.count(F.lit(1)).alias("prompts"),
        F.avg("latency_sec").alias("avg_latency_sec"),
        F.percentile("latency_sec", F.lit(0.95)).alias("p95_latency_sec"),
        total.alias("generated_tokens"),
        (total / F.greatest(F.sum("latency_sec"), F.lit(MIN_LATENCY_SEC))).alias("tokens_per_sec"),
    )


def generation_benchmark(
    df: DataFrame, prompt: str = "prompt", tokenizer: str | TokenizerFactory = "words", keep: Sequence[str] = ()
) -> DataFrame:
    """Per prompt: latency, generated tokens, tokens per second."""
    timed = df.select(*keep, prompt, "latency_sec", token_count(F.col("reply"), tokenizer).alias("generated_tokens"))
    speed = F.col("generated_tokens") / F.greatest(F.col("latency_sec"), F.lit(MIN_LATENCY_SEC))
    return timed.withColumn("tokens_per_sec", speed)


def compare_runs(base: DataFrame, tuned: DataFrame, on: str = "ord", prompt: str = "prompt") -> DataFrame:
    """Replies of two runs over the same prompts, side by side."""
    left = base.select(on, prompt, F.col("reply").alias("base"))
    right = tuned.select(on, F.col("reply").alias("tuned"))
    return left.join(right, on)


def compare_markdown(df: DataFrame, on: str = "ord", prompt: str = "prompt") -> DataFrame:
    """The comparison as Markdown blocks; ``ord`` counts the cases from 1, 0 is the title."""
    case = F.concat(
        F.lit("## Case "),
        F.col(on).cast("string"),
        F.lit("\n\n**Prompt**\n\n"),
        F.col(prompt),
        F.lit("\n\n**Base**\n\n"),
        F.col("base"),
        F.lit("\n\n**Tuned**\n\n"),
        F.col("tuned"),
        F.lit("\n"),
    )
    title = df.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias(on), F.lit(COMPARE_TITLE + "\n").alias("value")
    )
    return title.unionByName(df.select(F.col(on).cast("bigint").alias(on), case.alias("value")))


def write_comparison(df: DataFrame, path: str, on: str = "ord", prompt: str = "prompt") -> None:
    """Save the Markdown report as text files whose order is the report's.

    A sort looks at its input twice; the replies are written down first so that
    the models run once.
    """
    told = compare_markdown(materialize(df, "comparison"), on, prompt)
    told.orderBy(on).select("value").write.text(path)


def chat_history(
    df: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    system: str = CHAT_SYSTEM_PROMPT,
    compact: bool = False,
) -> DataFrame:
    """For each user turn, everything said up to and including it.

    Histories repeat what was said before, so their size is quadratic in the turns. ``compact`` gives one row a
    conversation with a user turn instead: its ``messages`` once, and ``points``, which say for each user turn up to
    which message its history goes; ``slice(messages, 1, upto)`` is that history.

    A conversation without a system turn of its own starts with ``system``. It
    ends at the first blank user turn. Histories are cut from the folded
    conversation one row at a time, so no task holds more than one of them.
    """
    folded = fold_turns(df, conversation, turn, {role: "role", text: "content", turn: "at"}, "_turns")
    said = F.transform(
        "_turns",
        lambda t: F.struct(
            t["at"].alias("at"),
            t["role"].alias("role"),
            F.coalesce(strip(t["content"]), F.lit("")).alias("content"),
        ),
    )
    told = folded.select(conversation, said.alias("_turns"))
    stop = F.array_position(
        F.transform("_turns", lambda t: (t["role"] == USER) & (t["content"] == "")), True
    )
    talk = told.select(
        conversation,
        F.when(stop > 0, F.slice("_turns", F.lit(1), stop.cast("int") - 1)).otherwise(F.col("_turns")).alias("_turns"),
    )
    heard = F.transform("_turns", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    opening = F.array(F.struct(F.lit(SYSTEM).alias("role"), F.lit(system).alias("content")))
    own = F.coalesce(F.get("_turns", F.lit(0))["role"] == SYSTEM, F.lit(False))
    chats = talk.select(
        conversation,
        "_turns",
        F.when(own, heard).otherwise(F.concat(opening, heard)).alias("_chat"),
        F.when(own, 0).otherwise(1).alias("_shift"),
    )
    points = F.filter(
        F.transform(
            "_turns",
            lambda t, i: F.struct(
                t["at"].alias(turn), (i + F.col("_shift") + 1).alias("upto"), (t["role"] == USER).alias("user")
            ),
        ),
        lambda p: p["user"],
    )
    if compact:
        told = F.transform(points, lambda p: F.struct(p[turn].alias(turn), p["upto"].alias("upto")))
        return chats.select(conversation, F.col("_chat").alias("messages"), told.alias("points")).where(F.size("points") > 0)
    return chats.select(conversation, "_chat", F.explode(points).alias("_p")).select(
        conversation, F.col("_p")[turn].alias(turn), F.slice("_chat", F.lit(1), F.col("_p.upto")).alias("messages")
    )
