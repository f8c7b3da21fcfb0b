"""Inputs of the registered queries: the given tables, and untidy versions of them.

The given texts are clean, so an operator that did nothing would pass. These
functions derive untidy rows from the whole tables; the comparison SQL states
what must come out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.turns import fold_turns

ASCII = "".join(map(chr, range(0x20, 0x7F)))
FULL_WIDTH = "\u3000" + "".join(map(chr, range(0xFF01, 0xFF5F)))

# Speaker names per role; a conversation uses the column conv_id % 4.
SPEAKERS = {
    "user": ("Human", "玩家", "张三", "主角小明"),
    "assistant": ("GPT", "ＮＰＣ", "李四", "旁白者"),
    "system": ("system", "欢迎词", "系统设定", "开场白"),
}
# Raw speaker names and the role each must get.
NAMES = (
    ("Human", "user"),
    ("ＮＰＣ", "assistant"),
    ("玩家", "user"),
    ("系统", "assistant"),
    ("欢迎词", "system"),
    ("系统设定", "system"),
    ("旁白", "assistant"),
    ("旁白者", "assistant"),
    ("主角小明", "user"),
    ("张三", "user"),
    (" GPT\t", "assistant"),
    ("", "user"),
    (None, "user"),
    ("WELCOME", "system"),
    ("开场白", "system"),
    ("叙述者", "assistant"),
    ("用户A", "user"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, read as the session's reader settings cut them."""
    return table(spark, sf_dir, "documents")


def widen(text: Column) -> Column:
    """ASCII characters as their full-width forms."""
    return F.translate(text, ASCII, FULL_WIDTH)


def untidy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, each untidy in one of five ways."""
    text = F.col("text")
    untidy = (
        F.when(F.col("doc_id") % 5 == 0, widen(text))
        .when(F.col("doc_id") % 5 == 1, F.replace(text, F.lit(" "), F.lit(" \t ")))
        .when(F.col("doc_id") % 5 == 2, F.replace(text, F.lit("e"), F.lit("e\u200b")))
        .when(F.col("doc_id") % 5 == 3, F.concat(F.lit("\u3000\n "), F.replace(text, F.lit("\n"), F.lit("\n\n\n\n"))))
        .otherwise(F.concat(F.lit("\ufeff \u00a0"), text, F.lit("\u2003\t")))
    )
    return documents(spark, sf_dir).withColumn("text", untidy)


def untidy_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with free speaker names, untidy texts and some blank turns."""
    which = (F.col("conv_id") % 4).cast("int")
    speaker = F.get(F.array(*map(F.lit, SPEAKERS["system"])), which)
    for role in ("user", "assistant"):
        speaker = F.when(F.col("role") == role, F.get(F.array(*map(F.lit, SPEAKERS[role])), which)).otherwise(speaker)
    text = F.col("text")
    untidy = (
        F.when((F.col("conv_id") * 7 + F.col("turn")) % 9 == 4, F.lit("\u3000 \u200b\n"))
        .when((F.col("conv_id") + F.col("turn")) % 3 == 0, widen(text))
        .when((F.col("conv_id") + F.col("turn")) % 3 == 1, F.concat(F.lit("\ufeff  "), text, F.lit("\n\u3000")))
        .otherwise(F.replace(text, F.lit(" "), F.lit("\t ")))
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", speaker.alias("speaker"), untidy.alias("text")
    )


def untidy_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The untidy turns folded to ``conversations`` lists."""
    return fold_turns(untidy_turns(spark, sf_dir), "conv_id", "turn", {"speaker": "from", "text": "value"})


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given conversations folded to ``messages`` lists."""
    turns = table(spark, sf_dir, "conversations")
    return fold_turns(turns, "conv_id", "turn", {"role": "role", "text": "content"}, "messages")


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn with the turn that follows it; some answers blank, some extras missing."""
    turns = table(spark, sf_dir, "conversations")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    third = F.col("conv_id") % 3
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id",
        "turn",
        F.concat(F.lit(" \u3000"), F.col("text")).alias("said"),
        F.when(third == 0, F.col("role")).when(third == 1, F.lit(" \u200b")).alias("extra"),
        F.when((F.col("conv_id") + F.col("turn")) % 5 == 0, F.lit("\t")).otherwise(widen("next_text")).alias("answer"),
    )
