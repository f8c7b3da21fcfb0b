"""Fine-tuning tables: rendered texts, token ids with labels, step counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.constants import TRAIN
from parley.functions.messages import ChatTemplate, render_chat
from parley.functions.tokens import TokenizerFactory, token_ids
from parley.sources.datasets import SPLIT


def _kept(df: DataFrame, keep: Sequence[str]) -> list[str]:
    return [c for c in (SPLIT, *keep) if c in df.columns]


def to_training_text(
    df: DataFrame, template: str | ChatTemplate = "chatml", keep: Sequence[str] = ()
) -> DataFrame:
    """Messages and their rendered text; other columns go, but for split and ``keep``."""
    return df.select(
        *_kept(df, keep), "messages", render_chat(F.col("messages"), template).alias("text")
    )


def tokenize_sft(
    df: DataFrame,
    tokenizer: str | TokenizerFactory = "codepoints",
    max_length: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Token ids of ``text``, cut at ``max_length`` if one is given; every token is also a label.

    Code points are cut before they become ids.
    """
    kept = _kept(df, keep)
    text = F.col("text")
    if max_length is None:
        cut, long = token_ids(text, tokenizer), F.lit(False)
    elif tokenizer == "codepoints":
        cut, long = token_ids(F.substring(text, 1, max_length), tokenizer), F.length(text) > max_length
    else:
        cut, long = F.slice("_ids", 1, max_length), F.size("_ids") > max_length
        df = df.select(*kept, token_ids(text, tokenizer).alias("_ids"))
    ids = df.select(*kept, cut.alias("input_ids"), long.alias("was_truncated"))
    return ids.select(*kept, "input_ids", F.col("input_ids").alias("labels"), "was_truncated")


def training_plan(
    df: DataFrame,
    batch: int = 1,
    accumulation: int = 8,
    epochs: float = 1.0,
    warmup_ratio: float = 0.03,
) -> DataFrame:
    """Optimizer steps for the training split: per epoch, in total, for warm-up."""
    effective = max(1, batch * accumulation)
    rows = df.where(F.col(SPLIT) == TRAIN) if SPLIT in df.columns else df
    counted = rows.agg(F.count(F.lit(1)).alias("train_rows"))
    per_epoch = F.greatest(F.lit(1), F.ceil(F.col("train_rows") / effective))
    total = F.greatest(F.lit(1), F.ceil(F.col("steps_per_epoch") * F.lit(float(epochs))))
    return (
        counted.withColumn("effective_batch", F.lit(effective).cast("bigint"))
        .withColumn("steps_per_epoch", per_epoch.cast("bigint"))
        .withColumn("total_steps", total.cast("bigint"))
        .withColumn("warmup_steps", F.floor(F.col("total_steps") * F.lit(float(warmup_ratio))).cast("bigint"))
    )
