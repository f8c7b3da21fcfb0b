"""Cleaning: null filter, text normalisation, deduplication, conversion to chat messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.messages import (
    SHAPE_COLUMNS,
    content_key,
    has_messages,
    is_chat_pair,
    row_key,
    to_messages,
)
from parley.functions.text import nfkc, nfkc_array, tidy
from parley.sources.datasets import POSITION, SPLIT, data_fields, named, with_split

_LIST_COLUMNS = ("messages", "conversations")
_LIST_TEXTS = ("content", "value")
# Side fields that may stay beside the messages.
_SCALARS = (
    T.StringType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.NullType,
)


def remove_null(df: DataFrame, null_policy: str = "missing") -> DataFrame:
    """Keep rows that hold at least one message with text. Native, no Python hop."""
    return df.where(has_messages(df, null_policy))


def normalize_rows(df: DataFrame) -> DataFrame:
    """Normalise every string column and the texts inside message lists.

    Nulls stay null, speaker names stay as they are, null list items go.
    """
    changes: dict[str, Column] = {}
    for f in data_fields(df):
        kind = f.dataType
        if isinstance(kind, T.StringType):
            changes[f.name] = tidy(nfkc(named(f.name)))
        elif f.name in _LIST_COLUMNS and isinstance(kind, T.ArrayType):
            changes[f.name] = _normalize_list(named(f.name), kind.elementType)
    return df.withColumns(changes) if changes else df


def _normalize_list(items: Column, element: T.DataType) -> Column:
    if not isinstance(element, T.StructType):
        return F.when(items.isNotNull(), F.array().cast(T.ArrayType(element)))
    kept = F.filter(items, lambda m: m.isNotNull())
    for f in element.fields:
        if f.name in _LIST_TEXTS and isinstance(f.dataType, T.StringType):
            kept = _normalize_field(kept, f.name)
    return kept


def _normalize_field(items: Column, name: str) -> Column:
    texts = F.transform(nfkc_array(F.transform(items, lambda m: m[name])), tidy)
    return F.zip_with(items, texts, lambda m, text: m.withField(name, text))


def dedup_key(df: DataFrame) -> Column:
    """What makes two rows the same: their messages, or else all their text columns."""
    return F.coalesce(content_key(to_messages(df)), _row_text_key(df))


def remove_duplicates(
    df: DataFrame,
    order_by: Sequence[str | Column] = (POSITION,),
    key: Column | None = None,
    scope: str = "split",
) -> DataFrame:
    """Keep the first row of each key within its split, or over all with ``scope="global"``.

    The planner drops later copies inside each map task before the shuffle, so
    a key that many rows share sends at most one row per task.
    """
    if scope not in ("split", "global"):
        raise ValueError(f"scope must be 'split' or 'global', not {scope!r}")
    groups = [SPLIT] if scope == "split" and SPLIT in df.columns else []
    first = Window.partitionBy(*groups, "_key").orderBy(*order_by)
    return (
        df.withColumn("_key", dedup_key(df) if key is None else key)
        .withColumn("_nth", F.row_number().over(first))
        .where(F.col("_nth") == 1)
        .drop("_key", "_nth")
    )


def side_fields(df: DataFrame) -> list[str]:
    """Scalar columns that are no part of any input shape."""
    return [
        f.name
        for f in data_fields(df)
        if f.name not in SHAPE_COLUMNS and isinstance(f.dataType, _SCALARS)
    ]


def kept_columns(df: DataFrame, keep: Sequence[str] = (), keep_other_fields: bool = False) -> list[str]:
    """Columns that stay beside the messages: split, position, ``keep``, and scalars if asked."""
    kept = [c for c in (SPLIT, POSITION) if c in df.columns]
    others = side_fields(df) if keep_other_fields else []
    return list(dict.fromkeys([*kept, *keep, *others]))


def convert_chat(
    df: DataFrame,
    keep_other_fields: bool = False,
    keep: Sequence[str] = (),
    null_policy: str = "missing",
) -> DataFrame:
    """Rows as chat messages; rows that are no user/assistant exchange go.

    ``keep`` names columns that stay in any case, such as a row id; split and
    position always do.
    """
    kept = kept_columns(df, keep, keep_other_fields)
    # A filter would be moved below the projection and build the messages twice;
    # exploding a list of one or none builds them once.
    paired = F.filter(F.array(to_messages(df, null_policy)), is_chat_pair)
    return df.select(*kept, F.explode(paired).alias("messages"))


def stage_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per split of frames that are there already, such as written stages, in stage order.

    Every frame is read on its own; for the cleaning stages of one frame there is ``clean_counts``.
    """
    parts = [
        with_split(df)
        .groupBy(SPLIT)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(i).cast("bigint").alias("step"), F.lit(name).alias("stage"), SPLIT, "rows")
        for i, (name, df) in enumerate(stages.items())
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def message_rows(
    df: DataFrame, keep: Sequence[str] = (), keep_other_fields: bool = False, null_policy: str = "missing"
) -> DataFrame:
    """Rows as normalised ``messages``, before any of them is left out: what profiles, counts and cleaning have in common.

    ``_filled`` says whether the row, as it was given, holds messages with text; ``_row`` is the key of a row that
    does, but has no messages. Split, position, ``keep`` and, if asked, scalars stay.
    """
    df = with_split(df)
    kept = kept_columns(df, keep, keep_other_fields)
    normal = normalize_rows(df.withColumn("_filled", has_messages(df, null_policy)))
    return normal.select(
        *kept, "_filled", to_messages(normal, null_policy).alias("messages"), _row_text_key(normal).alias("_row")
    )


def clean_messages(rows: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """The cleaning stages over ``message_rows``: rows with text, the first of each key, and of those the chats."""
    key = F.coalesce(content_key(F.col("messages")), F.col("_row"))
    first = remove_duplicates(rows.where("_filled"), order_by, key=key)
    return first.where(is_chat_pair(F.col("messages"))).drop("_filled", "_row")


def clean_counts(df: DataFrame, null_policy: str = "missing") -> DataFrame:
    """Rows that each cleaning stage leaves of each split, from one pass over the rows."""
    return message_counts(message_rows(df, null_policy=null_policy))


def message_counts(rows: DataFrame) -> DataFrame:
    """``clean_counts`` of rows that are ``message_rows`` already.

    Rows are counted by split and key first, map-side, so that a text that many rows share is one row
    of the shuffle: all its rows hold messages or none does, the first of them is what deduplication
    leaves, and equal messages make a chat or none. Splits that a stage empties have 0 rows.
    """
    # Rows without messages go before any key is made, and share one.
    messages = rows.select(SPLIT, "_filled", F.col("messages").alias("_m"), "_row")
    filled = F.col("_filled")
    key = F.when(filled, F.coalesce(content_key(F.col("_m")), F.col("_row")))
    pair = filled & is_chat_pair(F.col("_m"))
    keyed = messages.select(SPLIT, filled, key.alias("_key"), pair.alias("_pair"))
    groups = keyed.groupBy(SPLIT, "_filled", "_key").agg(F.count(F.lit(1)).alias("_n"), F.max("_pair").alias("_pair"))
    counts = groups.groupBy(SPLIT).agg(
        F.sum("_n").alias("raw"),
        F.coalesce(F.sum(F.when(filled, F.col("_n"))), F.lit(0)).alias("no_null"),
        F.count_if(filled).alias("deduplicated"),
        F.count_if(F.col("_pair")).alias("chat"),
    )
    left = {"raw": "raw", "no_null": "no_null", "normalized": "no_null", "deduplicated": "deduplicated", "chat": "chat"}
    stages = [
        F.struct(F.lit(i).cast("bigint").alias("step"), F.lit(stage).alias("stage"), F.col(rows).alias("rows"))
        for i, (stage, rows) in enumerate(left.items())
    ]
    return counts.select(SPLIT, F.inline(F.array(*stages))).select("step", "stage", SPLIT, "rows")


def _row_text_key(df: DataFrame) -> Column:
    """The key of rows without messages: all their text columns."""
    return row_key(df, [f.name for f in data_fields(df) if isinstance(f.dataType, T.StringType)])


def observe_rows(df: DataFrame, stage: str, splits: Sequence[str] = ()) -> tuple[DataFrame, Observation]:
    """Count a stage's rows while they pass, without another job.

    ``observation.get`` has ``rows`` and one ``rows_<split>`` per named split
    once an action on the returned frame has run. A task that is run again, after
    the loss of its executor, may be counted again; ``clean_counts`` is exact.
    """
    seen = Observation(stage)
    per_split = [F.count_if(F.col(SPLIT) == s).alias(f"rows_{s}") for s in splits]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *per_split), seen
