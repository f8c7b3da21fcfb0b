"""Between a long table of turns and one row per conversation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fold_turns(
    df: DataFrame,
    conversation: str | Sequence[str],
    turn: str,
    fields: dict[str, str],
    name: str = "conversations",
) -> DataFrame:
    """One row per conversation with its turns, in order, as a list of structs.

    ``fields`` maps source columns to struct fields, such as
    ``{"role": "from", "text": "value"}``. Lists are built map-side first, so
    one shuffle moves each turn once. Turns without a conversation belong to
    none and are left out. A conversation becomes one row, so it must fit into one.
    """
    keys = [conversation] if isinstance(conversation, str) else list(conversation)
    packed = F.struct(F.col(turn), *[F.col(c).alias(f) for c, f in fields.items()])
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    folded = df.groupBy(*keys).agg(F.array_sort(F.collect_list(packed)).alias(name))
    plain = F.transform(name, lambda t: F.struct(*[t[f].alias(f) for f in fields.values()]))
    return folded.withColumn(name, plain)


def unfold_turns(df: DataFrame, name: str = "messages", turn: str = "turn") -> DataFrame:
    """One row per message: the other columns, its position, its fields. No shuffle."""
    kept = [c for c in df.columns if c != name]
    # An expression, not a bare column: for a column the planner adds a filter on its size, moves it
    # below the projection that makes the messages, and so makes them twice.
    items = F.coalesce(F.col(f"`{name}`"), F.lit(None).cast(df.schema[name].dataType), F.array().cast(df.schema[name].dataType))
    return (
        df.select(*kept, F.posexplode(items).alias(turn, "_message"))
        .select(*kept, F.col(turn).cast("bigint").alias(turn), "_message.*")
    )
