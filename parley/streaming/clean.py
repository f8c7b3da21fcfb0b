"""The stateless cleaning steps on a stream of examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from parley.operators.clean import convert_chat, normalize_rows, remove_null


def clean_stream(df: DataFrame, keep_other_fields: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Null filter, normalisation and conversion of a streaming frame.

    All three look at one row at a time, so they hold no state. Deduplication
    and exact splitting need the whole dataset and stay batch operators.
    """
    return convert_chat(normalize_rows(remove_null(df)), keep_other_fields, keep)
