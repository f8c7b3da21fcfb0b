"""Profiles: dataset facts, token statistics, length histograms.

Lengths are first counted per distinct value, map-side. What follows works on
that small table, whose size depends on the longest text, not on the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import (
    HISTOGRAM_BINS,
    PREVIEW_COLUMNS,
    PREVIEW_ROWS,
)
from parley.functions.messages import ChatTemplate, render_chat, to_messages
from parley.functions.text import char_length
from parley.functions.tokens import TokenizerFactory, token_count
from parley.operators.splits import head_per_split
from parley.sources.datasets import POSITION, SPLIT, data_fields, list_splits, with_split

# Size of a quantile sketch, and its rank error with 99 % confidence: about 1.3 % for 200, less for larger ones.
SKETCH_SIZE, SKETCH_ERROR = 800, 0.005

# Type names used in the dataset profile.
_TYPE_NAMES = (
    (T.StringType, "str"),
    (T.BooleanType, "bool"),
    (T.IntegralType, "int"),
    (T.FractionalType, "float"),
    (T.ArrayType, "list"),
    (T.StructType, "dict"),
    (T.MapType, "dict"),
    (T.NullType, "NoneType"),
)


def _type_name(kind: T.DataType) -> str:
    return next((name for cls, name in _TYPE_NAMES if isinstance(kind, cls)), kind.simpleString())


def dataset_stats(df: DataFrame) -> DataFrame:
    """Per split: rows, column names, string columns, number of columns per type.

    Types come from the schema, so empty splits and null first rows do no harm.
    """
    fields = data_fields(df)
    types: dict[str, int] = {}
    for f in fields:
        types[_type_name(f.dataType)] = types.get(_type_name(f.dataType), 0) + 1
    strings = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    type_map = F.create_map(*[F.lit(v) for kv in types.items() for v in kv])
    return list_splits(df).select(
        SPLIT,
        "rows",
        F.array(*[F.lit(f.name) for f in fields]).alias("columns"),
        F.array(*[F.lit(n) for n in strings]).cast("array<string>").alias("string_columns"),
        type_map.cast("map<string,bigint>").alias("column_types"),
    )


def preview(
    df: DataFrame,
    rows: int = PREVIEW_ROWS,
    columns: int = PREVIEW_COLUMNS,
    order_by: Sequence[str] = (POSITION,),
) -> DataFrame:
    """The first rows and columns of each split; other columns are not even read."""
    shown = [f.name for f in data_fields(df)[:columns]]
    extra = [c for c in order_by if c not in shown]
    slim = with_split(df).select(SPLIT, *shown, *extra)
    return head_per_split(slim, rows, order_by).drop(*extra)


def text_lengths(
    df: DataFrame,
    tokenizer: str | TokenizerFactory = "words",
    template: str | ChatTemplate = "tagged",
    max_rows: int | None = None,
    order_by: Sequence[str] = (POSITION,),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Character and token length of each row's rendered chat; null if it has no messages.

    All rows count, unless ``max_rows`` asks for the first rows of each split only.
    """
    if max_rows is not None:
        df = head_per_split(df, max_rows, order_by)
    return message_lengths(df.select(*keep, to_messages(df).alias("messages")), tokenizer, template, keep)


def message_lengths(
    df: DataFrame,
    tokenizer: str | TokenizerFactory = "words",
    template: str | ChatTemplate = "tagged",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``text_lengths`` of rows that have their ``messages`` already."""
    texts = df.select(*keep, render_chat(F.col("messages"), template).alias("_text"))
    return texts.select(
        *keep,
        char_length(F.col("_text")).alias("char_length"),
        token_count(F.col("_text"), tokenizer).alias("token_length"),
    )


def length_stats(lengths: DataFrame, column: str = "token_length", by: Sequence[str] = ()) -> DataFrame:
    """Rows seen and kept, and count, min, 95th percentile, max and mean of a length column.

    The percentile is exact, with linear interpolation.
    """
    counted = lengths.groupBy(*by, F.col(column).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    known = F.when(F.col("_v").isNotNull(), F.col("_n"))
    total = F.coalesce(F.sum(known), F.lit(0)).cast("bigint")
    return counted.groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("seen"),
        total.alias("kept"),
        total.alias("count"),
        F.min("_v").alias("min"),
        F.percentile("_v", F.lit(0.95), F.col("_n")).alias("p95"),
        F.max("_v").alias("max"),
        (F.sum(F.col("_v") * F.col("_n")) / F.nullif(F.sum(known), F.lit(0))).alias("mean"),
    )


def length_sketches(
    lengths: DataFrame, column: str = "token_length", by: Sequence[str] = (SPLIT,), groups: int = 16
) -> DataFrame:
    """Mergeable summaries of a length column: one row for each ``by`` and each of ``groups`` groups of rows.

    A row has what ``merge_sketches`` needs to answer for any union of rows without the texts: how many rows were seen
    and kept, their sum, least and most, and a quantile sketch of some kilobytes, whatever the number of
    rows. Save the table, and sketch only what is new: sketches of later rows are further rows of it.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(groups)).cast("bigint").alias("part")
    value = F.col(column).cast("bigint")
    return lengths.select(*by, group, value.alias("_v")).groupBy(*by, "part").agg(
        F.count(F.lit(1)).alias("seen"),
        F.count("_v").alias("kept"),
        F.sum("_v").alias("sum"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        F.kll_sketch_agg_bigint("_v", F.lit(SKETCH_SIZE)).alias("sketch"),
    )


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The statistics of ``length_stats`` from saved sketches, pooled or per ``by``.

    All but ``p95`` are exact; its rank is off by ``SKETCH_ERROR`` of all rows at most, in 99 of 100 cases.
    """
    filled = F.when(F.col("kept") > 0, F.col("sketch"))
    merged = sketches.groupBy(*by).agg(
        F.coalesce(F.sum("seen"), F.lit(0)).alias("seen"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"),
        F.min("min").alias("min"),
        F.kll_merge_agg_bigint(filled, F.lit(SKETCH_SIZE)).alias("sketch"),
        F.max("max").alias("max"),
        F.sum("sum").alias("sum"),
    )
    quantile = F.when(F.col("kept") > 0, F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.95)))
    return merged.select(
        *by,
        "seen",
        "kept",
        F.col("kept").alias("count"),
        "min",
        quantile.cast("double").alias("p95"),
        "max",
        (F.col("sum") / F.nullif(F.col("kept"), F.lit(0))).alias("mean"),
    )


def token_stats(
    df: DataFrame,
    max_rows: int | None = None,
    tokenizer: str | TokenizerFactory = "words",
    template: str | ChatTemplate = "tagged",
    order_by: Sequence[str] = (POSITION,),
    by: Sequence[str] = (),
    approx: bool = False,
) -> DataFrame:
    """Token length statistics of a dataset, pooled over splits or per ``by``.

    ``approx`` takes the percentile from sketches, whose size does not depend on how many lengths there are.
    """
    lengths = text_lengths(df, tokenizer, template, max_rows, order_by, keep=by)
    if approx:
        return merge_sketches(length_sketches(lengths, "token_length", by), by)
    return length_stats(lengths, "token_length", by)


def length_counts(lengths: DataFrame) -> DataFrame:
    """How many character and token lengths there are."""
    return lengths.agg(
        F.count("char_length").alias("char_count"), F.count("token_length").alias("token_count")
    )


def length_histogram(
    lengths: DataFrame,
    columns: Sequence[str] = ("char_length", "token_length"),
    bins: int = HISTOGRAM_BINS,
) -> DataFrame:
    """Equal-width histograms of length columns, empty bins included, in one pass.

    Bins are closed on the left, the last one on both sides; where all values
    are equal the range is half a unit to either side.
    """
    series = F.explode(
        F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).alias("value")) for c in columns])
    )
    counted = (
        lengths.select(series.alias("s"))
        .select("s.series", F.col("s.value").cast("bigint").alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("series", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    whole = Window.partitionBy("series")
    least, most = F.min("value").over(whole), F.max("value").over(whole)
    half = F.when(least == most, 0.5).otherwise(0.0)
    ranged = counted.select(
        "series",
        "value",
        "n",
        (least - half).alias("low"),
        (most + half).alias("high"),
        (F.col("value") == least).alias("first"),
    )
    low, high, value = F.col("low"), F.col("high"), F.col("value")
    step = (high - low) / F.lit(bins)

    def edge(i):
        return F.when(i == bins, high).otherwise(i * step + low)

    guess = F.least(F.floor((value - low) / (high - low) * F.lit(bins)), F.lit(bins - 1))
    # Edges are rounded numbers: a value lies where its edges say, not where division says.
    down = guess - F.when(value < edge(guess), 1).otherwise(0)
    bin_ = down + F.when((value >= edge(down + 1)) & (down < bins - 1), 1).otherwise(0)

    def entry(i, n):
        return F.struct(i.cast("bigint").alias("bin"), n.cast("bigint").alias("rows"))

    own = F.array(entry(bin_, F.col("n")))
    empty = F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: entry(i, F.lit(0)))
    filled = F.when(F.col("first"), F.concat(own, empty)).otherwise(own)
    at = F.col("bin")
    return (
        ranged.select("series", "low", "high", F.inline(filled))
        .groupBy("series", "low", "high", "bin")
        .agg(F.sum("rows").alias("rows"))
        .select(
            "series",
            (at + 1).alias("bin"),
            edge(at).alias("bin_low"),
            edge(at + 1).alias("bin_high"),
            "rows",
        )
    )
