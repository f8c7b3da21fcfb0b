"""Datasets with splits: reading, writing, inspecting, checking.

A dataset is one DataFrame with a ``split`` column; on disk that column is the
partition directory, so asking for a split prunes the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.constants import TRAIN

SPLIT = "split"
POSITION = "_position"


def named(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col(f"`{name.replace('`', '``')}`")


def with_split(df: DataFrame, default: str = TRAIN) -> DataFrame:
    """A frame without splits is a single ``train`` split."""
    return df if SPLIT in df.columns else df.withColumn(SPLIT, F.lit(default))


def read_dataset(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    split: str | None = None,
    schema: T.StructType | str | None = None,
    position: bool = False,
) -> DataFrame:
    """Open a saved dataset, or one split of it.

    ``position=True`` (parquet only) adds the stored order of rows, file by
    file in the order of their part numbers, as a sortable column for operators
    where the first row wins. Split names are read as they were written, also
    those that look like numbers.
    """
    reader = spark.read.format(fmt)
    if schema is None:
        found = reader.load(path).schema
        kinds = [T.StructField(SPLIT, T.StringType()) if f.name == SPLIT else f for f in found]
        schema = T.StructType(kinds)
        if found == schema:
            schema = None
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if position:
        file = F.col("_metadata.file_path")
        number = F.regexp_extract(file, r"part-([0-9]+)[^/]*$", 1)
        place = F.struct(
            F.when(number != "", number.cast("bigint")).alias("part"),
            file.alias("file"),
            F.col("_metadata.row_index").alias("row"),
        )
        df = df.withColumn(POSITION, place)
    df = with_split(df)
    return df if split is None else df.where(F.col(SPLIT) == split)


def write_dataset(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Save a dataset, one directory per split; no shuffle."""
    writer = df.drop(POSITION).write.mode(mode).format(fmt)
    if SPLIT in df.columns:
        writer = writer.partitionBy(SPLIT)
    writer.save(path)


def list_splits(df: DataFrame) -> DataFrame:
    """Each split and its number of rows."""
    return with_split(df).groupBy(SPLIT).agg(F.count(F.lit(1)).alias("rows"))


def data_fields(df: DataFrame) -> list[T.StructField]:
    """The dataset's own columns, without split and position."""
    return [f for f in df.schema.fields if f.name not in (SPLIT, POSITION)]


def split_columns(df: DataFrame) -> DataFrame:
    """The columns of each split, in order, with their types."""
    fields = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
            for f in data_fields(df)
        ]
    )
    return (
        list_splits(df)
        .select(SPLIT, F.posexplode(fields).alias("ordinal", "field"))
        .select(SPLIT, F.col("ordinal").cast("bigint").alias("ordinal"), "field.column", "field.type")
    )


def read_jsonl(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines; blank lines are skipped, a malformed line is an error."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader.schema(schema) if schema is not None else reader).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per row, nulls and non-ASCII text kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Save a small report (a few aggregated rows) as a single JSON file.

    ``repartition`` rather than ``coalesce``, so that whatever computes the
    report keeps its own parallelism.
    """
    df.repartition(1).write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_report(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None
) -> DataFrame:
    """Load a saved report."""
    return read_jsonl(spark, path, schema)


def verify_dataset(
    df: DataFrame,
    required_columns: Sequence[str],
    required_splits: Sequence[str] = (TRAIN,),
) -> DataFrame:
    """Check a dataset in one aggregation: every split has rows, every column is there and filled.

    One row per rule: ``rule, split, subject, rows, failures, passed``.
    """
    df = with_split(df)
    sums: list[Column] = []
    rules: list[Column] = []

    def rule(name: str, split: str, subject: str, rows: Column, failures: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"),
            F.lit(split).alias("split"),
            F.lit(subject).alias("subject"),
            rows.alias("rows"),
            failures.alias("failures"),
            (failures == 0).alias("passed"),
        )

    for s, split in enumerate(required_splits):
        inside = F.col(SPLIT) == split
        rows = f"rows_{s}"
        sums.append(F.count_if(inside).alias(rows))
        empty = (F.col(rows) == 0).cast("bigint")
        rules.append(rule("has_rows", split, split, F.col(rows), empty))
        for c, column in enumerate(required_columns):
            missing = F.col(column).isNull() if column in df.columns else F.lit(True)
            nulls = f"nulls_{s}_{c}"
            sums.append(F.count_if(inside & missing).alias(nulls))
            rules.append(rule("column_filled", split, column, F.col(rows), F.col(nulls)))
    return df.agg(*sums).select(F.inline(F.array(*rules)))
