"""Loss and perplexity of a scored table."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.metrics import perplexity

Score = Callable[[list[list[int]]], list[float]]
ScorerFactory = Callable[[], Score]


def score_rows(ids: Column, scorer: ScorerFactory) -> Column:
    """Loss of each row by a plugged-in model, built once per task."""

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = scorer()
        for batch in batches:
            yield pa.array(run(batch.to_pylist()), pa.float64())

    return F.arrow_udf(score, T.DoubleType()).asNondeterministic()(ids)


def evaluate_loss(
    df: DataFrame, scorer: ScorerFactory | Column, ids: str = "input_ids", by: Sequence[str] = ()
) -> DataFrame:
    """Mean loss over rows, each row counting once, and its perplexity; over all of them or per ``by``."""
    loss = scorer if isinstance(scorer, Column) else score_rows(F.col(ids), scorer)
    return (
        df.select(*by, loss.alias("loss"))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("rows"), F.avg("loss").alias("loss"))
        .withColumn("perplexity", perplexity(F.col("loss")))
    )
