"""A unigram model of tokens, counted over a table, and the loss of other rows by it.

The model is a table of counts that may have any number of tokens, so rows meet
their counts in a join. A token that is in every row would send all of them to
one task; tokens as common as that are few, by their share, and are
joined where the rows are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.session import materialize

# A token with more than this part of all training tokens is a common one: there are fewer such tokens than this.
_COMMON = 4_096


@dataclass
class UnigramModel:
    """``counts`` has a row for each ``token`` with its ``count``; ``tokens`` and ``types`` are their sum and number."""

    counts: DataFrame
    tokens: int
    types: int

    def common(self) -> DataFrame:
        """The tokens whose counts are joined by broadcast: each has more than one in ``_COMMON`` of all."""
        return self.counts.where(F.col("count") * _COMMON > self.tokens)

    def rare(self) -> DataFrame:
        return self.counts.where(F.col("count") * _COMMON <= self.tokens)


def fit_unigram(df: DataFrame, tokens: str = "tokens") -> UnigramModel:
    """Count all tokens of a column of lists, map-side first; null lists and null tokens count for nothing."""
    stream = df.select(F.explode(F.col(tokens)).alias("token")).where("token IS NOT NULL")
    counts = materialize(stream.groupBy("token").agg(F.count(F.lit(1)).alias("count")), "unigram-counts")
    total = counts.agg(F.sum("count").alias("tokens"), F.count(F.lit(1)).alias("types")).first()
    return UnigramModel(counts, total["tokens"] or 0, total["types"])


def unigram_losses(df: DataFrame, model: UnigramModel, tokens: str = "tokens", keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep``, ``n_tokens`` and ``loss`` of every row: its tokens' mean negative log probability.

    Counts are raised by one, and one place is left for tokens that training has not seen. A row
    without tokens has a null loss. Rows with equal columns stay rows of their own.
    """
    row = F.monotonically_increasing_id().alias("_row")
    rows = materialize(df.select(*keep, row, F.col(tokens).alias("_tokens")), "unigram-rows")
    stream = rows.select("_row", F.explode("_tokens").alias("token")).where("token IS NOT NULL")
    told = stream.join(F.broadcast(model.common()), "token", "left")
    near = told.where("count IS NOT NULL")
    far = told.where("count IS NULL").select("_row", "token").join(model.rare(), "token", "left")
    everything = float(model.tokens + model.types + 1)
    surprise = F.log(F.lit(everything) / (F.coalesce("count", F.lit(0)) + 1))
    parts = [
        part.groupBy("_row").agg(F.count(F.lit(1)).alias("n"), F.sum(surprise).alias("sum")) for part in (near, far)
    ]
    sums = parts[0].unionByName(parts[1]).groupBy("_row").agg(F.sum("n").alias("n_tokens"), F.sum("sum").alias("sum"))
    found = rows.drop("_tokens").join(sums, "_row", "left")
    return found.select(*keep, F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), (F.col("sum") / F.col("n_tokens")).alias("loss"))
