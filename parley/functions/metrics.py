"""Scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.constants import MAX_LOSS


def perplexity(loss: Column) -> Column:
    """exp(loss); infinite if the loss is missing, not a number or 100 and above."""
    usable = ~F.isnan(loss) & (loss < MAX_LOSS)
    return F.when(usable, F.exp(loss)).otherwise(F.lit(float("inf")))
