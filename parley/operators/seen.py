"""Deduplication across runs: a bucketed table of the keys that earlier batches have had."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.clean import dedup_key, remove_duplicates
from parley.session import materialize
from parley.sources.datasets import POSITION, SPLIT

#: Folders of the key table; a join deals out new rows by these and leaves the old keys where they are.
BUCKETS = 256


class SeenKeys:
    """The keys of all batches so far, below ``path``, in ``buckets`` by their hash.

    Each batch appends one file a bucket. Asking which rows of a batch are new shuffles the batch's keys
    only, to the buckets' number of tasks: the old keys are read bucket by bucket. The table is known to the session's
    catalog under a name made from its path and can be opened again in any later session with the same ``buckets``.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.name = f"seen_{hashlib.sha1(self.path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (_key STRING) USING parquet "
            f"CLUSTERED BY (_key) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def keys(self) -> DataFrame:
        return self.spark.table(self.name)

    def fresh(
        self,
        df: DataFrame,
        order_by: Sequence[str | Column] = (POSITION,),
        key: Column | None = None,
        scope: str = "split",
    ) -> DataFrame:
        """The first row of each key of ``df`` that no earlier batch has had, with its ``_key``, written down.

        As in one run over all batches, the first row wins: earlier batches come first, then ``order_by``. Keys count
        within their split, or over all with ``scope="global"``. Save the rows, then ``add`` them; a run that
        fails before that can be repeated.
        """
        own = dedup_key(df) if key is None else key
        if scope == "split" and SPLIT in df.columns:
            # A null split is one of its own; the length tells where the split's name ends.
            name = F.coalesce(F.concat_ws(":", F.length(SPLIT).cast("string"), F.col(SPLIT)), F.lit("-"))
            own = F.concat_ws(":", F.when(F.col(SPLIT).isNull(), F.lit("-")).otherwise(name), own)
        # Copies within the batch go first, map-side, so that a key of many rows meets the table once.
        first = remove_duplicates(df.withColumn("_seen", own), order_by, F.col("_seen"), "global")
        unseen = first.withColumnRenamed("_seen", "_key").join(self.keys(), "_key", "left_anti")
        return materialize(unseen, "fresh")

    def add(self, fresh: DataFrame) -> None:
        """Append the keys of rows that ``fresh`` has given."""
        keys = fresh.select("_key").repartition(self.buckets, "_key")
        writer = keys.write.mode("append").format("parquet").bucketBy(self.buckets, "_key").option("path", self.path)
        writer.saveAsTable(self.name)
