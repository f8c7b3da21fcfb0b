"""Stages that are saved with a manifest, so that a second run skips what a first one finished."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import is_dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_MANIFEST = "stage string, mark string, path string, rows long, schema string"


def _told(value: object) -> object:
    """An argument as a manifest knows it; functions by their names."""
    if isinstance(value, str | int | float | bool | None):
        return value
    return repr(value) if is_dataclass(value) else getattr(value, "__qualname__", type(value).__qualname__)


class Stages:
    """Stages below ``path``. A stage's manifest is written last and names what it was made from.

    ``mark`` stands for the input's files and all arguments: a manifest with another mark is as good as
    none, so changed arguments or further input files run a stage anew, in a new folder. Rows are counted from the
    footers of what was committed: tasks that ran twice do not count twice.
    """

    def __init__(self, spark: SparkSession, path: str, inputs: Sequence[str], arguments: Mapping[str, object]):
        self.spark, self.path = spark, path.rstrip("/")
        told = {k: [_told(x) for x in v] if isinstance(v, list | tuple) else _told(v) for k, v in arguments.items()}
        self.mark = hashlib.sha256(json.dumps([sorted(inputs), told], sort_keys=True).encode()).hexdigest()

    def manifest(self, stage: str):
        """The manifest of a finished stage, or None."""
        place = f"{self.path}/manifests/{stage}"
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        if not done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done):
            return None
        rows = self.spark.read.schema(_MANIFEST).json(place).collect()
        return rows[0] if rows and rows[0]["mark"] == self.mark else None

    def commit(self, stage: str, path: str, rows: int | None = None, schema: T.StructType | None = None) -> None:
        row = (stage, self.mark, path, rows, schema.json() if schema is not None else None)
        told = self.spark.createDataFrame([row], _MANIFEST).coalesce(1)
        told.write.mode("overwrite").json(f"{self.path}/manifests/{stage}")

    def table(self, stage: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` gives, written once; of a finished stage it is read and ``build`` is not called."""
        done = self.manifest(stage)
        if done is None:
            df = build()
            place = f"{self.path}/stages/{stage}-{uuid.uuid4().hex}"
            df.write.parquet(place)
            rows = self.spark.read.schema(df.schema).parquet(place).count()
            self.commit(stage, place, rows, df.schema)
            return self.spark.read.schema(df.schema).parquet(place)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(done["schema"]))).parquet(done["path"])

    def rows(self, stage: str) -> int:
        return self.manifest(stage)["rows"]

    def once(self, stage: str, path: str, write: Callable[[str], None]) -> None:
        """Run an action that writes ``path``, unless it has finished before."""
        if self.manifest(stage) is None:
            write(path)
            self.commit(stage, path)
