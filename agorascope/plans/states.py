"""Small states between runs: how far each community was read, and values that tell when they are damaged."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.plans.store import Versions

MARKS = "subreddit string, kind string, watermark long"


class Marks:
    """The newest time seen of each community and kind: a row for each, whatever the store holds.

    A batch's marks are merged in and take their place as one version. Merging the same again changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.store = spark, Versions(spark, path)

    def read(self) -> DataFrame | None:
        return self.store.table("watermarks", "marks")

    def merge(self, found: DataFrame) -> DataFrame:
        """found: (subreddit, kind, watermark), rows without a time left out; the marks as they are then."""
        known = self.read()
        both = found.select("subreddit", "kind", F.col("watermark").cast("long").alias("watermark")).where("watermark is not null")
        if known is not None:
            both = both.unionByName(known)
        self.store.write("watermarks", {"marks": both.groupBy("subreddit", "kind").agg(F.max("watermark").alias("watermark")).coalesce(1)})
        return self.read()


class CorruptState(ValueError):
    """A stored state that can't be what was saved; ``state`` is its name."""

    def __init__(self, state: str, problem: str):
        super().__init__(f"{state}: {problem}")
        self.state = state


class States:
    """Named JSON values with their checksums, in versions.

    ``load`` tells three cases apart: nothing was saved (None), the value is whole, or it is damaged, which raises
    ``CorruptState``; who can start anew does so, and says so. Damage never reads as "none".
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.store = spark, Versions(spark, path)

    def save(self, name: str, value: dict) -> None:
        text = json.dumps(value)
        row = [(text, hashlib.sha256(text.encode()).hexdigest())]
        self.store.write(name, {"state": self.spark.createDataFrame(row, "value string, checksum string").coalesce(1)})

    def load(self, name: str) -> dict | None:
        version = self.store.current().get(name)
        if version is None:
            return None
        try:
            # a declared schema: a file with other columns gives nulls, not another state
            rows = self.spark.read.schema("value string, checksum string").parquet(f"{self.store.path}/{name}/{version}/state").limit(2).collect()
        except Exception as failure:  # a file that is gone or no Parquet
            raise CorruptState(name, str(failure).split("\n")[0][:300]) from failure
        if len(rows) != 1 or rows[0]["value"] is None or rows[0]["checksum"] is None:
            raise CorruptState(name, f"{len(rows)} rows, or one without a value")
        if hashlib.sha256(rows[0]["value"].encode()).hexdigest() != rows[0]["checksum"]:
            raise CorruptState(name, "its checksum differs")
        try:
            value = json.loads(rows[0]["value"])
        except ValueError as failure:
            raise CorruptState(name, "no JSON") from failure
        if not isinstance(value, dict):
            raise CorruptState(name, "no JSON object")
        return value
