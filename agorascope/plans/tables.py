"""Stored tables by partition: only what changes is read and written again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.session import cut, exists, listed, put_in_place, remove

KEYS, BY = ["subreddit", "row_key"], ["subreddit", "day"]
#: Values of a partition column that are named in a filter; of more than that the column is not filtered by value.
MOST_NAMED = 5000


def pruned(stored: DataFrame, parts: DataFrame, by: list[str] = BY) -> DataFrame:
    """The rows of ``stored`` in the partitions that ``parts`` has. Their values are named in the scan's partition filters,
    so no other folder is opened but those that share a value of each column."""
    rows = stored
    for column in by:
        values = [r[0] for r in parts.select(column).distinct().limit(MOST_NAMED + 1).collect()]
        if len(values) <= MOST_NAMED:
            rows = rows.where(F.col(column).isin(values))
    # a row a partition, so no row of the store is shuffled for it
    return rows.join(F.broadcast(parts.select(*by).distinct()), by, "left_semi")


class PartitionedTable:
    """A Parquet table by partition, into which changes are merged.

    A merge reads the touched partitions, writes their new rows beside the table, and only when all of them are there
    moves them to the place of the old ones; all others keep their very files. A merge that dies before that has changed
    nothing; one that dies in the middle of it is ended by the next use of the table: what is not moved is still staged.
    There is one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, by: list[str] | None = None):
        self.spark, self.path, self.by = spark, path.rstrip("/"), by or BY
        self.staged = f"{self.path}-staged"

    def read(self) -> DataFrame:
        self.recover()
        return self.spark.read.option("mergeSchema", "true").parquet(self.path)

    def write(self, rows: DataFrame) -> None:
        """The whole table anew, from rows that don't come from it."""
        remove(self.spark, self.staged)
        self._dealt(rows).write.mode("overwrite").partitionBy(*self.by).parquet(self.path)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """A partition of many rows is split, small ones have a file each: files grow with the rows, not with tasks times partitions."""
        return rows.hint("rebalance", *self.by)

    def merge(self, changes: DataFrame, put: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """``put(old, changes)`` gives the new rows of the partitions that ``changes`` names in its ``by`` columns.

        It must keep the rows in them that don't change, and give the same again for the same, as after a failure it may
        get its own result.
        """
        changes = cut(changes)  # used for the partitions and for the rows
        new = put(pruned(self.read(), changes, self.by), changes)
        remove(self.spark, self.staged)
        self._dealt(new).write.partitionBy(*self.by).parquet(self.staged)
        self.recover()

    def recover(self) -> bool:
        """End a merge whose rows are all staged, forget one whose aren't; whether there was one to end."""
        whole = exists(self.spark, f"{self.staged}/_SUCCESS")
        if whole:
            for part in self._folders(self.staged, len(self.by)):
                put_in_place(self.spark, f"{self.staged}/{part}", f"{self.path}/{part}")
        if whole or exists(self.spark, self.staged):
            remove(self.spark, self.staged)
        return whole

    def _folders(self, path: str, depth: int) -> list[str]:
        """The partitions that a folder has, by their paths in it."""
        names = [name for name in listed(self.spark, path) if "=" in name]
        return names if depth == 1 else [f"{name}/{part}" for name in names for part in self._folders(f"{path}/{name}", depth - 1)]
