"""Repeat counts kept up batch by batch, so that a new batch reads no old title.

Each batch leaves its counts by community and hash, and of each row its key, hash and what it is by itself. Totals are
sums of counts; a batch changes the tags of old rows only where it lifts a hash over the limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.config import Boilerplate
from agorascope.operators import classify as K
from agorascope.plans.store import Versions, read_or_none
from agorascope.session import listed, remove

COUNTS = "sub string, hash string, n long, batch int"
TAGGED = ["subreddit", "row_key", "content_class", "content_class_reason"]


class RepeatCounts:
    """Counts and hashed rows of titles under ``path``, a folder for each batch, which a repeated batch replaces.

    Batches are numbered upwards. ``compact`` adds up the counts of old ones; a compacted batch can't come again.
    There is one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, limits: Boilerplate = Boilerplate()):
        self.spark, self.path, self.limits = spark, path, limits
        self.base = Versions(spark, f"{path}/base")

    def upto(self) -> int:
        """The last batch whose counts are added up; -1 before there is one."""
        found = self.base.table("counts", "upto")
        return found.first()[0] if found is not None else -1

    def add(self, batch: int, rows: DataFrame) -> None:
        """Take a batch in. rows: (subreddit, row_key, title, author, distinguished, stickied)."""
        if batch <= self.upto():
            return  # it is in the sums already
        slim = K.hashed(rows, self.limits).select(
            "subreddit", "row_key", "title_hash", K.reason_by_row(F.col("author"), F.col("distinguished"), F.col("stickied")).alias("own"),
        )
        slim.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")
        stored = self.spark.read.parquet(f"{self.path}/rows/batch={batch}")
        counts = K.repeat_counts(stored, "title_hash").withColumnRenamed("repeats", "n")
        counts.write.mode("overwrite").parquet(f"{self.path}/counts/batch={batch}")

    def _counts(self) -> DataFrame:
        """(sub, hash, n, batch), the sums as batch -1."""
        upto = self.upto()
        found = read_or_none(self.spark, f"{self.path}/counts", COUNTS)
        rows = found.where(F.col("batch") > upto) if found is not None else self.spark.createDataFrame([], COUNTS)
        base = self.base.table("counts", "sums")
        return rows if base is None else rows.unionByName(base.withColumn("batch", F.lit(-1)))

    def totals(self) -> DataFrame:
        """(sub, hash, repeats) over all batches."""
        return self._counts().groupBy("sub", "hash").agg(F.sum("n").alias("repeats"))

    def compact(self, upto: int) -> None:
        """Add up the counts of all batches to ``upto``, and remove their folders once the sums are stored."""
        rows = self._counts().where(F.col("batch") <= upto)
        sums = rows.groupBy("sub", "hash").agg(F.sum("n").alias("n"))
        self.base.write("counts", {"sums": sums, "upto": self.spark.createDataFrame([(max(upto, self.upto()),)], "upto int").coalesce(1)})
        for name in listed(self.spark, f"{self.path}/counts"):
            if name.startswith("batch=") and int(name[6:]) <= upto:
                remove(self.spark, f"{self.path}/counts/{name}")

    def _tagged(self, rows: DataFrame, over: DataFrame) -> DataFrame:
        reason = K.flagged(rows, over, "title_hash", "_over").withColumn(
            "content_class_reason", F.coalesce("own", F.when(F.col("_over"), "repeat-hash"), F.lit("")),
        )
        return reason.withColumn("content_class", K.class_of(F.col("content_class_reason"))).select(*TAGGED)

    def tags(self) -> DataFrame:
        """(subreddit, row_key, content_class, content_class_reason) of all rows, as a pass over all titles gives them."""
        over = self.totals().where(F.col("repeats") > self.limits.min_repeats)
        return self._tagged(self.spark.read.parquet(f"{self.path}/rows"), over)

    def changed(self, batch: int) -> DataFrame:
        """The tags that this last batch brings: those of its own rows, and of older rows with a hash that it lifted over the limit."""
        n = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
        sums = self._counts().groupBy("sub", "hash").agg(n(F.col("batch") < batch).alias("before"), F.sum("n").alias("repeats"), n(F.col("batch") == batch).alias("own"))
        over = sums.where((F.col("repeats") > self.limits.min_repeats) & (F.col("own") > 0)).select("sub", "hash", "before")
        rows = self.spark.read.parquet(f"{self.path}/rows")
        lifted = over.where(F.col("before") <= self.limits.min_repeats).select("sub", "hash")
        older = rows.where((F.col("batch") < batch) & F.col("own").isNull() & F.col("title_hash").isNotNull())
        older = K.flagged(older, lifted, "title_hash", "_lifted").where("_lifted").select(
            "subreddit", "row_key", F.lit("boilerplate").alias("content_class"), F.lit("repeat-hash").alias("content_class_reason"),
        )
        return self._tagged(rows.where(F.col("batch") == batch), over).unionByName(older)
