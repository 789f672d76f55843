"""Tables in versions: a run's tables are read only once all of them are written, and old ones are removed."""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agorascope.session import listed, remove

RUNS = "section string, version string, ok boolean, error string, finished_at timestamp"
#: Good versions of a section that stay, and files of a log from which it is written anew as one.
KEEP, LOG_FILES = 3, 20


def read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, None where nothing is stored yet; other errors go through."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def append_log(spark: SparkSession, path: str, rows: list[tuple], schema: str, needed, most_files: int = LOG_FILES) -> None:
    """Append rows to a small log, which grows by a file each time. Once it has ``most_files``, what is ``needed`` of it
    (a function from the log to rows) is written as one file, and only then the others are removed: a reader between sees
    rows twice, never too few, and a writer that dies between leaves just that. There is one writer at a time."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    files = [f for f in listed(spark, path) if f.startswith("part-")]
    if len(files) >= most_files:
        needed(spark.read.schema(schema).parquet(path)).distinct().coalesce(1).write.mode("append").parquet(path)
        for name in files:
            remove(spark, f"{path}/{name}")


class Versions:
    """Sections under ``path``: ``<section>/<version>/<table>``, and a log of runs that says which version holds.

    A run that fails midway leaves the tables of the last good one in place, and what it left is never read. Of each
    section the last ``keep`` good versions stay, so that who has begun to read one can end; all others are removed when
    the next one is good. There is one writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = KEEP):
        self.spark, self.path, self.keep = spark, path, max(1, keep)

    def log(self) -> DataFrame:
        found = read_or_none(self.spark, f"{self.path}/_runs", RUNS)
        return found if found is not None else self.spark.createDataFrame([], RUNS)

    def _needed(self, log: DataFrame) -> DataFrame:
        """Each section's last run, and its last good ones."""
        order = F.row_number().over(Window.partitionBy("section", "ok").orderBy(F.desc("finished_at"), "version"))
        return log.distinct().withColumn("_r", order).where((F.col("_r") == 1) | F.col("ok") & (F.col("_r") <= self.keep)).drop("_r")

    def _note(self, section: str, version: str, error: str | None) -> None:
        append_log(self.spark, f"{self.path}/_runs", [(section, version, error is None, error, datetime.now(UTC))], RUNS, self._needed)

    def write(self, section: str, tables: dict[str, DataFrame]) -> None:
        version = f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        for name, table in tables.items():
            table.write.parquet(f"{self.path}/{section}/{version}/{name}")
        self._note(section, version, None)
        self.vacuum(section)

    def vacuum(self, section: str) -> list[str]:
        """Remove the section's versions but the last ``keep`` good ones, those of failed runs too; the removed ones' names."""
        good = self.log().where((F.col("section") == section) & F.col("ok")).groupBy("version").agg(F.max("finished_at").alias("at"))
        stay = {r["version"] for r in good.orderBy(F.desc("at")).limit(self.keep).collect()}
        gone = [v for v in listed(self.spark, f"{self.path}/{section}") if v not in stay]
        for version in gone:
            remove(self.spark, f"{self.path}/{section}/{version}")
        return gone

    def fail(self, section: str, error: str) -> None:
        self._note(section, "", error)

    def status(self) -> DataFrame:
        """(section, ok, error, finished_at): each section's last run."""
        last = self.log().groupBy("section").agg(F.max_by(F.struct("ok", "error", "finished_at"), "finished_at").alias("r"))
        return last.select("section", "r.*")

    def current(self) -> dict[str, str]:
        """The version that holds of each section, in one look at the log."""
        last = self.log().where("ok").groupBy("section").agg(F.max_by("version", "finished_at").alias("version"))
        return {r["section"]: r["version"] for r in last.collect()}

    def table(self, section: str, name: str, current: dict[str, str] | None = None) -> DataFrame | None:
        """The section's table of the last good run, None before there is one. ``current`` spares a look at the log."""
        version = (self.current() if current is None else current).get(section)
        return self.spark.read.parquet(f"{self.path}/{section}/{version}/{name}") if version else None
