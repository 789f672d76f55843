"""Incremental rollup: mergeable states of sections by day, combined when they are read.

A state holds what a day's rows add to a section: exact counts by key, or distinct members where a section counts distinct
things. Only the days that changed are computed again, and take the place of what they had, so doing it again changes
nothing. Reading combines the days with one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope import vocabulary as V
from agorascope.operators import sections as S
from agorascope.plans.store import read_or_none
from agorascope.session import cut, listed, remove
from agorascope.streaming.ingest import day_of


@dataclass(frozen=True)
class State:
    """``of`` gives the rows that a state is made of, from items that carry their ``day``; equal rows are counted, as ``n``,
    or, for a set, held once. ``combine`` makes the section's table of the rows of all days."""

    of: Callable[[DataFrame], DataFrame]
    combine: Callable[[DataFrame], DataFrame]
    distinct: bool = False

    def partial(self, items: DataFrame) -> DataFrame:
        rows = self.of(items)
        return rows.distinct() if self.distinct else rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


def _counts(of: Callable[[DataFrame], DataFrame], *by: str) -> State:
    return State(of, lambda days: days.groupBy(*by).agg(F.sum("n").alias("n")))


def _plain(*by: str) -> State:
    return _counts(lambda i: S.human_ai(i).select("day", *by), *by)


def _topics(*by: str) -> State:
    return _counts(lambda i: S.human_ai(i).select("day", *by, F.explode("topics").alias("topic")), *by, "topic")


def _claims(items: DataFrame) -> DataFrame:
    return S.human(items).select("day", "thread_id", F.explode(S.claims()).alias("c")).where("c.name <> ''").select("day", "thread_id", "c.claim", "c.name")


def _recurrence(days: DataFrame) -> DataFrame:
    return days.groupBy("claim", "name").agg(F.countDistinct("thread_id").alias("threads"))


def cohort_states(frame: Column) -> dict[str, State]:
    """What the cohort needs of each day: threads by frame, and authors' stances."""
    negative = F.col("stance").isin(*V.NEGATIVE)

    def threads(days: DataFrame) -> DataFrame:
        return days.groupBy("frame").agg(
            F.sum("n").alias("ai_posts"), F.coalesce(F.sum(F.when(F.col("negative"), F.col("n"))), F.lit(0)).alias("neg_posts"),
            F.countDistinct("thread_id").alias("distinct_threads"), F.countDistinct(F.when(F.col("negative"), F.col("thread_id"))).alias("neg_threads"),
        )

    def authors(days: DataFrame) -> DataFrame:
        # the most frequent stance over all days; of equals the one that was seen first
        counted = days.groupBy("frame", "author", "stance").agg(F.sum("n").alias("n"), F.min(F.struct("subreddit", "id")).alias("seen"))
        best = counted.groupBy("frame", "author").agg(F.max("n").alias("most"))
        modal = counted.join(best, ["frame", "author"]).where("n = most").groupBy("frame", "author").agg(F.min_by("stance", "seen").alias("stance"))
        return modal.groupBy("frame").agg(F.count(F.lit(1)).alias("distinct_authors"), F.count_if(negative).alias("neg_authors"))

    def by_author(items: DataFrame) -> DataFrame:
        known = S.human_ai(items).where("author <> '' and author <> '[deleted]'")
        return known.select("day", frame.alias("frame"), "author", "stance", "subreddit", "id")

    return {
        "cohort_threads": State(lambda i: S.human_ai(i).select("day", frame.alias("frame"), "thread_id", negative.alias("negative")), threads),
        "cohort_authors": State(by_author, authors),
    }


STATES: dict[str, State] = {
    "stance_by_week": _plain("week", "stance"),
    "stance": _plain("stance"),
    "experience": _plain("experience"),
    "source_stance": _plain("source", "stance"),
    "topics": _topics(),
    "heatmap_subs": _topics("subreddit"),
    "rules": _counts(
        lambda i: S.non_human(i).select("day", "subreddit", F.when(F.col("content_class_reason") == "", "unknown").otherwise(F.col("content_class_reason")).alias("reason")),
        "subreddit", "reason",
    ),
    "recurrence": State(_claims, _recurrence, distinct=True),
}


class Partials:
    """States under ``path``: ``<section>/day=...``. There is one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, states: dict[str, State] | None = None):
        self.spark, self.path, self.states = spark, path, STATES if states is None else states

    def refresh(self, items: DataFrame, days: list | None = None) -> list:
        """Compute the days of ``items``, which must be all items of these days, and put them in place; the days.

        ``days`` names days that may have no rows left, so that their states go.
        """
        dated = items.withColumn("day", day_of(F.col("created_utc")))
        given = sorted({r[0] for r in dated.select("day").distinct().collect()} | set(days or []))  # bounded by the calendar
        for name, state in self.states.items():
            place = f"{self.path}/{name}"
            # a folder for each day as few files as its rows need: days are dealt whole, large ones split
            rows = cut(state.partial(dated))  # for the days as well, which may have fewer rows than they had
            rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(place)
            kept = {r[0] for r in rows.select("day").distinct().collect()}
            for day in given:
                if day not in kept and f"day={day}" in listed(self.spark, place):
                    remove(self.spark, f"{place}/day={day}")
        return given

    def table(self, name: str) -> DataFrame | None:
        """The section's table over all days; None where no day has had a row of it."""
        rows = read_or_none(self.spark, f"{self.path}/{name}")
        return None if rows is None else self.states[name].combine(rows)
