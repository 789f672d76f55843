"""Daily admission to the model over a stream: tickets in keyed state, rows that wait, counters that no replay spends twice.

A day's cap is dealt over lanes, whose shares add up to it, so no task sees all rows and the cap is never overrun. Each
lane's state holds the tickets spent on its current day and the rows that wait. A row takes the next ticket of its lane's
day; without one it waits. A new day's tickets go to the longest waiting first, with the day's first request or by a
timer when the stream's time has passed midnight; those of a day that nobody was awake on are lost. State, timers and
output belong to one batch: a batch that is run again begins from the state before it.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from agorascope.plans.store import read_or_none

DAY_MS = 86_400_000
OUTPUT = "lane string, row_key string, created_utc long, day date, ticket long"
#: The state store that keyed state with timers needs.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def lane_share(cap: int, lanes: int, lane: int) -> int:
    """A lane's tickets of a day; the shares of all lanes are the cap."""
    return cap // lanes + (lane < cap % lanes)


class Tickets(StatefulProcessor):
    """One lane. ``share`` gives its tickets of a day from its name."""

    def __init__(self, share: Callable[[str], int]):
        self.share = share

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spent = handle.getValueState("spent", "day long, n long")
        self.waiting = handle.getMapState("waiting", "row_key string", "created_utc long")

    def _spent(self, day: int) -> int:
        """Tickets of ``day`` that are gone; a day before the current one has none left."""
        if not self.spent.exists():
            return 0
        current, n = self.spent.get()
        return n if current == day else 0 if current < day else 1 << 62

    def _rows(self, lane: str, day: int, first: int, rows: list[tuple[int, str]]):
        import pandas as pd

        return pd.DataFrame({
            "lane": lane, "row_key": [k for _, k in rows], "created_utc": [t for t, _ in rows],
            "day": datetime.fromtimestamp(day * 86400, UTC).date(), "ticket": range(first + 1, first + 1 + len(rows)),
        })

    def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
        (lane,) = key
        now = timerValues.getCurrentWatermarkInMs()
        asked: dict[int, dict[str, int]] = {}
        for batch in rows:
            for row_key, created, at in zip(batch["row_key"], batch["created_utc"], batch["asked_day"], strict=True):
                day = asked.setdefault(int(at), {})
                day[row_key] = min(int(created), day.get(row_key, 1 << 62))
        for day in sorted(asked):
            yield from self._waiting_first(lane, day)
            spent = self._spent(day)
            order = sorted((t, k) for k, t in asked[day].items() if not (self.waiting.exists() and self.waiting.containsKey((k,))))
            taken = order[: max(0, self.share(lane) - spent)]
            for created, row_key in order[len(taken) :]:
                self.waiting.updateValue((row_key,), (created,))
            if taken:
                self.spent.update((day, spent + len(taken)))
                yield self._rows(lane, day, spent, taken)
        if self.waiting.exists() and not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer((max(now // DAY_MS, max(asked, default=0)) + 1) * DAY_MS)

    def _waiting_first(self, lane: str, day: int) -> Iterator:
        """The day's free tickets for the rows that have waited longest, which are passed by one at a time."""
        spent = self._spent(day)
        free = max(0, self.share(lane) - spent)
        if free and self.waiting.exists():
            taken = heapq.nsmallest(free, ((v[0], k[0]) for k, v in self.waiting.iterator()))
            for _, row_key in taken:
                self.waiting.removeKey((row_key,))
            self.spent.update((day, spent + len(taken)))
            yield self._rows(lane, day, spent, taken)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        (lane,) = key
        day = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()) // DAY_MS
        yield from self._waiting_first(lane, day)
        if self.waiting.exists():
            self.handle.registerTimer((day + 1) * DAY_MS)

    def close(self) -> None:
        pass


def admitted(asks: DataFrame, share: Callable[[str], int], lane: F.Column, late: str = "0 seconds") -> DataFrame:
    """A stream (lane, row_key, created_utc, day, ticket) of the rows that get a ticket, each once.

    asks: a stream (row_key, created_utc, asked_at), where ``asked_at`` is the time of the request, which only rises; it
    drives the days. ``share`` gives a lane's tickets a day. A row that is asked for again while it waits takes no second
    place; one that has had its ticket is new, so requests are made once.
    """
    asks.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    given = asks.withWatermark("asked_at", late).select(
        lane.cast("string").alias("lane"), "row_key", F.col("created_utc").cast("long").alias("created_utc"), "asked_at",
        F.floor(F.unix_millis("asked_at") / DAY_MS).alias("asked_day"),
    )
    return given.groupBy("lane").transformWithStateInPandas(Tickets(share), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")


def capped(asks: DataFrame, cap: int, lanes: int = 64) -> DataFrame:
    """As ``admitted``, with one cap a day, dealt over lanes by the row's key."""
    lanes = max(1, min(lanes, cap))
    return admitted(asks, lambda lane: lane_share(cap, lanes, int(lane)), F.pmod(F.xxhash64("row_key"), F.lit(lanes)))


def write_batches(rows: DataFrame, path: str, checkpoint: str):
    """Write each batch under its number, in place of what an earlier try of the same batch has left. Runs until what is
    there has been read."""
    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def spent_by_day(spark: SparkSession, path: str) -> DataFrame:
    """(day, n): the tickets that were given on each day, from what was written, so that a batch counts once."""
    found = read_or_none(spark, path)
    found = found if found is not None else spark.createDataFrame([], OUTPUT)
    return found.groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def tally(spark: SparkSession, filtered: DataFrame, path: str, batch: int, day: F.Column) -> DataFrame:
    """(day, reason, n) of all filtered rows so far: a batch's counts are written under its number, in place of an earlier try's."""
    counts = filtered.where("reason is not null").groupBy(day.alias("day"), "reason").agg(F.count(F.lit(1)).alias("n"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")
    return spark.read.parquet(path).groupBy("day", "reason").agg(F.sum("n").alias("n"))
