"""Incremental ingest: raw records to stored rows, each once, late ones within three days; backfills that resume.

A store is a Parquet table by community and day. A row's day follows from its time, so a batch is compared only
with the days it has and those of the overlap around them. How far each community was read is a small table beside it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from agorascope.functions import text as X
from agorascope.operators.rows import admit
from agorascope.plans.states import Marks
from agorascope.plans.store import append_log, read_or_none
from agorascope.plans.tables import KEYS, pruned
from agorascope.session import cut, listed
from agorascope.sources import normalize
from agorascope.sources.archive import Archive, Cursored

OVERLAP_DAYS = 3
OVERLAP, OVERLAP_SECONDS, FIRST_RUN_SECONDS = f"{OVERLAP_DAYS} days", OVERLAP_DAYS * 86400, 14 * 86400
#: The day of rows without a time.
NO_DAY = "1970-01-01"
STATUS = "sub string, kind string, queued boolean, exhausted boolean, months int, watermark long, updated_at timestamp"


def incoming(spark: SparkSession, path: str, kind: str = "post", max_files: int = 1000) -> DataFrame:
    """Rows of a folder of JSON lines, duplicates within the overlap dropped by key."""
    schema = normalize.RAW_COMMENT if kind == "comment" else normalize.RAW_POST
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)
    rows = normalize.comments(raw) if kind == "comment" else normalize.posts(raw)
    timed = rows.withColumn("ts", F.timestamp_seconds("created_utc")).withWatermark("ts", OVERLAP)
    return timed.dropDuplicatesWithinWatermark(["subreddit", "row_key"]).drop("ts")


def day_of(created_utc: Column) -> Column:
    return F.coalesce(F.to_date(F.timestamp_seconds(created_utc)), F.to_date(F.lit(NO_DAY)))


def around(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """The stored rows that may be those of a batch: of its communities, in its days and ``OVERLAP_DAYS`` before and after
    each, and those without a time. No other day is read, whatever lies between a batch's days."""
    spread = F.array_append(F.sequence(F.date_sub("day", OVERLAP_DAYS), F.date_add("day", OVERLAP_DAYS)), F.to_date(F.lit(NO_DAY)))
    return pruned(stored, batch.select("subreddit", "day").distinct().select("subreddit", F.explode(spread).alias("day")))


def append_new(rows: DataFrame, store: str, raw: str | None = None) -> int:
    """Append the rows whose keys are not in the table at ``store`` yet, and, with ``raw``, archive them there as well; how many.

    Each key is stored once: of a batch's rows with one key the newest, on whatever days they are, and none if the key is
    stored within the overlap. ``rows`` are used several times, so they should be cut before if they are costly.
    """
    session = rows.sparkSession
    dated = rows.withColumn("day", day_of(F.col("created_utc")))
    stored = read_or_none(session, store)
    fresh = admit(dated.limit(0) if stored is None else around(stored, dated), dated, KEYS)
    if raw:
        fresh = cut(fresh)  # both tables must get the same rows
        archive_raw(fresh, raw)
    count = Observation()
    fresh.observe(count, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy("subreddit", "day").parquet(store)
    return count.get["n"]


def archive_raw(rows: DataFrame, path: str) -> None:
    """Whole records as JSON by community and day, under their row's key."""
    dated = rows if "day" in rows.columns else rows.withColumn("day", day_of(F.col("created_utc")))
    whole = F.to_json(F.struct(*[c for c in rows.columns if c != "day"])).alias("record")
    dated.select("subreddit", "day", "row_key", whole).write.mode("append").partitionBy("subreddit", "day").parquet(path)


def raw_of(spark: SparkSession, path: str, subreddit: str, created_utc: int, row_key: str) -> DataFrame:
    """One archived record; its community and day name the folder that is read."""
    day = F.to_date(F.timestamp_seconds(F.lit(created_utc)))
    return spark.read.parquet(path).where((F.col("subreddit") == subreddit.lower()) & (F.col("day") == day) & (F.col("row_key") == row_key)).select("record")


def watermarks(rows: DataFrame) -> DataFrame:
    """The newest time seen of each community, from which the next read starts less the overlap."""
    return rows.groupBy("subreddit", "kind").agg(F.max("created_utc").alias("watermark"), F.count(F.lit(1)).alias("n"))


def marks_of(spark: SparkSession, store: str) -> Marks:
    """The watermarks of a store. One that has rows but no marks yet is read for them once."""
    marks = Marks(spark, f"{store.rstrip('/')}-marks")
    if marks.read() is None and (stored := read_or_none(spark, store)) is not None:
        marks.merge(watermarks(stored))
    return marks


def starts(marks: DataFrame | None, subs: list[str], now: int, kind: str = "post") -> dict[str, int]:
    """Where each community's next read starts: its watermark less the overlap, or two weeks ago for a new one."""
    if marks is None:
        return {s: now - FIRST_RUN_SECONDS for s in subs}
    wanted = {s.lower(): s for s in subs}
    rows = marks.where(F.col("subreddit").isin(list(wanted)) & (F.col("kind") == kind)).collect()  # one row a setting's community
    seen = {wanted[r["subreddit"]]: r["watermark"] - OVERLAP_SECONDS for r in rows if r["watermark"] is not None}
    return {s: seen.get(s, now - FIRST_RUN_SECONDS) for s in subs}


@dataclass
class Frame:
    """One sampling frame: where its records come from and how they become rows."""

    name: str
    client: str
    subs: list[str]
    source: str = Archive.name()
    kind: str = "post"
    schema: str = normalize.RAW_POST
    rows: Callable[[DataFrame], DataFrame] = field(default=normalize.posts)
    options: dict[str, str] = field(default_factory=dict)


def stream_frame(client: str, streams: list[dict], pages: int = 3) -> Frame:
    """Keyword streams; a post's community is the stream that found it."""
    return Frame(
        "streams", client, [s["name"] for s in streams], Cursored.name(), "post", normalize.RAW_STREAM,
        lambda raw: normalize.stream_posts(raw, F.col("_sub")), {"pages": str(pages)},
    )


def listing_frame(client: str, subs: list[str], pages: int = 2) -> Frame:
    """Listings of communities, newest first."""
    return Frame("listings", client, subs, Cursored.name(), options={"pages": str(pages)})


def fetched(spark: SparkSession, frame: Frame, begin: dict[str, int], now: int) -> DataFrame:
    """(sub, json, error) of one frame: a task for each community and window; one that fails gives its error and no more."""
    for source in (Archive, Cursored):
        spark.dataSource.register(source)
    options = {
        "client": frame.client, "subs": ",".join(frame.subs), "after": str(min(begin.values(), default=0)), "before": str(now),
        "kind": f"{frame.kind}s", "starts": json.dumps(begin), "isolate": "true",
    } | frame.options
    return spark.read.format(frame.source).options(**options).load()


def run_ingest(
    spark: SparkSession, frames: list[Frame], store: str, raw: str | None = None, now: int | None = None, backfill_status: str | None = None,
) -> DataFrame:
    """One row a frame (frame, ok, discovered, admitted, failed, error): what is new since the watermarks goes to ``store``.

    Frames are isolated from each other and communities within a frame: what one fails to give, the others don't miss,
    and its watermark stays where it was, as what it gave need not be all up to its newest row. Watermarks are read
    from their own table, never from the store. Communities without a backfill status are queued for one.
    """
    now, out = int(time.time()) if now is None else now, []
    for frame in frames:
        try:
            marks = marks_of(spark, store)
            records = cut(fetched(spark, frame, starts(marks.read(), frame.subs, now, frame.kind), now))
            parsed = records.where("json is not null").select(
                "sub", F.from_json("json", frame.schema).alias("r"),
            ).select(F.col("sub").alias("_sub"), "r.*")
            rows = frame.rows(parsed)
            errors = records.where("error is not null").groupBy("sub").agg(F.min("error").alias("error")).collect()
            admitted = append_new(rows, store, raw)
            marks.merge(watermarks(rows.where(~F.lower("subreddit").isin([r["sub"].lower() for r in errors]))))
            if backfill_status:
                for sub in without_status(spark, backfill_status, frame.subs, frame.kind):
                    request_backfill(spark, backfill_status, sub, kind=frame.kind)
            out.append((frame.name, not errors, parsed.count(), admitted, [f"{r['sub']}: {r['error']}" for r in errors], None))
        except Exception as failure:  # a frame that is down never ends the others
            out.append((frame.name, False, 0, 0, [], str(failure).split("\n")[0][:500]))
    return spark.createDataFrame(out, "frame string, ok boolean, discovered long, admitted long, failed array<string>, error string")


def status_of(spark: SparkSession, path: str) -> DataFrame:
    """(sub, kind, queued, exhausted, months, watermark, updated_at): each walk's last status."""
    log = read_or_none(spark, path, STATUS)
    log = log if log is not None else spark.createDataFrame([], STATUS)
    return log.groupBy("sub", "kind").agg(F.max_by(F.struct("queued", "exhausted", "months", "watermark", "updated_at"), "updated_at").alias("s")).select(
        "sub", "kind", "s.*",
    )


def _mark(spark: SparkSession, path: str, sub: str, kind: str, queued: bool, exhausted: bool, months: int, watermark: int | None) -> None:
    last = lambda log: log.groupBy("sub", "kind").agg(F.max_by(F.struct(*log.columns), "updated_at").alias("s")).select("s.*")
    append_log(spark, path, [(sub.lower(), kind, queued, exhausted, months, watermark, datetime.now(UTC))], STATUS, last)


def without_status(spark: SparkSession, path: str, subs: list[str], kind: str = "post") -> list[str]:
    """Communities that no backfill was ever asked for."""
    wanted = spark.createDataFrame([(s.lower(),) for s in subs], "sub string")
    return sorted(r["sub"] for r in wanted.join(status_of(spark, path).where(F.col("kind") == kind), "sub", "left_anti").collect())


def request_backfill(spark: SparkSession, path: str, sub: str, months: int = 12, force: bool = False, kind: str = "post") -> bool:
    """Queue a walk, unless one is queued or done already and not forced; whether it was."""
    known = status_of(spark, path).where((F.col("sub") == sub.lower()) & (F.col("kind") == kind) & (F.col("queued") | F.col("exhausted")))
    if not force and not known.isEmpty():
        return False
    _mark(spark, path, sub, kind, True, False, months, None)
    return True


def backfill(
    spark: SparkSession, store: str, client: str, subs: list[str], before: int, months: int = 12, kind: str = "post", window: int = 7 * 86400,
    status: str | None = None, raw: str | None = None,
) -> DataFrame:
    """Read the months up to ``before`` from the archive, a task for each community and window, and append what is new.

    Returns the store's watermarks (subreddit, kind, watermark). A repeated or resumed run adds nothing twice. With ``status``, a walk goes on from
    where its last run ended, posts and comments each by themselves, and is marked exhausted unless its community failed.
    """
    if not 1 <= months <= 24:
        raise ValueError(f"a backfill covers 1 to 24 months, not {months}")
    first = max(0, before - months * 30 * 86400)
    begin = {s: first for s in subs}
    if status:
        known = status_of(
            spark, status,
        ).where((F.col("kind") == kind) & F.col("watermark").isNotNull() & F.col("sub").isin([s.lower() for s in subs])).collect()
        by_name = {s.lower(): s for s in subs}
        begin |= {by_name[r["sub"]]: max(first, r["watermark"]) for r in known}
    comment = kind == "comment"
    frame = Frame(
        "backfill", client, subs, kind=kind, schema=normalize.RAW_COMMENT if comment else normalize.RAW_POST,
        rows=normalize.comments if comment else normalize.posts, options={"window": str(window)} | ({} if status else {"isolate": "false"}),
    )
    records = cut(fetched(spark, frame, begin, before))
    parsed = records.where("json is not null").select(F.from_json("json", frame.schema).alias("r")).select("r.*")
    rows = frame.rows(parsed)
    marks = marks_of(spark, store)
    append_new(rows, store, raw)
    if status:
        failed = {r["sub"] for r in records.where("error is not null").select("sub").distinct().collect()}
        for sub in subs:
            # a walk that failed keeps its start: what came of it is stored, and is not stored again
            _mark(spark, status, sub, kind, sub in failed, sub not in failed, months, begin[sub] if sub in failed else before)
    # what a backfill brings is older than what is read from a watermark on, so a mark can only be raised by a first one
    return marks.merge(watermarks(rows))


def walk_back(spark: SparkSession, frame: Frame, store: str, checkpoint: str, after: int = 0, pages: int = 10, raw: str | None = None) -> dict:
    """Walk streams or listings back to ``after``, ``pages`` pages of each a batch, until all are done; what is new goes to ``store``.

    A walk that was stopped goes on at the page after the last batch that ended, and a batch that is run again adds
    nothing twice. Returns {name: {cursor, done, failed}}, where each walk stands.
    """
    spark.dataSource.register(Cursored)
    options = {"client": frame.client, "subs": ",".join(frame.subs), "after": str(after), "pages": str(pages)} | frame.options
    given = spark.readStream.format(Cursored.name()).options(**(options | {"pages": str(pages)})).load()

    def put(batch: DataFrame, _: int) -> None:
        records = cut(batch.where("json is not null"))
        parsed = records.select("sub", F.from_json("json", frame.schema).alias("r")).select(F.col("sub").alias("_sub"), "r.*")
        rows = cut(frame.rows(parsed))
        if not rows.isEmpty():
            append_new(rows, store, raw)

    query = given.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    last = max((int(n) for n in listed(spark, f"{checkpoint}/offsets") if n.isdigit()), default=None)
    return {} if last is None else json.loads(spark.read.text(f"{checkpoint}/offsets/{last}", wholetext=True).first()[0].strip().split("\n")[-1])


def ingest(spark: SparkSession, path: str, store: str, checkpoint: str, kind: str = "post"):
    """Append new rows of a folder to the table at ``store``, then stop. A replayed batch adds nothing twice.

    Returns the query; ``late_rows`` tells how many came too late. A batch is cut first: it is used several times, and the
    stateful step before it must run once.
    """
    query = incoming(spark, path, kind).writeStream.foreachBatch(
        lambda batch, _: _appended(cut(batch), store),
    ).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _appended(rows: DataFrame, store: str) -> None:
    marks = marks_of(rows.sparkSession, store)
    append_new(rows, store)
    marks.merge(watermarks(rows))


def late_rows(query) -> int:
    """Rows of this run that were older than the newest less the overlap, and so were left out; a backfill brings them."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def weekly_counts(stream: DataFrame) -> DataFrame:
    """Rows by the corpus's own week key, which no fixed window has, over a stream with ``created_utc``."""
    return stream.groupBy("subreddit", X.week_key(F.col("created_utc")).alias("week")).agg(F.count(F.lit(1)).alias("n"))


def filter_stream(
    comments: DataFrame, registry: Callable[[], DataFrame], write: Callable[[DataFrame, int], None], checkpoint: str, seconds: int = 300,
    clock: Callable[[], float] = time.time,
):
    """Filter a stream of comments by the registry, which is read again when it is older than ``seconds``.

    If it can't be read, the last one that could be goes on; before there is one, none is known. ``write`` gets each
    filtered batch and its number.
    """
    from agorascope.operators.classify import filter_comments

    kept: dict = {"at": None, "rows": None}

    def batch(rows: DataFrame, number: int) -> None:
        if kept["at"] is None or clock() - kept["at"] >= seconds:
            try:
                kept["rows"] = cut(registry().select("sub", "hash"))
            except Exception as failure:
                kept["error"] = str(failure).split("\n")[0]
            kept["at"] = clock()
        write(filter_comments(rows, kept["rows"]), number)

    return comments.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
